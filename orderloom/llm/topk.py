"""Exact top-k by the threshold algorithm over sorted per-dimension lists."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import staged
from orderloom.llm.vectors import asked, every, nearest, shard_count, shard_of, usable

K, QUERY_STRIDE, SCALE = 20, 20, 64
SHARD_ROWS, GROUP_ROWS = 16_384, 16_384
_FIRST_DEPTH, _BLOCK = 8, 256


class SortedLists:
    """Rows of a shard with one sorted list per dimension.

    Every list is read from both of its ends at once, as one query wants large and
    another small values there. A row is met at the depth where the first of the
    lists, from either end, shows it; rows are kept in that order, so what the
    lists show down to any depth is one stretch of rows.
    """

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        by_id = np.argsort(ids)
        ids, rows = ids[by_id], rows[by_id]
        count = len(ids)
        order = np.argsort(rows, axis=0, kind="stable")
        self.lists = np.take_along_axis(rows, order, 0)
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(count)[:, None], 0)
        met = np.minimum(rank, count - 1 - rank).min(1)
        by_depth = np.argsort(met, kind="stable")
        self.ids, self.met = ids, met[by_depth]
        self.place = by_depth  # of a row among the ids
        self.rows = rows[by_depth]
        self.largest = int(np.abs(rows).max(initial=0))

    def _own(self, query_ids: np.ndarray, queries: np.ndarray) -> np.ndarray:
        """Places among the ids of the queries' own rows, -1 for none here."""
        own = np.searchsorted(self.ids, query_ids)
        last = np.searchsorted(self.ids, query_ids, "right")
        for at in np.flatnonzero(last - own > 1):  # an id with several vectors
            same = np.isin(self.place, np.arange(own[at], last[at])) & (self.rows == queries[at]).all(1)
            own[at] = self.place[same].min(initial=len(self.ids)) if same.any() else -1
        return np.where(last > np.maximum(own, 0), own, -1) if len(self.ids) else np.full(len(own), -1)

    def top(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """Place of a query, ids and scores of its k best, ties to smaller ids, without its own row.

        Depths double. A row met in any list is scored at once. A row not met yet
        can't score above the sum of what the lists show now; a query whose k-th
        result is better stops. Equal isn't enough: such a row may have a smaller id.
        """
        count, size = len(self.ids), len(queries)
        # Doubles are exact up to 2**53; scores below 2**30 share a long with the place.
        small = self.largest * int(np.abs(queries).sum(1).max(initial=0)) < 2**30
        none = -(1 << 31) if small else np.iinfo(np.int64).min + 1
        rows, asked = (self.rows.astype(float), queries.astype(float)) if small else (self.rows, queries)
        own = self._own(query_ids, queries)
        scores = np.zeros((size, 0), np.int64)
        places = np.zeros((size, 0), np.int64)
        best = [None] * size
        active, before, depth = np.arange(size), 0, _FIRST_DEPTH
        while len(active):
            to = int(np.searchsorted(self.met, depth))
            fresh = (asked[active] @ rows[before:to].T).astype(np.int64)
            at = np.broadcast_to(self.place[before:to], fresh.shape)
            fresh[at == own[active][:, None]] = none
            scores, places = _best(np.concatenate([scores, fresh], 1), np.concatenate([places, at], 1), k, small)
            ended = np.full(len(active), to == count)
            if to < count and scores.shape[1] == k:
                high, low = self.lists[count - depth], self.lists[depth - 1]
                bound = np.maximum(queries[active], 0) @ high + np.minimum(queries[active], 0) @ low
                ended |= scores.min(1) > bound
            for row in np.flatnonzero(ended):
                kept = np.flatnonzero(scores[row] > none)
                kept = kept[np.lexsort((places[row, kept], -scores[row, kept]))]
                best[active[row]] = (int(active[row]), self.ids[places[row, kept]], scores[row, kept])
            active, scores, places = active[~ended], scores[~ended], places[~ended]
            before, depth = to, 2 * depth
        return best


def _best(scores: np.ndarray, places: np.ndarray, k: int, small: bool) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row, by score and then place, in no order."""
    if scores.shape[1] <= k:
        return scores, places
    if small:
        key = (scores << 32) + ((1 << 32) - 1 - places)
        kept = np.argpartition(-key, k - 1, axis=1)[:, :k]
    else:
        kept = np.stack([np.lexsort((p, -s))[:k] for s, p in zip(scores, places)])
    return np.take_along_axis(scores, kept, 1), np.take_along_axis(places, kept, 1)


def quantised(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``vector`` with floor(scale * x) for every component x, rows equal in both once."""
    whole = F.transform("vector", lambda x: F.floor(x * scale).cast("long"))
    return usable(table).select("vec_id", whole.alias("vector")).distinct()


def _matrix(vectors: pa.ChunkedArray, size: int) -> np.ndarray:
    return np.array(vectors.combine_chunks().flatten(), np.int64).reshape(-1, size)


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = K,
    shard_rows: int = SHARD_ROWS,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """The k vectors of the largest inner product with each query, all if fewer.

    Both have ``vec_id`` and ``vector`` (longs); vectors of other lengths than the
    query's, and its own row, are no candidates. Returns ``query_id``,
    ``rank``, ``vec_id`` and ``score``. Candidates are dealt into shards and
    queries into groups of bounded size; a task has one of each.
    """
    shards = shard_count(vectors.count(), shard_rows)
    groups = max(1, -(-queries.count() // group_rows))
    wide = F.size("vector").alias("width")
    left = vectors.select("vec_id", "vector", wide, shard_of(shards).alias("shard"), every(groups).alias("part"))
    right = queries.select(
        "vec_id", "vector", wide, every(shards).alias("shard"), shard_of(groups).alias("part"), asked()
    )

    def meet(candidates: pa.Table, given: pa.Table) -> pa.Table:
        columns = [], [], [], []
        if len(candidates) and len(given):
            size = candidates.column("width")[0].as_py()
            lists = SortedLists(candidates.column("vec_id").to_numpy(), _matrix(candidates.column("vector"), size))
            query_ids, matrix = given.column("vec_id").to_numpy(), _matrix(given.column("vector"), size)
            marks = given.column("asked").to_numpy()
            for begin in range(0, len(query_ids), _BLOCK):
                block = slice(begin, begin + _BLOCK)
                for at, ids, scores in lists.top(query_ids[block], matrix[block], k):
                    of = (np.full(len(ids), query_ids[begin + at]), np.full(len(ids), marks[begin + at]))
                    for column, values in zip(columns, (*of, ids, scores)):
                        column.append(values)
        joined = [pa.array(np.concatenate([np.zeros(0, np.int64), *c]), pa.int64()) for c in columns]
        return pa.table(joined, ["query_id", "asked", "vec_id", "score"])

    keys = ["width", "shard", "part"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        meet, "query_id long, asked long, vec_id long, score long"
    )
    return nearest(found, k)


def top_products(table: DataFrame, k: int = K, stride: int = QUERY_STRIDE) -> DataFrame:
    """Results for the rows whose id is divisible by the stride, against all rows."""
    vectors = staged(quantised(table), "vectors")
    return search(vectors, vectors.where(F.col("vec_id") % stride == 0), k)
