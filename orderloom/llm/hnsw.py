"""Approximate nearest neighbours: a hierarchical navigable small-world graph per
shard, kept as flat neighbour arrays, and results of all shards merged."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import staged
from orderloom.llm.vectors import asked, every, nearest, shard_count, shard_of, usable

K, QUERY_STRIDE = 5, 50
SHARD_ROWS, GROUP_ROWS = 4096, 4096
LINKS = 16  # chosen per node; reverse links fill a list up to twice as many
BUILD_BEAM, BEAM, UPPER_BEAM = 48, 96, 8
_BLOCK = 1024

INDEX = (
    "width int, shard int, ids binary, id_starts binary, vectors binary, "
    "layers array<struct<nodes:binary,neighbours:binary>>"
)


def _chosen(units: np.ndarray, nodes: np.ndarray, near: np.ndarray, links: int) -> np.ndarray:
    """Links of each node among its candidates, nearest first and -1 for none: a
    candidate counts if it is nearer to the node than to all chosen before it."""
    out = np.full((len(nodes), links), -1, np.int32)
    held = np.zeros(len(nodes), np.int64)
    to_chosen = np.full(near.shape, -np.inf, np.float32)  # each candidate's nearness to the chosen
    own = np.einsum("ncd,nd->nc", units[near], units[nodes])
    own[near < 0] = -np.inf
    rows = np.arange(len(nodes))
    for rank in range(near.shape[1]):
        takes = (near[:, rank] >= 0) & (own[:, rank] > to_chosen[:, rank]) & (held < links)
        at = rows[takes]
        if not len(at):
            continue
        taken = near[at, rank]
        out[at, held[at]] = taken
        held[at] += 1
        rest = near[at, rank + 1 :]
        to_chosen[at, rank + 1 :] = np.maximum(
            to_chosen[at, rank + 1 :], np.einsum("ncd,nd->nc", units[rest], units[taken])
        )
    return out


def _nearest(units: np.ndarray, nodes: np.ndarray, among: int, count: int) -> np.ndarray:
    """The nearest of the first ``among`` nodes to each node, itself left out."""
    count = min(count, among - 1)
    found = []
    for begin in range(0, len(nodes), _BLOCK):
        block = nodes[begin : begin + _BLOCK]
        close = units[block] @ units[:among].T
        close[np.arange(len(block)), block] = -np.inf
        part = np.argpartition(-close, count - 1, axis=1)[:, :count]
        order = np.argsort(-np.take_along_axis(close, part, 1), axis=1, kind="stable")
        found.append(np.take_along_axis(part, order, 1))
    return np.concatenate(found).astype(np.int32)


def build_layer(units: np.ndarray, links: int = LINKS, beam: int = BUILD_BEAM) -> np.ndarray:
    """Neighbours of all nodes of a layer, a flat array with -1 for none.

    Nodes come in with doubling numbers. Newcomers are linked to the best of those
    present, which get links back; a list that is full is chosen anew.
    """
    total, most = len(units), 2 * links
    lists = np.full((total, most), -1, np.int32)
    present = min(total, 1)
    while present < total:
        after = min(total, 2 * present)
        newcomers = np.arange(present, after)
        picked = _chosen(units, newcomers, _nearest(units, newcomers, after, beam), links)
        lists[newcomers, :links] = picked
        source, column = np.nonzero(picked >= 0)
        back = np.stack([picked[source, column], newcomers[source]], 1)
        back = np.unique(back, axis=0)
        back = back[~(lists[back[:, 0]] == back[:, 1:]).any(1)]
        held = (lists >= 0).sum(1)
        starts = np.searchsorted(back[:, 0], back[:, 0])
        slot = held[back[:, 0]] + np.arange(len(back)) - starts
        full = np.unique(back[slot >= most, 0])
        fits = ~np.isin(back[:, 0], full)
        lists[back[fits, 0], slot[fits]] = back[fits, 1]
        mine = back[~fits]
        counts = np.bincount(mine[:, 0], minlength=total)[full] if len(full) else np.zeros(0, int)
        ends = np.cumsum(counts)
        for at, end, count in zip(full.tolist(), ends.tolist(), counts.tolist()):
            near = np.concatenate([lists[at][lists[at] >= 0], mine[end - count : end, 1]])
            near = near[np.argsort(-(units[near] @ units[at]), kind="stable")]
            lists[at] = _chosen(units, np.array([at]), near[None, :], most)[0]
        present = after
    return lists


def build(ids: np.ndarray, vectors: np.ndarray, links: int = LINKS) -> dict:
    """Graph of a shard; equal vectors are one node with all their ids."""
    distinct, node = np.unique(vectors, axis=0, return_inverse=True)
    order = np.lexsort((ids, node))
    id_starts = np.searchsorted(node[order], np.arange(len(distinct) + 1))
    units = _units(distinct)
    draw = np.random.default_rng(len(distinct))
    levels = np.minimum((-np.log(1 - draw.random(len(distinct))) / np.log(links)).astype(int), 8)
    layers = []
    for level in range(levels.max(initial=0) + 1):
        nodes = draw.permutation(np.flatnonzero(levels >= level)).astype(np.int32)
        if not len(nodes):
            break
        lists = build_layer(units[nodes], links)
        layers.append((nodes, np.where(lists >= 0, nodes[lists], -1).astype(np.int32)))
    return {"ids": ids[order], "id_starts": id_starts, "vectors": distinct, "layers": layers}


def _units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float32)


def _beam_search(units, neighbours, queries, entries, beam: int) -> np.ndarray:
    """Nodes found from the entries, at most ``beam`` per query and -1 for none; all
    queries take their steps together."""
    count = len(queries)
    visited = np.zeros((count, len(units) + 1), bool)
    rows = np.arange(count)[:, None]
    visited[rows, entries] = True
    found = np.full((count, beam), -1, np.int64)
    close = np.full((count, beam), -np.inf, np.float32)
    done = np.ones((count, beam), bool)
    width = min(entries.shape[1], beam)
    found[:, :width] = entries[:, :width]
    close[:, :width] = np.einsum("ncd,nd->nc", units[entries[:, :width]], queries)
    close[found < 0] = -np.inf
    done[:, :width] = found[:, :width] < 0
    while True:
        best = np.where(done, -np.inf, close).argmax(1)
        at = np.flatnonzero(~done[np.arange(count), best])
        if not len(at):
            return np.take_along_axis(found, np.argsort(-close, axis=1, kind="stable"), 1)
        best = best[at]
        done[at, best] = True
        next_ = neighbours[found[at, best]].astype(np.int64)
        next_[visited[at[:, None], next_]] = -1
        visited[at[:, None], next_] = True
        visited[:, -1] = False
        gained = np.einsum("ncd,nd->nc", units[next_], queries[at])
        gained[next_ < 0] = -np.inf
        all_close = np.concatenate([close[at], gained], 1)
        kept = np.argpartition(-all_close, beam - 1, axis=1)[:, :beam]
        close[at] = np.take_along_axis(all_close, kept, 1)
        found[at] = np.take_along_axis(np.concatenate([found[at], next_], 1), kept, 1)
        done[at] = np.take_along_axis(np.concatenate([done[at], next_ < 0], 1), kept, 1)


def cosines(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Cosine of rows, in double precision."""
    norms = np.sqrt((one * one).sum(-1)) * np.sqrt((other * other).sum(-1))
    return (one * other).sum(-1) / norms


def search_shard(index: dict, query_ids: np.ndarray, queries: np.ndarray, k: int = K, beam: int = BEAM):
    """(query's place, vector id, score) of the best k of a shard for each query."""
    units, vectors = _units(index["vectors"]), index["vectors"]
    out = []
    for begin in range(0, len(queries), _BLOCK):
        block = queries[begin : begin + _BLOCK]
        asked = _units(block)
        top_nodes, _ = index["layers"][-1]
        entries = np.repeat(top_nodes[None, :1].astype(np.int64), len(block), 0)
        for level in range(len(index["layers"]) - 1, -1, -1):
            nodes, lists = index["layers"][level]
            neighbours = np.full((len(units), lists.shape[1]), -1, np.int32)
            neighbours[nodes] = lists
            entries = _beam_search(units, neighbours, asked, entries, beam if level == 0 else UPPER_BEAM)
        exact = cosines(vectors[entries], block[:, None, :])
        exact[entries < 0] = -np.inf
        for place, (query_id, nodes, scores) in enumerate(zip(query_ids[begin : begin + _BLOCK].tolist(), entries, exact)):
            hits = []
            for at in np.argsort(-scores, kind="stable"):
                if nodes[at] < 0 or len(hits) >= k and scores[at] < hits[k - 1][0]:
                    break
                first, last = index["id_starts"][nodes[at]], index["id_starts"][nodes[at] + 1]
                ids = index["ids"][first : min(last, first + k + 1)].tolist()
                if query_id in ids and (vectors[nodes[at]] == block[place]).all():
                    ids.remove(query_id)
                hits += [(scores[at], i) for i in ids[:k]]
            hits.sort(key=lambda h: (-h[0], h[1]))
            out += [(begin + place, i, float(score)) for score, i in hits[:k]]
    return out


def _packed(index: dict) -> dict:
    layers = [{"nodes": n.tobytes(), "neighbours": lists.tobytes()} for n, lists in index["layers"]]
    return {
        "ids": index["ids"].astype(np.int64).tobytes(),
        "id_starts": index["id_starts"].astype(np.int64).tobytes(),
        "vectors": index["vectors"].tobytes(),
        "layers": layers,
    }


def _unpacked(row: dict) -> dict:
    layers = [(np.frombuffer(x["nodes"], np.int32), np.frombuffer(x["neighbours"], np.int32)) for x in row["layers"]]
    return {
        "ids": np.frombuffer(row["ids"], np.int64),
        "id_starts": np.frombuffer(row["id_starts"], np.int64),
        "vectors": np.frombuffer(row["vectors"], float).reshape(-1, row["width"]),
        "layers": [(nodes, lists.reshape(len(nodes), -1)) for nodes, lists in layers],
    }


def _matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.array(vectors.combine_chunks().flatten(), float).reshape(-1, width)


def build_index(vectors: DataFrame, shard_rows: int = SHARD_ROWS, links: int = LINKS) -> DataFrame:
    """One row per shard with its graph; all rows are indexed.

    ``vectors`` has ``vec_id`` and ``vector`` (doubles, not zero). Shards hold
    vectors of one length and a bounded number of them.
    """
    shards = shard_count(vectors.count(), shard_rows)
    schema = pa.schema(
        [
            ("width", pa.int32()),
            ("shard", pa.int32()),
            ("ids", pa.binary()),
            ("id_starts", pa.binary()),
            ("vectors", pa.binary()),
            ("layers", pa.list_(pa.struct([("nodes", pa.binary()), ("neighbours", pa.binary())]))),
        ]
    )

    def of(part: pa.Table) -> pa.Table:
        width, shard = part.column("width")[0].as_py(), part.column("shard")[0].as_py()
        ids = part.column("vec_id").to_numpy()
        index = build(ids, _matrix(part.column("vector"), width), links)
        return pa.Table.from_pylist([{"width": width, "shard": shard} | _packed(index)], schema)

    dealt = vectors.select("vec_id", "vector", F.size("vector").alias("width"), shard_of(shards).alias("shard"))
    return staged(dealt.groupBy("width", "shard").applyInArrow(of, INDEX), "index")


def search(
    index: DataFrame, queries: DataFrame, k: int = K, beam: int = BEAM, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """The nearest k found for each query, by cosine, its own row left out.

    Returns ``query_id``, ``rank``, ``vec_id`` and ``score``. A query asks every
    shard of its length; a task has one shard and one bounded group of queries.
    """
    groups = max(1, -(-queries.count() // group_rows))
    shards = (index.agg(F.max("shard")).first()[0] or 0) + 1
    left = index.select("*", every(groups).alias("part"))
    right = queries.select(
        F.size("vector").alias("width"),
        every(shards).alias("shard"),
        shard_of(groups).alias("part"),
        "vec_id",
        "vector",
        asked(),
    )

    def meet(shard: pa.Table, given: pa.Table) -> pa.Table:
        found = []
        if len(shard) and len(given):
            held = _unpacked(shard.to_pylist()[0])
            width = given.column("width")[0].as_py()
            ids, marks = given.column("vec_id").to_numpy(), given.column("asked").to_pylist()
            found = search_shard(held, ids, _matrix(given.column("vector"), width), k, beam)
            found = [(int(ids[at]), marks[at], i, score) for at, i, score in found]
        columns = list(zip(*found)) or [(), (), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        names = ["query_id", "asked", "vec_id", "score"]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    keys = ["width", "shard", "part"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        meet, "query_id long, asked long, vec_id long, score double"
    )
    return nearest(found, k)


def nearest_neighbours(table: DataFrame, k: int = K, stride: int = QUERY_STRIDE) -> DataFrame:
    """Results for the rows whose id is divisible by the stride, against all rows."""
    vectors = staged(usable(table, non_zero=True), "vectors")
    return search(build_index(vectors), vectors.where(F.col("vec_id") % stride == 0), k)
