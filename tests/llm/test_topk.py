import math
import random

import numpy as np
import pytest

from orderloom.llm import topk
from orderloom.llm.queries import op3_exact_topk
from orderloom.llm.sql import _top_products
from tests.compare import connect, difference

SCHEMA = "vec_id long, embedding array<float>, label int, score double, shard int"


def vectors(seed=0, size=150, width=6):
    draw = random.Random(seed)
    rows = [(i, [draw.gauss(0, 0.4) for _ in range(width)]) for i in range(size)]
    rows += [(size + i, rows[7][1]) for i in range(40)]  # a common vector
    rows += [(300, None), (320, []), (340, [None] * width), (360, [math.nan] + [0.1] * (width - 1))]
    rows += [(380, [math.inf] * width), (400, [0.0] * width), (420, [0.5, -0.5]), (421, [0.25, 1.0]), (None, [0.1] * width)]
    rows += [rows[3], rows[20]]  # repeated rows, and ids with other vectors
    rows += [(i, [draw.gauss(0, 0.4) for _ in range(width)]) for i in (20, 20, 40, 41)] + [(40, rows[7][1])]
    return [(i, v, None, 0.5, 7) for i, v in rows]


def usable(rows):
    """Different pairs of an id and a vector."""
    kept = set()
    for i, v, *_ in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            kept.add((i, tuple(float(np.float32(x)) for x in v)))
    return sorted(kept)


def brute(rows, k, stride):
    kept = sorted({(i, tuple(math.floor(64 * x) for x in v)) for i, v in usable(rows)})
    result = []
    for q in kept:
        if q[0] % stride == 0:
            found = [(-sum(a * b for a, b in zip(q[1], v)), i) for i, v in kept if (i, v) != q and len(v) == len(q[1])]
            result += [(q[0], rank, i, -s) for rank, (s, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(result)


@pytest.mark.parametrize("k", [3, 20, 500])
def test_by_definition(spark, k):
    rows = vectors()
    found = topk.top_products(spark.createDataFrame(rows, SCHEMA).repartition(3), k)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect())) == brute(rows, k, 20)


def test_many_groups_and_shards(spark):
    rows = vectors(seed=2)
    every = topk.quantised(spark.createDataFrame(rows, SCHEMA))
    found = topk.search(every, every.where("vec_id % 20 = 0"), 5, shard_rows=9, group_rows=2)
    assert sorted(map(tuple, found.collect())) == brute(rows, 5, 20)


@pytest.mark.parametrize("scale", [3, 1 << 40])
def test_reading_stops_early_and_ties_go_to_small_ids(scale):
    draw = np.random.default_rng(1)
    rows = draw.integers(-3, 4, (400, 4)) * np.array([20, 1, 1, 1])
    rows[:, 1:] *= 1
    big = rows * (scale if scale > 3 else 1)
    ids = draw.permutation(1000)[:400]
    queries = np.concatenate([rows[:30], [[0, 0, 0, 0]]])
    lists = topk.SortedLists(ids, big)
    asked = np.append(ids[:30], 5000)
    for at, (place, found, scores) in enumerate(lists.top(asked, queries, 7)):
        query_id = asked[place]
        exact = [(-int(sum(int(a) * int(b) for a, b in zip(v, queries[at]))), int(i)) for i, v in zip(ids, big) if i != query_id]
        assert list(zip((-scores).tolist(), found.tolist())) == sorted(exact)[:7]


def test_bound_skips_rows():
    rows = np.zeros((4000, 2), np.int64)
    rows[:, 0] = np.arange(4000)
    lists = topk.SortedLists(np.arange(4000), rows)
    read = []
    plain, lists.rows = lists.rows, _Counting(lists.rows, read)
    (_, found, _), = lists.top(np.array([-1]), np.array([[1, 0]]), 3)
    assert found.tolist() == [3999, 3998, 3997] and max(read) < len(plain)


class _Counting:
    def __init__(self, rows, read):
        self.rows, self.read = rows, read

    def astype(self, kind):
        return _Counting(self.rows.astype(kind), self.read)

    def __getitem__(self, part):
        self.read.append(part.stop)
        return self.rows[part]


def test_against_sql(spark, tmp_path):
    spark.createDataFrame(vectors(), SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/v")
    next((tmp_path / "v").glob("*.parquet")).rename(tmp_path / "embeddings.parquet")
    assert difference(spark, connect(str(tmp_path)), str(tmp_path), op3_exact_topk, _top_products()) is None


def test_no_vectors(spark):
    assert topk.top_products(spark.createDataFrame([], SCHEMA)).collect() == []
