import numpy as np
import pytest

from orderloom.llm import hnsw
from tests.llm.test_topk import SCHEMA, usable, vectors


def brute(kept, q, k):
    v = np.array(q[1])
    found = []
    for i, w in kept:
        if (i, w) != q and len(w) == len(v):
            w = np.array(w)
            found.append((-float(v @ w / (np.sqrt(v @ v) * np.sqrt(w @ w))), i))
    return sorted(found)[:k]


def test_small_tables_exactly(spark):
    rows = vectors(width=8)
    kept = [(i, v) for i, v in usable(rows) if any(v)]
    found = hnsw.nearest_neighbours(spark.createDataFrame(rows, SCHEMA).repartition(2), stride=10).collect()
    for asked in {i for i, _ in kept if i % 10 == 0}:
        same = [q for q in kept if q[0] == asked]
        exact = [brute(kept, q, 5) for q in same]
        mine = sorted((r for r in found if r.query_id == asked), key=lambda r: r["rank"])
        assert sorted(r["rank"] for r in mine) == sorted(rank for e in exact for rank in range(1, len(e) + 1))
        assert sorted(r.score for r in mine) == pytest.approx(sorted(-s for e in exact for s, _ in e))
        if len(same) == 1:
            least = -exact[0][-1][0] + 1e-9
            assert {r.vec_id for r in mine if r.score > least} == {i for s, i in exact[0] if -s > least}


def test_common_vector_gives_its_smallest_ids(spark):
    rows = vectors(width=8)
    found = hnsw.nearest_neighbours(spark.createDataFrame(rows, SCHEMA), stride=160).where("query_id = 160").collect()
    assert [r.vec_id for r in sorted(found, key=lambda r: r["rank"])] == [7, 40, 150, 151, 152]  # 40 has it as one of its vectors


def test_recall(spark):
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(12, 32))
    points = centres[draw.integers(0, 12, 6000)] + draw.normal(size=(6000, 32)) * 0.8
    ids = np.arange(6000)
    index = hnsw.build(ids, points)
    queries = points[::100]
    close = hnsw._units(queries) @ hnsw._units(points).T
    close[np.arange(60), ids[::100]] = -2
    found = {}
    for q, i, _ in hnsw.search_shard(hnsw._unpacked(hnsw._packed(index) | {"width": 32}), ids[::100], queries):
        found.setdefault(int(ids[::100][q]), set()).add(i)
    exact = np.argsort(-close, 1)[:, :5]
    hits = [len(found[q] & set(e.tolist())) / 5 for q, e in zip(ids[::100].tolist(), exact)]
    assert np.mean(hits) >= 0.9
    nodes, lists = index["layers"][0]
    assert sorted(nodes.tolist()) == ids.tolist() and (lists < len(ids)).all()
    assert all(len(set(r[r >= 0])) == (r >= 0).sum() and n not in r for n, r in zip(nodes[:500], lists[:500]))


def test_groups(spark):
    rows = vectors(width=8)
    every = hnsw.usable(spark.createDataFrame(rows, SCHEMA), non_zero=True)
    index = hnsw.build_index(every, shard_rows=10)
    queries = every.where("vec_id % 10 = 0")
    one, two = (sorted(map(tuple, hnsw.search(index, queries, group_rows=n).collect())) for n in (3, 4096))
    assert one == two and one


def test_no_vectors(spark):
    assert hnsw.nearest_neighbours(spark.createDataFrame([], SCHEMA)).collect() == []
