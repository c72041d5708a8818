from collections import defaultdict

import pytest

from orderloom.llm import mixing
from orderloom.llm.sql import ORACLE
from tests.compare import connect, difference
from tests.llm.fixtures import documents, frame


def shared(sizes):
    """Targets by resharing the excess until no source is above its limit."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        heft = sum(weight[s] for s in names if s not in full)
        level = rest / heft if heft else 0
        above = {s for s in names if s not in full and level * weight[s] > 3 * sizes[s]}
        if not above:
            return {s: 3 * sizes[s] if s in full else level * weight[s] for s in names}
        full |= above


def test_targets(spark):
    rows = documents()
    sizes = defaultdict(int)
    for _, text, _, source, *_ in rows:
        sizes[source] += len((text or "").encode().split())
    goals = shared(sizes)
    found = mixing.mix(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    for row in found:
        assert row.source_size == sizes[row.source]
        assert row.target == pytest.approx(goals[row.source])
        assert 0 <= row.copies <= 3 and row.taken == row.copies * row.size


def test_against_sql_on_documents(spark, tmp_path):
    frame(spark, documents(seed=4)).coalesce(1).write.parquet(f"{tmp_path}/d")
    part = next((tmp_path / "d").glob("*.parquet"))
    part.rename(tmp_path / "documents.parquet")
    query = lambda s, d: mixing.mix(s.read.parquet(f"{d}/documents.parquet")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )
    assert difference(spark, connect(str(tmp_path)), str(tmp_path), query, ORACLE["op9_mixing"]) is None


def test_small_documents_meet_targets(spark):
    rows = [(i, "w " * (i % 7 + 1), None, f"s{i % 5}", 0, None, None) for i in range(3000)]
    taken, target = defaultdict(int), {}
    for row in mixing.mix(frame(spark, rows)).collect():
        taken[row.source] += row.taken
        target[row.source] = row.target
    assert all(abs(taken[s] - target[s]) <= 7 for s in taken)
    again = mixing.mix(frame(spark, rows[::-1], 7)).select("doc_id", "taken")
    assert sorted(again.collect()) == sorted(mixing.mix(frame(spark, rows)).select("doc_id", "taken").collect())


def test_no_words(spark):
    assert mixing.mix(frame(spark, [])).collect() == []
    rows = [(1, None, None, None, 0, None, None), (2, " ", None, "a", 0, None, None)]
    assert {(r.doc_id, r.target, r.taken) for r in mixing.mix(frame(spark, rows)).collect()} == {(1, 0, 0), (2, 0, 0)}
