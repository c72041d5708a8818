import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from orderloom.llm import trie
from orderloom.llm.sql import ORACLE
from tests.compare import connect

SCHEMA = "conv_id long, turn long, role string, text string, path string, words int"


def conversations(seed=1, size=150):
    """Shared starts, equal conversations, long ones, nulls, ties, repeated rows, odd white space."""
    draw = random.Random(seed)
    rows = []
    for c in [*range(size), -1, -20, -41, 10**15]:
        if c % 23 == 5:
            continue
        for turn in range(draw.choice([1, 2, 2, 3, 3, 4, 6])):
            text = draw.choice(["hi", "one two", "three \x0b four  five", ""]) if draw.random() < 0.8 else f"own {c} words"
            rows.append((c, turn, draw.choice(["user", "assistant"]) if turn else "user", text))
    rows += [(300 + i, t, "user", f"t{t}") for i in range(30) for t in range(3)]
    rows += [(340, t, "user", f"t{t}" + " x" * (t % 3)) for t in range(120)]
    rows += [(360, None, "system", "s"), (360, None, "system", "s"), (360, 5, None, "x"), (360, 6, "user", None), (361, 1, "", "")]
    rows += [(None, 0, "user", "no id"), (None, None, None, None)]
    draw.shuffle(rows)
    return [(*r, "p", 7) for r in rows]


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    for c, turns in own.items():
        turns.sort(key=lambda t: (t[0], t[1], hashlib.md5(f"{len(t[2])}:{t[2]}{t[3]}".encode()).hexdigest()))
        own[c] = [t[2:] for t in turns]
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        family = c - (c % 20 if c >= 0 else -(-c % 20))
        whole = tuple(own.get(family, [])[:h] + turns[h:])
        ends[whole].append(c)
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, found in members.items():
        worth = (len(found) - 1) * len(path[-1][1].encode().split()) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += worth
            leaves[path[:d]] += path not in children
    return sorted(
        (
            min(found),
            len(path),
            min(members[path[:-1]]) if path else None,
            len(found),
            children[path],
            leaves[path],
            saved[path],
            hashlib.sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest(),
        )
        for path, found in members.items()
    )


def found(table):
    return sorted(tuple(r) for r in table.collect())


@pytest.mark.parametrize("ranges", ["1", "7", "60"])
def test_by_definition(spark, ranges):
    rows = conversations()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        table = trie.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(3))
        assert table.columns == [
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
        ]
        assert found(table) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("seed", range(20))
def test_forest_by_definition(seed):
    """One range against a plain trie of its paths."""
    draw = random.Random(seed)
    paths = {tuple(draw.randrange(3) for _ in range(draw.randrange(7))) for _ in range(draw.randrange(1, 40))}
    paths = sorted(paths)
    wide = [b"".join(bytes([t]) * 16 for t in p) for p in paths]
    sizes = [draw.randrange(1, 4) for _ in paths]
    forest = trie.Forest(wide, list(range(len(paths))), sizes, [[t + 1 for t in p] for p in paths], ["e"] * len(paths))
    nodes = defaultdict(int)
    for p, n in zip(paths, sizes):
        for d in range(len(p) + 1):
            nodes[p[:d]] += n
    given = [r for r in trie._rows(0, forest) if r[1] != "edge"]
    assert sorted((r[3], r[5]) for r in given) == sorted((len(p), n) for p, n in nodes.items())
    assert sum(r[6] for r in given) == len(nodes) - 1 and sum(r[10] == "e" for r in given) == len(paths)


def test_pieces_of_a_hot_path(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE_CHARACTERS", 20)
    rows = [(b"k" * 16, i) for i in range(500)] + [(b"a" * 16, 1000)]
    table = spark.createDataFrame(rows, "path_key binary, conv_id long")
    ends = {bytes(r.path_key): r.ends for r in trie.endings(table).collect()}
    assert ends[b"k" * 16] == hashlib.sha256(",".join(map(str, range(500))).encode()).hexdigest()
    assert ends[b"a" * 16] == hashlib.sha256(b"1000").hexdigest()


def test_empty(spark):
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert found(trie.prefix_trie(spark.createDataFrame([(1, 0, "u", "a b", "", 0)], SCHEMA)))[0][0] == 1


@pytest.mark.skipif("op12_prefix_trie" not in ORACLE, reason="no SQL")
def test_sql_by_definition(tmp_path, spark):
    rows = conversations()
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "t"))
    con = connect("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW conversations AS FROM '{tmp_path}/t/*.parquet'")
    names = "conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256"
    assert sorted(con.execute(f"SELECT {names} FROM ({ORACLE['op12_prefix_trie']})").fetchall()) == brute(rows)
