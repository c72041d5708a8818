import functools
import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from orderloom.llm import turns

SCHEMA = "conv_id long, turn long, role string, text string, first boolean, audit string"
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")


def conversations(seed=2, size=400):
    """All roles, blanks, repeats, gaps, nulls, ties, long conversations, odd line ends."""
    draw, rows = random.Random(seed), []
    texts = ["Hi.", "What?", "open", "a. b", "", " \n", "end!\n", " ", "x. ", "no. ", "Hi.", "é"]
    for c in range(size):
        turn = draw.choice([0, 0, 3, -2])
        for at in range(draw.choice([0, 1, 2, 3, 4, 5, 8])):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "unknown", "", None, "User"])
            if draw.random() < 0.6:
                role = ["user", "assistant"][at % 2]
            text = draw.choice([*texts, None, f"own {c} {at}.", f"own {c} {at}."])
            rows.append((c, None if draw.random() < 0.05 else turn, role, text))
            turn += draw.choice([1, 1, 1, 2, 0])
    rows += [(1000, t, ["user", "assistant"][t % 2], f"{t}.") for t in range(500)]
    rows += [(None, 1, "user", "a."), (None, 2, "assistant", "b."), (2**40, None, None, None), (-5, 3, "system", "S.")]
    draw.shuffle(rows)
    return [(*r, None, "x") for r in rows]


def damage(rows):
    """Rows by conversation, in order, and all ids."""
    left = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        key = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        found = left[c]
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        same = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
        found += [((turn is not None, turn or 0, same), turn, role, text)] * (2 if kind == 3 else 1)
    return {c: [r[1:] for r in sorted(v, key=lambda r: r[0])] for c, v in left.items()}


def cheapest(marks):
    """Cost and audit by trying every edit, longest prefix of costs first."""

    @functools.cache
    def best(at, kept, budget):
        found = []
        if at == len(marks) and re.fullmatch("(s?(ua)+)?", kept):
            found.append((0, "", ()))
        options = []
        if at < len(marks):
            initial, fault = marks[at]
            options.append((2, "D", "", None, at + 1))
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                if initial:
                    options.append((extra, "K", initial, None, at + 1))
                options += [(1 + extra, "R", r[0], r, at + 1) for r in ("user", "assistant")]
        options += [(5, "I", r[0], r, at) for r in ("user", "assistant")]
        for cost, letter, initial, role, after in options:
            seen = kept + initial
            if cost <= budget and (not seen or re.fullmatch("s?(ua)*u?", seen)):
                rest = best(after, seen[-3:] if len(seen) > 4 and False else seen, budget - cost)
                if rest is not None:
                    found.append((cost + rest[0], letter + rest[1], ((letter, role), *rest[2])))
        return min(found, default=None)

    return next(b for b in (best(0, "", budget) for budget in range(100)) if b is not None)


def brute(rows, audit=cheapest):
    result = []
    for c, found in damage(rows).items():
        seen, marks, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in found:
            visible = VISIBLE.findall(text)
            fault = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else ""
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            marks.append((role[:1], fault))
        known = [t for t, *_ in found if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(marks))
        cost, letters, edits = audit(tuple(marks))
        rest, lines = iter(found), []
        for letter, role in edits:
            if letter == "I":
                lines.append(f"{role}:")
                continue
            _, own, text = next(rest)
            if letter != "D":
                lines.append(f"{role or own}:{text}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        result.append((c, gaps, *counts.values(), illegal, cost, letters, digest))
    return sorted(result, key=str)


def found(table):
    return sorted((tuple(r) for r in table.collect()), key=str)


@pytest.mark.parametrize("parts", ["1", "5"])
def test_by_definition(spark, parts):
    rows = [r for r in conversations() if r[0] != 1000]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        table = turns.digests(turns.repaired(turns.damaged(spark.createDataFrame(rows, SCHEMA).repartition(3))))
        assert table.columns == [
            "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
        ]
        given = found(table)
        for one, two in zip(given, brute(rows), strict=True):
            assert one == two
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_audits_of_all_short_signatures():
    automaton = turns.Automaton()
    for size in range(5):
        for marks in itertools.product("suaxUA-", repeat=size):
            node = 0
            for mark in reversed(marks):
                node = automaton.node(mark, node)
            plain = tuple(("" if m == "-" else m.lower(), "blank" if m == "-" else "truncated" if m.isupper() else "") for m in marks)
            assert automaton.audit(node) == cheapest(plain)[:2], marks
    assert len(automaton.tables) == sum(7**n for n in range(5))  # a node per suffix


def test_long_conversation(spark):
    rows = [r for r in conversations() if r[0] == 1000]
    edited = turns.repaired(turns.damaged(spark.createDataFrame(rows, SCHEMA)))
    places = [r.place for r in edited.orderBy("place").collect()]
    assert places == list(range(len(places)))
    roles = "".join(r.role[0] for r in edited.where("place > 0").orderBy("place").collect())
    assert re.fullmatch("s?(ua)+", roles)
    assert edited.where("place = 0").first().cost > 0


def test_empty(spark):
    assert turns.digests(turns.repaired(turns.damaged(spark.createDataFrame([], SCHEMA)))).count() == 0
