"""Repair of conversations: faults found, cheapest edits to a legal order of roles.

Every conversation becomes a signature, a character per row for its role and
fault. Signatures are dealt out by their ends, and an automaton that shares
suffixes holds those of a range; what a repair costs from a state on, and the
edit it begins with, is worked out once per node and state of the grammar.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import staged

# Costs of the edits; an undeleted truncated row costs more.
RENAME, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
DAMAGES = 20
# States of the grammar (s?(ua)+)?: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {START: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}
_FINAL = (START, ASSISTANT)
_NO = 1 << 60
# Signature characters: s, u, a or x for the role, upper case if the row is
# truncated, and this one for a row that must go.
GONE = "-"

_VISIBLE = r"[^\x20\x09-\x0D]"
_ENDED = r"[.!?][\x20\x09-\x0D]*\z"
_LEGAL = {"su", "ua", "au"}

REPORT = (
    "conv_id long, signature string, gaps long, blank long, duplicate long, truncated long, illegal long"
)
EDITED = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "place long, edit string, role string, text string"
)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role`` and ``text`` after the damage each row's number
    stands for; a null counts as one space there and in role and text.

    A dropped row stays, with ``dropped`` true, so that its conversation is known.
    """
    spaced = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    key = F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        spaced("role").alias("role"),
        spaced("text").alias("text"),
        (F.crc32(key.cast("binary")) % DAMAGES).alias("damage"),
    )
    text = (
        F.when(F.col("damage") == 1, "")
        .when(F.col("damage") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    copies = F.when(F.col("damage") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("damage") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("damage") == 0).alias("dropped"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def _placed(rows: DataFrame) -> DataFrame:
    """Rows with ``same``, 16 bytes of role and text, by which rows of one turn are ordered."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    same = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), "dropped", same.alias("same"))


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = [field.split() for field in schema.split(", ")]
    columns = [pa.array(c, kinds[kind]) for c, (_, kind) in zip(zip(*rows), fields)]
    return pa.RecordBatch.from_arrays(columns, [name for name, _ in fields])


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signature and counts of each conversation, whose rows come in order."""
    held, found = None, []

    def closed() -> tuple:
        conv_id, marks, span, counts, illegal, _ = held
        gaps = span[1] - span[0] + 1 - span[2] if span else 0
        return conv_id, "".join(marks), gaps, counts["b"], counts["d"], counts["t"], illegal

    for batch in batches:
        for row in batch.to_pylist():
            if held is None or row["conv_id"] != held[0]:
                if held:
                    found.append(closed())
                held = [row["conv_id"], [], None, {"b": 0, "d": 0, "t": 0}, 0, None]
            if row["dropped"]:
                continue
            turn, initial, fault = row["turn"], row["initial"], row["fault"]
            if turn is not None:
                span = held[2]
                held[2] = (span[0], turn, span[2] + (turn != span[1])) if span else (turn, turn, 1)
            if fault != "b" and not row["first"]:
                fault = "d"
            if fault:
                held[3][fault] += 1
            held[4] += held[5] is not None and held[5] + initial not in _LEGAL
            held[5] = initial
            mark = initial if initial and initial in "sua" else "x"
            held[1].append(GONE if fault in ("b", "d") else mark.upper() if fault else mark)
        if found:
            yield _batch(found, REPORT)
            found = []
    if held:
        yield _batch([closed()], REPORT)


def signatures(placed: DataFrame) -> DataFrame:
    """``signature``, ``gaps`` and counts of faults of every conversation.

    Rows go by ``turn``, null first, those of a turn by a digest. Which of equal rows
    comes first is found by conversation and row, so that a task holds a character
    per row of one conversation and nothing else.
    """
    order = Window.partitionBy("conv_id", "same", "dropped").orderBy("turn")
    fault = F.when(~F.col("text").rlike(_VISIBLE), "b").when(F.col("text").rlike(_ENDED), "").otherwise("t")
    slim = placed.select("conv_id", "turn", "same", "dropped", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))
    marked = slim.withColumn("first", F.row_number().over(order) == 1)
    dealt = marked.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "same", F.desc("first"))
    return dealt.mapInArrow(_signed, REPORT)


def _after_kept(state: int, role: str) -> int | None:
    if state == START and role == "s":
        return SYSTEM
    wanted, _ = _NEXT[state]
    return wanted if role == {USER: "u", ASSISTANT: "a"}[wanted] else None


def _with_inserts(table: list[tuple[int, str]]) -> tuple[tuple[int, str], ...]:
    """Costs and first edits, an inserted turn before this place being one more edit."""
    costs = list(table)
    for state in (USER, ASSISTANT):
        costs[state] = min(table[state], (table[_NEXT[state][0]][0] + INSERT, "I"))
    for state in (START, SYSTEM):
        costs[state] = min(table[state], (costs[USER][0] + INSERT, "I"))
    return tuple(costs)


#: Cost to go and first edit by state, where no rows are left.
LAST = _with_inserts([(0, "") if state in _FINAL else (_NO, "") for state in range(4)])


def _before(mark: str, after: tuple[tuple[int, str], ...]) -> tuple[tuple[int, str], ...]:
    """Cost to go and first edit by state before a row, from those after it.

    Edits of equal cost have different initials, so the least initial is the start
    of the least audit.
    """
    table = []
    for state in range(4):
        ways = [(after[state][0] + DELETE, "D")]
        if mark != GONE:
            extra = TRUNCATED if mark.isupper() else 0
            ways.append((after[_NEXT[state][0]][0] + RENAME + extra, "R"))
            if (kept := _after_kept(state, mark.lower())) is not None:
                ways.append((after[kept][0] + extra, "K"))
        table.append(min(ways))
    return _with_inserts(table)


class Automaton:
    """Suffixes of signatures, one node for each, and what is cheapest from there.

    A node is a mark and the node after it; both are registered, so equal suffixes
    are one node however many signatures end in them. ``trim`` forgets nodes that
    sorted signatures can't meet again.
    """

    def __init__(self):
        self.tables = [LAST]
        self.after = [0]
        self.mark = [""]
        self.register: dict[tuple[str, int], int] = {}

    def node(self, mark: str, after: int) -> int:
        found = self.register.get((mark, after))
        if found is None:
            found = self.register[mark, after] = len(self.tables)
            self.tables.append(_before(mark, self.tables[after]))
            self.after.append(after)
            self.mark.append(mark)
        return found

    def trim(self, kept: list[int]) -> None:
        """Keep only nodes of the stack, which come in the order they were made."""
        if len(self.tables) > kept[-1] + 1:
            for node in range(kept[-1] + 1, len(self.tables)):
                del self.register[self.mark[node], self.after[node]]
            del self.tables[kept[-1] + 1 :], self.after[kept[-1] + 1 :], self.mark[kept[-1] + 1 :]

    def audit(self, node: int) -> tuple[int, str]:
        """Cost and initials of the cheapest edits from a node on."""
        cost, state, letters = self.tables[node][START][0], START, []
        while letter := self.tables[node][state][1]:
            letters.append(letter)
            if letter in "IR":
                state = _NEXT[state][0]
            elif letter == "K":
                state = _after_kept(state, self.mark[node].lower())
            if letter != "I":
                node = self.after[node]
        return cost, "".join(letters)


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audits of signatures that come sorted by what they end in."""
    automaton, stack, before = Automaton(), [0], ""
    for batch in batches:
        found = []
        for backward in batch.column("backward").to_pylist():
            same = 0
            for one, two in zip(backward, before):
                if one != two:
                    break
                same += 1
            del stack[same + 1 :]
            automaton.trim(stack)
            for mark in backward[same:]:
                stack.append(automaton.node(mark, stack[-1]))
            found.append((backward[::-1], *automaton.audit(stack[-1])))
            before = backward
        if found:
            yield _batch(found, "signature string, cost long, audit string")


def audits(signed: DataFrame) -> DataFrame:
    """``cost`` and ``audit`` of every signature, each worked out once."""
    backward = signed.select(F.reverse("signature").alias("backward")).distinct()
    dealt = backward.repartitionByRange("backward").sortWithinPartitions("backward")
    return dealt.mapInArrow(_audited, "signature string, cost long, audit string")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired turns of conversations whose report comes first and rows in order."""
    report = None
    for batch in batches:
        found = []
        for row in batch.to_pylist():
            if row["audit"] is not None:
                if report:
                    found += _inserted(report)
                report = [row["conv_id"], row["audit"], 0, START, 0]
                counts = [row[n] for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
                found.append((row["conv_id"], *counts, row["audit"], 0, None, None, None))
                continue
            found += _inserted(report)
            conv_id, audit, at, state, _ = report
            letter, role = audit[at], row["role"]
            report[2] += 1
            if letter == "D":
                continue
            if letter == "R":
                report[3], role = _NEXT[state]
            else:
                report[3] = _after_kept(state, role[0])
            report[4] += 1
            found.append((conv_id, *[None] * 7, report[4], letter, role, row["text"]))
        if found:
            yield _batch(found, EDITED)
    if report and (found := list(_inserted(report))):
        yield _batch(found, EDITED)


def _inserted(report: list) -> Iterator[tuple]:
    """Turns that the audit inserts at this place."""
    conv_id, audit, *_ = report
    while report[2] < len(audit) and audit[report[2]] == "I":
        report[3], role = _NEXT[report[3]]
        report[2] += 1
        report[4] += 1
        yield (conv_id, *[None] * 7, report[4], "I", role, "")


def repaired(rows: DataFrame) -> DataFrame:
    """Reports and repaired turns of conversations, together in one stream.

    ``rows`` has ``conv_id``, ``turn``, ``role``, ``text`` and ``dropped``; other
    columns play no part. Every conversation has a row with ``place`` 0, the counts
    of faults, ``cost`` and ``audit`` (initials of Keep, Rerole, Delete, Insert), then
    a row per turn of its repaired form, numbered by ``place``, with the edit that
    made it. A row's first fault counts: blank, duplicate, truncated. A null role or
    text is one space; rows without ``conv_id`` are one conversation; an empty role has
    no legal initial. No rows, no reports. The rows of a conversation lie together in
    order, and are streamed: only its audit is held.
    """
    placed = _placed(rows)
    signed = staged(signatures(placed), "signatures")
    report = signed.join(audits(signed), "signature").drop("signature")
    none = lambda *names: [F.lit(None).cast(t).alias(n) for n, t in names]
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    heads = report.select(
        "conv_id", F.lit(0).alias("kind"), *none(("turn", "long"), ("same", "binary"), ("role", "string"), ("text", "string")), *counts
    )
    kinds = [*((n, "long") for n in counts[:-1]), ("audit", "string")]
    lines = placed.where("NOT dropped").select("conv_id", F.lit(1).alias("kind"), "turn", "same", "role", "text", *none(*kinds))
    dealt = heads.union(lines).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "same")
    return dealt.mapInArrow(_edited, EDITED)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reports with the SHA-256 of the repaired turns that follow each."""
    head, state = None, None
    schema = EDITED.split(", place")[0] + ", repaired_sha256 string"
    for batch in batches:
        found = []
        for row in batch.to_pylist():
            if row["place"] == 0:
                if head:
                    found.append((*head, state.hexdigest()))
                head, state = list(row.values())[:8], hashlib.sha256()
                continue
            line = f"{row['role']}:{row['text']}"
            state.update((line if row["place"] == 1 else "\n" + line).encode())
        if found:
            yield _batch(found, schema)
    if head:
        yield _batch([(*head, state.hexdigest())], schema)


def digests(edited: DataFrame) -> DataFrame:
    """The reports of ``repaired`` with ``repaired_sha256``, of its ``role:text`` lines
    joined by newlines, without another shuffle."""
    return edited.mapInArrow(_digested, EDITED.split(", place")[0] + ", repaired_sha256 string")
