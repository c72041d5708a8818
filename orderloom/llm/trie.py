"""Prefix trie of conversations from their sorted order.

Conversations are sorted by their turns and dealt into ranges. In a range, the
common lengths of neighbours are edges; union-find over them, deepest first,
makes a branching node of every merge. Nodes on a range's first or last
conversation may go on in the next range: of these a range gives out shares,
which are summed by node.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from orderloom.llm.common import WORD, staged

FAMILY = 20
SHARED_TURNS = 4
TURN_BYTES = 16
# Characters of ids put into one piece before a node's pieces meet in one task.
PIECE_CHARACTERS = 1 << 16
NO_ENDS = hashlib.sha256(b"").hexdigest()

# A closed node has all its values but perhaps its parent's conv_id, which then is
# that of the open node ``up``. An open one has shares: ``weighted`` and ``once`` are
# sums of words over its subtree, by members and by nodes.
_FIELDS = {
    "part": pa.int32(),
    "kind": pa.string(),
    "conv_id": pa.int64(),
    "depth": pa.int64(),
    "parent_conv_id": pa.int64(),
    "n_convs": pa.int64(),
    "n_children": pa.int64(),
    "n_leaves": pa.int64(),
    "weighted": pa.int64(),
    "once": pa.int64(),
    "ends_sha256": pa.string(),
    "key": pa.binary(),
    "up": pa.binary(),
    "on_first": pa.bool_(),
    "on_last": pa.bool_(),
    "first": pa.binary(),
    "last": pa.binary(),
    "reach": pa.list_(pa.int64()),
}
_NODES = (
    "part int, kind string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, weighted long, once long, ends_sha256 string, key binary, up binary, on_first boolean, "
    "on_last boolean, first binary, last binary, reach array<long>"
)


def turn_key(role: Column, text: Column) -> Column:
    """16 bytes of a turn's role and text, in hexadecimal."""
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def shared_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from the first of its family."""
    return F.crc32(conv_id.cast("string").cast("binary")) % SHARED_TURNS


def rebuilt(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``path`` (turn keys in a row) and ``words`` of each turn.

    Turns go by ``turn``, null first, ties by their keys. A null role or text is
    empty; rows without ``conv_id`` belong to no conversation and are left out.
    A conversation is one record here, of some 20 bytes a turn; texts aren't gathered.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").cast("long").alias("turn"),
            turn_key(role, text).alias("key"),
            F.regexp_count(text, F.lit(WORD)).alias("words"),
        ).alias("turn"),
    )
    own = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("own"))
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = own.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("family"), F.slice("own", 1, SHARED_TURNS - 1).alias("head")
    )
    joined = own.withColumn("family", family).join(heads, "family", "left").withColumn("shared", shared_turns(F.col("conv_id")).cast("int"))
    whole = F.concat(
        F.coalesce(F.slice("head", F.lit(1), F.col("shared")), F.expr("slice(own, 1, 0)")),
        F.slice("own", F.col("shared") + 1, F.size("own")),
    )
    return joined.withColumn("turns", whole).select(
        "conv_id", F.unhex(F.array_join("turns.key", "")).alias("path"), F.col("turns.words").alias("words")
    )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of one path, in order, put into texts of bounded length."""
    held, size, now, first = [], 0, None, None

    def row() -> pa.RecordBatch:
        columns = [pa.array([now], pa.binary()), pa.array([first], pa.int64()), pa.array([",".join(held)], pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["path_key", "first", "ids"])

    for batch in batches:
        for key, conv_id in zip(batch.column("path_key").to_pylist(), batch.column("conv_id").to_pylist()):
            if held and (key != now or size >= PIECE_CHARACTERS):
                yield row()
                held, size = [], 0
            if not held:
                now, first = key, conv_id
            held.append(str(conv_id))
            size += len(held[-1]) + 1
    if held:
        yield row()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each path's pieces, which come in order; one piece is held at a time."""
    now, state, found = None, None, []
    for batch in batches:
        for key, ids in zip(batch.column("path_key").to_pylist(), batch.column("ids")):
            if key == now:
                state.update(b",")
            else:
                if state:
                    found.append((now, state.hexdigest()))
                now, state = key, hashlib.sha256()
            state.update(ids.as_py().encode())
        if found:
            yield _ends(found)
            found = []
    if state:
        yield _ends([(now, state.hexdigest())])


def _ends(found: list[tuple[bytes, str]]) -> pa.RecordBatch:
    columns = [pa.array([k for k, _ in found], pa.binary()), pa.array([e for _, e in found], pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["path_key", "ends"])


def endings(paths: DataFrame) -> DataFrame:
    """SHA-256 of the ids of the conversations that are equal, by ``path_key``.

    A digest has to be taken in one row; what it takes comes as few long texts.
    """
    ordered = paths.select("path_key", "conv_id").repartitionByRange("path_key", "conv_id")
    pieces = ordered.sortWithinPartitions("path_key", "conv_id").mapInArrow(_pieces, "path_key binary, first long, ids string")
    dealt = pieces.repartition("path_key").sortWithinPartitions("path_key", "first")
    return dealt.mapInArrow(_hashed, "path_key binary, ends string")


def common_turns(one: bytes, two: bytes) -> int:
    """Number of turns two paths have in common from the start."""
    most = min(len(one), len(two)) // TURN_BYTES
    if one[: most * TURN_BYTES] == two[: most * TURN_BYTES]:
        return most
    a = np.frombuffer(one, np.uint8, most * TURN_BYTES).reshape(-1, TURN_BYTES)
    b = np.frombuffer(two, np.uint8, most * TURN_BYTES).reshape(-1, TURN_BYTES)
    return int(np.argmax((a != b).any(1)))


class Forest:
    """Compressed trie of sorted distinct paths: chains of nodes with equal members.

    A chain runs from depth ``low`` to ``high``; only its deepest node branches or
    ends conversations. A component of the union-find is a subtree whose uppermost
    chain still grows: ``high`` is fixed, ``low`` is found when it is merged.
    """

    def __init__(self, paths: list[bytes], least: list[int], sizes: list[int], words: list[list[int]], ends: list[str]):
        self.paths, self.words, self.chains = paths, words, []
        count = len(paths)
        self.parent = list(range(count))
        # Subtree by its root leaf: high, conv_id, members, children, leaves, weighted, once, ends, left, right, chains below.
        self.tree = [
            [len(p) // TURN_BYTES, least[i], sizes[i], 0, 1, 0, 0, ends[i], i, i, []] for i, p in enumerate(paths)
        ]
        edges = [common_turns(a, b) for a, b in itertools.pairwise(paths)]
        for left in np.argsort(-np.array(edges, np.int64), kind="stable").tolist():
            self._merge(self._find(left), self._find(left + 1), edges[left])
        if count:
            top = self._find(0)
            if self.tree[top][0] > 0:
                self._lift(top, 0)
            self._close(top, 0)

    def _find(self, leaf: int) -> int:
        while self.parent[leaf] != leaf:
            self.parent[leaf] = self.parent[self.parent[leaf]]
            leaf = self.parent[leaf]
        return leaf

    def _close(self, root: int, low: int) -> list:
        """Give out the uppermost chain of a subtree, whose nodes reach up to ``low``."""
        high, conv_id, members, children, leaves, weighted, once, ends, left, right, below = self.tree[root]
        path = self.words[left][max(low, 1) - 1 : high]
        chain = [low, high, conv_id, members, children, leaves, weighted, once, ends, left, right, path, None]
        for lower in below:
            lower[-1] = chain
        self.chains.append(chain)
        return chain

    def _lift(self, root: int, depth: int) -> None:
        """Make the node at ``depth`` over a subtree that ends below it."""
        tree = self.tree[root]
        chain = self._close(root, depth + 1)
        total = sum(chain[11])
        tree[0], tree[3], tree[7] = depth, 1, NO_ENDS
        tree[5], tree[6], tree[10] = tree[5] + tree[2] * total, tree[6] + total, [chain]

    def _merge(self, left: int, right: int, depth: int) -> None:
        """Put two neighbours below one node; same depths come from left to right,
        so the right one always ends below it."""
        if self.tree[left][0] > depth:
            self._lift(left, depth)
        self._lift(right, depth)
        one, two = self.tree[left], self.tree[right]
        # Children of the node so far are below the left one; a path that ends there has none.
        one[1], one[2], one[3] = min(one[1], two[1]), one[2] + two[2], one[3] + 1
        one[4] = two[4] + (one[4] if one[3] > 1 else 0)
        one[5], one[6], one[9] = one[5] + two[5], one[6] + two[6], two[9]
        one[10] = one[10] + two[10] if len(one[10]) < len(two[10]) else (one[10].extend(two[10]) or one[10])
        self.parent[right] = left


def _rows(part: int, forest: Forest) -> Iterator[tuple]:
    """A row per node of a range, and one with its first and last path."""
    last = len(forest.paths) - 1
    keys = {}  # of the nodes on the first and on the last path
    for end in {0, last}:
        path, key, found = forest.paths[end], b"", [b""]
        for at in range(0, len(path), TURN_BYTES):
            key = hashlib.md5(key + path[at : at + TURN_BYTES]).digest()
            found.append(key)
        keys[end] = found
    for low, high, conv_id, members, children, leaves, weighted, once, ends, left, right, words, above in forest.chains:
        outer = 0 if left == 0 else last if right == last else None
        above_outer = above is not None and (above[9] == 0 or above[10] == last)
        for depth in range(high, low - 1, -1):
            if depth:
                weighted, once = weighted + members * words[depth - max(low, 1)], once + words[depth - max(low, 1)]
            parent = conv_id if depth > low else above and above[2]
            key = up = None
            if outer is not None:
                key = keys[outer][depth]
                up = keys[outer][depth - 1] if depth else None
            elif depth == low and above_outer:
                up = keys[0 if above[9] == 0 else last][depth - 1]
            yield (
                *(part, "closed" if outer is None else "open", conv_id, depth, parent if up is None else None, members),
                *(children if depth == high else 1, leaves, weighted, once, ends if depth == high else NO_ENDS, key, up),
                *(left == 0, right == last, None, None, None),
            )
    reach = [0, *itertools.accumulate(forest.words[0])]
    yield (part, "edge", *[None] * 13, forest.paths[0], forest.paths[last], reach)


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = {name: [] for name in ("path", "conv_id", "n", "words", "ends")}
    for batch in batches:
        for name, column in table.items():
            column += batch.column(name).to_pylist()
    if not table["path"]:
        return
    rows = _rows(TaskContext.get().partitionId(), Forest(*table.values()))
    while taken := list(itertools.islice(rows, 5000)):
        columns = [pa.array(c, k) for c, k in zip(zip(*taken), _FIELDS.values())]
        yield pa.RecordBatch.from_arrays(columns, list(_FIELDS))


def _previous(edges: DataFrame) -> DataFrame:
    """Each range with the paths of its neighbours, found in lots of ranges and,
    where a lot begins or ends, between lots."""
    lots = edges.withColumn("lot", F.col("part").bitwiseAND(~1023))
    within, over = Window.partitionBy("lot").orderBy("part"), Window.orderBy("lot")
    ends = lots.groupBy("lot").agg(F.min_by("first", "part").alias("first"), F.max_by("last", "part").alias("last"))
    ends = ends.select("lot", F.lag("last").over(over).alias("lot_before"), F.lead("first").over(over).alias("lot_after"))
    near = lots.withColumns({"before": F.lag("last").over(within), "after": F.lead("first").over(within)})
    return near.join(ends, "lot").select(
        "part", "first", "last", "reach",
        F.coalesce("before", "lot_before").alias("before"), F.coalesce("after", "lot_after").alias("after"),
    )


@F.pandas_udf(LongType())
def _common(one, two):
    return type(one)([-1 if a is None or b is None else common_turns(bytes(a), bytes(b)) for a, b in zip(one, two)])


def trie(paths: DataFrame) -> DataFrame:
    """Nodes of the trie of ``conv_id``, ``path`` and ``words``.

    Returns ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and
    ``ends_sha256``. No paths, no nodes.
    """
    paths = staged(paths.withColumn("path_key", F.unhex(F.md5("path"))), "paths")
    classes = paths.groupBy("path_key").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n"), F.first(F.struct("path", "words")).alias("same")
    )
    whole = classes.join(endings(paths), "path_key").select("same.path", "conv_id", "n", "same.words", "ends")
    ordered = staged(whole, "classes").repartitionByRange("path").sortWithinPartitions("path")
    nodes = staged(ordered.mapInArrow(_nodes, _NODES), "nodes")

    near = _previous(nodes.where("kind = 'edge'").select("part", "first", "last", "reach"))
    near = near.select(
        "part",
        "reach",
        _common("before", "first").alias("behind"),
        (_common("last", "after") * TURN_BYTES == F.length("last")).alias("goes_on"),
    ).withColumn("reached", F.get("reach", F.col("behind").cast("int")))
    shares = nodes.where("kind = 'open'").drop("reach").join(near, "part")
    again = F.col("on_first") & (F.col("depth") <= F.col("behind"))
    own = F.when(F.col("depth") > 0, F.get("reach", (F.col("depth") - 1).cast("int"))).otherwise(0)
    merged = shares.groupBy("depth", "key").agg(
        F.min("conv_id").alias("conv_id"),
        F.max("up").alias("up"),
        F.sum("n_convs").alias("n_convs"),
        F.sum(F.col("n_children") - F.when(F.col("on_first") & (F.col("depth") < F.col("behind")), 1).otherwise(0)).alias("n_children"),
        F.sum(F.col("n_leaves") - F.when(F.col("on_last") & F.col("goes_on"), 1).otherwise(0)).alias("n_leaves"),
        F.sum(F.col("weighted") - F.col("once") + F.when(again, F.col("reached") - own).otherwise(0)).alias("saved_tokens"),
        F.coalesce(F.max(F.when(F.col("ends_sha256") != NO_ENDS, F.col("ends_sha256"))), F.lit(NO_ENDS)).alias("ends_sha256"),
    )
    merged = staged(merged, "merged")
    tops = merged.select(F.col("depth").alias("up_depth"), F.col("key").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]

    def below(rows: DataFrame) -> DataFrame:
        placed = rows.withColumn("up_depth", F.col("depth") - 1)
        return placed.join(tops, ["up_depth", "up"], "left").select(columns)

    closed = nodes.where("kind = 'closed'").withColumn("saved_tokens", F.col("weighted") - F.col("once"))
    inner = closed.where("up IS NULL").select(columns)
    return inner.union(below(closed.where("up IS NOT NULL").drop("parent_conv_id"))).union(below(merged))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Nodes of the trie of the rebuilt conversations."""
    return trie(rebuilt(conversations))
