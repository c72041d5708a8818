"""Token ids on disk, each block compressed by a Re-Pair grammar of its own.

A folder holds two Parquet tables. ``blocks`` has a row per block: its place
(``shard``, ``block``, ids of the shard ``before`` it), the ids and lengths of its documents, the rules (pairs of
ids, little-endian), the expansion length of each rule and the symbols that are
left. ``shards`` has a row per shard with the number of ids before it. Symbols
from ``FIRST_RULE`` on stand for rules; a rule names ids and earlier rules only.
"""

from __future__ import annotations

import functools
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

END = 2
FIRST_RULE = 1 << 16
# Ids of a block before a new one begins; a document is never parted.
BLOCK_TOKENS = 1 << 20
# A pair becomes a rule from so many occurrences on; a round that takes away less
# than this share of the symbols is the last one.
LEAST_COUNT = 8
LEAST_GAIN = 0.02
_FALL = 4
_COUNTED_BITS = 18
_CACHED = 1_200_000
_BYTES_AT_ONCE = 16 << 20

BLOCKS = (
    "shard int, block int, before long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, "
    "rules binary, spans binary, symbols binary"
)
DOCUMENTS = "doc_id long, before long, n_tokens long, ids binary"

# White space of the tokenizer's splitter. It parts a text before a run without any,
# with the space before it, before the last character of a run of it, and after letters
# that a plain mark follows.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_UNITS = re.compile(f" ?[{_LETTERS}]+(?=[.,;:!? \\n]|\\Z)| ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]")
_PLAIN = re.compile(f" ?[{_LETTERS}]+")
_AFTER = ".,;:!?"
_JOINED = r" [\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]| \z"
_END_BYTES = END.to_bytes(4, "little")


class UnitTokens(dict):
    """Little-endian ids of units, which the tokenizer never joins with others.

    Words are kept; what consists of several units is put together anew.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Latin letters and the space as the splitter writes their bytes.
        latin = " " + "".join(c for c in map(chr, range(256)) if _PLAIN.fullmatch(c))
        self.mapped = {ord(c): self.split(c)[0][0] for c in latin}

    def __missing__(self, unit: str) -> bytes:
        if unit.isascii() and (unit.isalpha() or unit[0] == " " and unit[1:].isalpha()):
            parts = [unit.replace(" ", self.mapped[32])]
        elif unit[-1] in _AFTER and unit.isascii() and unit[-2:-1].isalnum():
            return self[unit[:-1]] + self[unit[-1]]  # no letter or digit goes with a mark after it
        elif _PLAIN.fullmatch(unit):
            parts = [unit.translate(self.mapped)]
        elif len(units := _UNITS.findall(unit)) > 1:
            return b"".join(map(self.__getitem__, units))
        else:
            parts = [part for part, _ in self.split(unit)]
        if len(self) >= _CACHED:
            self.clear()
        self[unit] = ids = array("I", [t.id for p in parts for t in self.model.tokenize(p)]).tobytes()
        return ids

    def whole(self, text: str) -> bytes:
        if any(mark in text for mark in self.special):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.__getitem__, _UNITS.findall(text)))

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts in a row, an end mark after each, and how many each has.

        Texts are parted at spaces, and every different piece is looked up once. A
        text in which a space stands before white space or at the end is taken
        apart as a whole: the tokenizer joins such spaces.
        """
        marked = functools.reduce(pc.or_, (pc.match_substring(texts, m) for m in self.special))
        whole = pc.or_(marked, pc.match_substring_regex(texts, _JOINED)).to_pylist()
        pieces = pc.split_pattern(texts, " ")
        bounds, coded = pieces.offsets.to_pylist(), pieces.values.dictionary_encode()
        known = [
            self[" " + piece] if piece else b"" for piece in coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ]
        found = [known[code] for code in coded.indices.to_numpy().tolist()]
        heads = pieces.values.take(pa.array(bounds[:-1])).to_pylist()
        parts = []
        for text, is_whole, head, start, stop in zip(texts, whole, heads, bounds, bounds[1:]):
            if is_whole:
                parts.append(self.whole(text.as_py()) + _END_BYTES)
            else:
                found[start] = self.whole(head)
                parts.append(b"".join(found[start:stop]) + _END_BYTES)
        return np.frombuffer(b"".join(parts), "<u4"), np.array([len(part) // 4 for part in parts], np.int64)


@functools.lru_cache(maxsize=2)
def _tokens(path: str) -> UnitTokens:
    return UnitTokens(path)


def token_ids(texts: pa.Array, path: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids of texts as the tokenizer gives them, an end mark after each, and how many
    each has, for some megabytes of texts at a time. A null text is empty."""
    texts = pc.fill_null(texts, "")
    upto = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    at = 0
    while at < len(texts):
        begun = int(upto[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(upto, begun + _BYTES_AT_ONCE, "right")))
        yield _tokens(path).of(texts.slice(at, stop - at))
        at = stop


def _frequent(keys: np.ndarray, least: int) -> np.ndarray:
    """Values that occur so often, the most frequent first."""
    ordered = np.sort(keys)
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    counts = np.diff(np.append(starts, len(ordered)))
    often = np.flatnonzero(counts >= least)
    return ordered[starts[often[np.argsort(-counts[often], kind="stable")]]]


def _slots(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)


def _ranks(keys: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Place of each key among the chosen ones, their number for others.

    A table over a hash holds one chosen key per slot: of two that meet the more
    frequent one stays, the other waits for a later round.
    """
    bits = int(len(chosen) * 8).bit_length()
    table = np.full(1 << bits, len(chosen), np.int32)
    table[_slots(chosen, bits)[::-1]] = np.arange(len(chosen), dtype=np.int32)[::-1]
    found = table[_slots(keys, bits)]
    found[np.append(chosen, chosen[:1])[found] != keys] = len(chosen)
    return found


def _replaced(symbols: np.ndarray, keys: np.ndarray, at: np.ndarray, pairs: np.ndarray, base: int):
    """Pairs that became rules, and the symbols after it.

    ``at`` has the places of pairs that may be among ``pairs``. Where two overlap
    the more frequent one wins, in a run of one symbol every second place.
    """
    rank = _ranks(keys[at], pairs)
    at, rank = at[rank < len(pairs)], rank[rank < len(pairs)]
    weight = np.full(len(symbols) + 2, 2 * len(pairs), np.int32)
    own = 2 * rank + (at & 1).astype(np.int32)
    weight[at + 1] = own
    won = (own < weight[at]) & (own < weight[at + 2])
    at, rank = at[won], rank[won]
    used = np.bincount(rank, minlength=len(pairs)) > 1
    at, rank = at[used[rank]], rank[used[rank]]
    symbols[at] = (base + np.cumsum(used) - 1)[rank]
    left = np.ones(len(symbols), bool)
    left[at + 1] = False
    return pairs[used], symbols[left]


def compress(
    ids: np.ndarray, least: int = LEAST_COUNT, gain: float = LEAST_GAIN, first: int = FIRST_RULE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rules (left, right), their expansion lengths, and the symbols left.

    Every round counts all pairs of neighbours and replaces the frequent ones by a
    nonterminal each. The count that makes a pair frequent falls by rounds, from a
    quarter of the leader's. Pairs are counted by hash first, so that only those
    that can be frequent are sorted; 4-byte ids below ``first`` are what it takes.
    """
    symbols = ids.astype(np.uint32)
    rules, spans, floor = [np.zeros((0, 2), np.uint32)], np.zeros(0, np.int64), None
    while len(symbols) > 2 * least:
        keys = (symbols[:-1].astype(np.uint64) << np.uint64(32)) | symbols[1:]
        slots = _slots(keys, _COUNTED_BITS)
        counts = np.bincount(slots.view(np.int64), minlength=1 << _COUNTED_BITS)
        floor = max(least, (int(counts.max()) if floor is None else floor) // _FALL)
        at = np.flatnonzero((counts >= floor)[slots])
        pairs = _frequent(keys[at], floor) if len(at) else keys[:0]
        before = len(symbols)
        if len(pairs):
            added, symbols = _replaced(symbols, keys, at, pairs, first + len(spans))
            sides = np.stack([added >> np.uint64(32), added & np.uint64(0xFFFFFFFF)], 1).astype(np.int64)
            widths = np.append(spans, 1)
            spans = np.append(spans, widths[np.maximum(sides - first, -1)].sum(1))
            rules.append(sides.astype(np.uint32))
        if floor == least and before - len(symbols) <= gain * before:
            break
    return np.concatenate(rules), spans, symbols


def _packed(symbols: np.ndarray, rules: np.ndarray) -> tuple[bytes, bytes]:
    """Rules as 32-bit pairs and symbols in the fewest whole bytes that hold them all."""
    width = 2 if not len(symbols) or int(symbols.max()) < 1 << 16 else 3 if int(symbols.max()) < 1 << 24 else 4
    raw = np.ascontiguousarray(symbols, "<u4").view(np.uint8).reshape(-1, 4)[:, :width]
    return np.ascontiguousarray(rules, "<u4").tobytes(), bytes([width]) + np.ascontiguousarray(raw.T).tobytes()


def _unpacked(symbols: bytes) -> np.ndarray:
    width = symbols[0]
    raw = np.frombuffer(symbols, np.uint8, offset=1).reshape(width, -1)
    whole = np.zeros((raw.shape[1], 4), np.uint8)
    whole[:, :width] = raw.T
    return whole.view("<u4").reshape(-1)


class Grammar:
    """A stored block, read whole or by any range of its ids."""

    def __init__(self, rules: bytes, spans: bytes, symbols: bytes, first: int = FIRST_RULE):
        self.rules = np.frombuffer(rules, "<u4").reshape(-1, 2)
        self.spans = np.frombuffer(spans, "<u4")
        self.symbols, self.first = _unpacked(symbols), first
        at = np.flatnonzero(self.symbols >= first)
        widths = np.ones(len(self.symbols), np.int64)
        widths[at] = self.spans[self.symbols[at] - first]
        self.ends = np.cumsum(widths)

    def _expanded(self, symbols: np.ndarray) -> np.ndarray:
        """All rules opened, one level of them after the other."""
        while len(at := np.flatnonzero(symbols >= self.first)):
            size = np.ones(len(symbols), np.int64)
            size[at] = 2
            starts = np.cumsum(size) - size
            opened = np.empty(int(size.sum()), np.uint32)
            opened[starts] = symbols
            sides = self.rules[symbols[at] - self.first]
            opened[starts[at]], opened[starts[at] + 1] = sides[:, 0], sides[:, 1]
            symbols = opened
        return symbols

    def read(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids from ``start`` to ``stop``: only symbols that reach into the range are opened."""
        stop = int(self.ends[-1]) if stop is None and len(self.ends) else stop or 0
        if stop <= start:
            return np.zeros(0, np.uint32)
        one, last = np.searchsorted(self.ends, start, "right"), np.searchsorted(self.ends, stop, "left")
        begun = int(self.ends[one - 1]) if one else 0
        return self._expanded(self.symbols[one : last + 1])[start - begun : stop - begun]


def _in_order(docs: DataFrame) -> DataFrame:
    """Documents dealt into ranges by id, null first, in order; ties by a hash of
    the text and the text, which also part the rows that share an id."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    keys = ["doc_id", "tie"]
    dealt = slim.withColumn("tie", F.xxhash64("text")).repartitionByRange(*keys)
    return dealt.sortWithinPartitions(*keys, "text").select("doc_id", "text")


def write(docs: DataFrame, folder: str, tokenizer_path: str, block_tokens: int = BLOCK_TOKENS) -> None:
    """Write the ids of all documents, in ascending ``doc_id`` order, to a folder.

    Each document is its ids and an end mark; a null text is the mark alone, rows
    without an id come first, repeated rows are written each, no documents give
    no blocks. A task writes one shard, a block at a time: it holds the ids of a
    block and of the document in hand.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, before, total = TaskContext.get().partitionId(), 0, 0, 0
        held, names, sizes = [], [], []

        def flush() -> pa.RecordBatch:
            rules, spans, symbols = compress(np.concatenate(held))
            packed_rules, packed_symbols = _packed(symbols, rules)
            row = [shard, number, before, total, names, sizes, packed_rules, spans.astype("<u4").tobytes(), packed_symbols]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 2, *[pa.binary()] * 3]
            columns = [field.split()[0] for field in BLOCKS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], columns)

        for batch in batches:
            doc_ids, done = batch.column("doc_id").to_pylist(), 0
            for ids, counts in token_ids(batch.column("text"), tokenizer_path):
                stops, at, used = np.cumsum(counts), 0, 0
                while at < len(counts):
                    # Documents up to the one that fills the block.
                    upto = min(len(counts), int(np.searchsorted(stops, used + block_tokens - total, "left")) + 1)
                    held.append(ids[used : stops[upto - 1]])
                    names += doc_ids[done + at : done + upto]
                    sizes += counts[at:upto].tolist()
                    total, used, at = total + len(held[-1]), int(stops[upto - 1]), upto
                    if total >= block_tokens:
                        yield flush()
                        number, before, total, held, names, sizes = number + 1, before + total, 0, [], [], []
                done += len(counts)
        if held:
            yield flush()

    spark = docs.sparkSession
    _in_order(docs).mapInArrow(blocks, BLOCKS).write.mode("overwrite").parquet(f"{folder}/blocks")
    _starts(spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")).write.mode("overwrite").parquet(f"{folder}/shards")


def _starts(blocks: DataFrame) -> DataFrame:
    """Number of ids before each shard: summed in groups of shards, then within them."""
    sums = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n")).withColumn("lot", F.col("shard").bitwiseAND(~1023))
    before = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    lots = sums.groupBy("lot").agg(F.sum("n").alias("n"))
    lots = lots.select("lot", F.coalesce(F.sum("n").over(before().orderBy("lot")), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("n").over(before("lot").orderBy("shard")), F.lit(0))
    return sums.withColumn("inside", inside).join(lots, "lot").select("shard", (F.col("base") + F.col("inside")).alias("first"))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = Grammar(row["rules"], row["spans"], row["symbols"]).read()
            stops = np.cumsum(row["doc_tokens"]).tolist()
            starts = [0, *stops[:-1]]
            for at in range(0, len(starts), 2000):
                parts = [ids[a:b].tobytes() for a, b in zip(starts[at : at + 2000], stops[at : at + 2000])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"][at : at + 2000], pa.int64()),
                        pa.array([row["before"] + s for s in starts[at : at + 2000]], pa.int64()),
                        pa.array(row["doc_tokens"][at : at + 2000], pa.int64()),
                        pa.array(parts, pa.binary()),
                    ],
                    [field.split()[0] for field in DOCUMENTS.split(", ")],
                )


def _placed(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks with the number of ids of all documents before them; read without
    being decoded. The shards are few, a row each."""
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    shards = spark.read.schema("shard int, first long").parquet(f"{folder}/shards")
    return blocks.join(shards, "shard").withColumn("before", F.col("first") + F.col("before"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and
    ``ids`` of every document, decoded block by block."""
    documents = _placed(spark, folder).mapInArrow(_documents, DOCUMENTS)
    return documents.select("doc_id", F.col("before").alias("start"), "n_tokens", "ids")


def read_range(spark: SparkSession, folder: str, start: int, stop: int) -> DataFrame:
    """Ids from ``start`` to ``stop`` of the whole row of ids: ``start`` and ``ids``
    of the part in each block that has one. Other blocks are not decoded, and of
    these only the symbols that reach into the range."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                begin = max(start - row["before"], 0)
                end = min(stop - row["before"], row["n_tokens"])
                ids = Grammar(row["rules"], row["spans"], row["symbols"]).read(begin, end)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["before"] + begin], pa.int64()), pa.array([ids.tobytes()], pa.binary())], ["start", "ids"]
                )

    met = (F.col("before") < stop) & (F.col("before") + F.col("n_tokens") > start)
    return _placed(spark, folder).where(met).mapInArrow(cut, "start long, ids binary")
