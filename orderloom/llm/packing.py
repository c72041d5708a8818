"""Hierarchical packing: documents are routed to context sizes, every size is
packed, gaps of long windows are filled from shorter sizes, and windows are dealt
into balanced step groups."""

from __future__ import annotations

import functools
import heapq
import os
import re
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIERS = (512, 1024, 2048, 4096)
END = 2
# Tokens packed together, tokens of a step group.
BATCH_TOKENS = 2 << 20
STEP_TOKENS = 64 << 10
# Words, and the runs of letters in them, whose ids are dearer to find.
_CACHED_WORDS, _CACHED_RUNS = 200_000, 600_000

PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, "
    "sequence_id long, offset long, tier int, step_group long"
)
_PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
_BYTE_LETTERS = {b: chr(b) for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
_BYTE_LETTERS |= {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in _BYTE_LETTERS)}


class WordTokens(dict):
    """Token ids of words.

    The tokenizer drops white space and never joins what white space parts, so a
    text's ids are its words' ids in a row. Plain letters skip normalisation and
    splitting, which leave a lower-cased run of letters as it is.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters: dict[str, bytes] = {}

    def _letters(self, run: str) -> bytes:
        run = run.lower()
        ids = self.letters.get(run)
        if ids is None:
            if len(self.letters) >= _CACHED_RUNS:
                self.letters.clear()
            mapped = run if run.isascii() else "".join(_BYTE_LETTERS[b] for b in run.encode())
            ids = np.array([t.id for t in self.model.tokenize(mapped)], "<u4").tobytes()
            self.letters[run] = ids
        return ids

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        text = word.decode()
        if _PLAIN.fullmatch(text):
            ids = self._letters(text)
        elif text[-1] in ".," and _PLAIN.fullmatch(text, 0, len(text) - 1):
            ids = self._letters(text[:-1]) + self[word[-1:]] if len(text) > 1 else self._whole(text)
        else:
            ids = self._whole(text)
        self[word] = ids
        return ids


@functools.lru_cache(maxsize=2)
def _word_tokens(path: str) -> WordTokens:
    return WordTokens(path)


def token_ids(text, path: str) -> np.ndarray:
    """Ids of a text with the end mark; a null text is empty."""
    found = (text or "").encode().split()
    return np.frombuffer(b"".join(map(_word_tokens(path).__getitem__, found)) + END.to_bytes(4, "little"), "<u4")


def pack(sizes: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Windows as (size, pieces); a piece is (document, start, length).

    A document longer than the longest context fills windows of its own; what is
    left is routed to the smallest context that holds it. Contexts are packed from
    long to short. The gap of a window takes the longest piece of shorter contexts
    that fits, again and again, at last a piece cut to fit. When nothing shorter is
    left, pieces of unfilled windows run on into windows of the longest context,
    and the rest is cut at powers of two: all windows are full.
    """
    top, windows = tiers[-1], []
    pools: list[list[tuple[int, int, int]]] = [[] for _ in tiers]  # (length, document, start), sorted
    for doc, size in enumerate(sizes):
        full = size // top
        windows += [(top, [(doc, k * top, top)]) for k in range(full)]
        if left := size - full * top:
            pools[next(i for i, t in enumerate(tiers) if left <= t)].append((left, doc, full * top))
    for pool in pools:
        pool.sort()

    def route(piece):
        insort(pools[next(i for i, t in enumerate(tiers) if piece[0] <= t)], piece)

    def filler(gap: int, below: int):
        """Longest piece that fits, from the longest context it can be in."""
        for pool in reversed(pools[:below]):
            if at := bisect_right(pool, (gap, 1 << 62, 0)):
                return pool.pop(at - 1)
        for pool in pools[:below]:
            if pool:
                length, doc, start = pool.pop(0)
                route((length - gap, doc, start + gap))
                return gap, doc, start
        return None

    unfilled: list[tuple[int, int, int]] = []
    for level in range(len(tiers) - 1, -1, -1):
        while pools[level]:
            length, doc, start = pools[level].pop()
            pieces, gap = [(doc, start, length)], tiers[level] - length
            while gap and (found := filler(gap, max(level, 1))):
                length, doc, start = found
                pieces.append((doc, start, length))
                gap -= length
            if gap:
                unfilled += pieces
            else:
                windows.append((tiers[level], pieces))
    left = sum(p[2] for p in unfilled)
    goals = [top] * (left // top) + [1 << b for b in range(top.bit_length(), -1, -1) if (left % top) >> b & 1]
    at = iter(unfilled)
    doc, start, length = 0, 0, 0
    for goal in goals:
        pieces, gap = [], goal
        while gap:
            if not length:
                doc, start, length = next(at)
            taken = min(gap, length)
            pieces.append((doc, start, taken))
            start, length, gap = start + taken, length - taken, gap - taken
        windows.append((goal, pieces))
    return windows


def step_groups(sizes: list[int], step_tokens: int = STEP_TOKENS) -> list[int]:
    """Group of each window, so that groups hold nearly equal numbers of tokens."""
    groups = [(0, g) for g in range(max(1, -(-sum(sizes) // step_tokens)))]
    dealt = [0] * len(sizes)
    for at in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        held, group = heapq.heappop(groups)
        dealt[at] = group
        heapq.heappush(groups, (held + sizes[at], group))
    return dealt


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    tiers: tuple[int, ...] = TIERS,
    batch_tokens: int = BATCH_TOKENS,
    step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """Pieces of documents in packed sequences.

    A document is its ids and an end mark; a null or blank text is the mark alone.
    Returns per piece ``doc_id``, ``start`` (ids of the document before it),
    ``length``, ``ids`` (little-endian 32-bit), ``doc_tokens``, ``sequence_id``,
    ``offset`` (in the sequence), ``tier`` (length of the sequence) and
    ``step_group``. Every task packs the documents it reads, a bounded number of
    tokens at a time, so nothing is shuffled; repeated rows are packed each, and
    no documents give no rows. Sequences are full: lengths are the longest
    context, shorter ones, or smaller powers of two at the end of a batch.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        groups_base, held, total = base, [], 0

        def flush():
            nonlocal base, groups_base
            windows = pack([len(ids) for _, ids in held], tiers)
            dealt = step_groups([size for size, _ in windows], step_tokens)
            rows = []
            for number, (size, pieces) in enumerate(windows):
                offset = 0
                for doc, start, length in pieces:
                    doc_id, ids = held[doc]
                    part = ids[start : start + length].tobytes()
                    group = groups_base + dealt[number]
                    rows.append((doc_id, start, length, part, len(ids), base + number, offset, size, group))
                    offset += length
            base += len(windows)
            groups_base += max(dealt, default=-1) + 1
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 3, pa.int32(), pa.int64())
            for at in range(0, len(rows), 5000):
                columns = zip(*rows[at : at + 5000])
                names = [field.split()[0] for field in PIECES.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = token_ids(text.as_py(), tokenizer_path)
                held.append((doc_id, ids))
                total += len(ids)
                if total >= batch_tokens:
                    yield from flush()
                    held, total = [], 0
        if held:
            yield from flush()

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(packed, PIECES)
