"""Removal of repeated token windows by Rabin-Karp hashes counted in Spark."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import words

WIDTH = 20
# Bytes of text a range of documents should hold, hashes a bucket should hold.
RANGE_BYTES = 8 << 20
BUCKET_HASHES = 2 << 20
LEAST_PARTS = 64
_BASE = 0x9E3779B97F4A7C13  # odd, so that it has an inverse modulo 2**64
_CACHED_WORDS = 1 << 18

CLEANED = "doc_id long, kept string, n_words long, n_removed long, removed array<struct<start:int,end:int>>"


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_hashes = _WordHashes()


@functools.lru_cache(maxsize=2)
def _powers(base: int, size: int) -> np.ndarray:
    powers = np.full(size, base, np.uint64)
    powers[:1] = 1
    return np.cumprod(powers, dtype=np.uint64)


def window_hashes(found: list[bytes], width: int) -> np.ndarray:
    """Hash of every window of ``width`` words: a polynomial of the words' hashes
    modulo 2**64, from running sums."""
    count = len(found) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    size = 1 << len(found).bit_length()
    values = np.fromiter(map(_hashes.__getitem__, found), np.uint64, len(found))
    sums = np.zeros(len(found) + 1, np.uint64)
    np.cumsum(values * _powers(_BASE, size)[: len(found)], out=sums[1:])
    rolled = (sums[width:] - sums[:-width]) * _powers(pow(_BASE, -1, 1 << 64), size)[:count]
    rolled ^= rolled >> np.uint64(32)
    rolled *= np.uint64(0xD6E8FEB86659FD93)
    return rolled ^ (rolled >> np.uint64(29))


def _in_order(part: pa.Table) -> tuple[list, list]:
    """Ids and texts by id, null first, rows of one id by text."""
    rows = zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist())
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    return [r[0] for r in ordered], [r[1] for r in ordered]


def _part_hashes(texts: list, width: int) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64), *(window_hashes(words(t), width) for t in texts)])


def _bucket_edges(buckets: int) -> np.ndarray:
    return np.array([-(-(k << 64) // buckets) for k in range(1, buckets)], np.uint64)


def _removed_words(flags: np.ndarray, size: int, width: int) -> np.ndarray:
    """Words covered by a flagged window."""
    steps = np.zeros(size + 1, np.int64)
    starts = np.flatnonzero(flags)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + width, -1)
    return np.cumsum(steps[:-1]) > 0


def _intervals(covered: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
    return [{"start": a, "end": b} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]


def remove_repeats(
    docs: DataFrame, width: int = WIDTH, range_bytes: int = RANGE_BYTES, bucket_hashes: int = BUCKET_HASHES
) -> DataFrame:
    """Every document without the words of windows that also start earlier.

    Earlier is a smaller ``doc_id`` (null is smallest; rows of one id are ordered
    by text) or an earlier start in the same document. Returns ``doc_id``,
    ``kept`` (the other words joined by one space, empty for null and blank
    texts), ``n_words``, ``n_removed`` and ``removed``, the maximal intervals of
    removed words. No rows for no documents.

    Documents are dealt into ranges of ids of bounded size. A range sends each
    hash it holds once, packed by bucket of hashes in hash order. A bucket sees
    which range has a hash first and answers one bit for each hash it was sent;
    the range then marks its windows. A window that a third of the documents
    share so counts once per range, and hashes travel at 8 bytes each.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(LEAST_PARTS, -(-size // range_bytes))
    buckets = max(LEAST_PARTS, -(-size // (6 * bucket_hashes)))
    # One id per range at most goes to the driver.
    bounds = slim.agg(
        F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], max(10_000, 10 * parts))
    ).first()[0]
    bounds = np.unique(np.array(bounds or [], np.int64))
    edges = _bucket_edges(buckets)

    @F.udf("int", useArrow=True)
    def part_of(doc_id):
        return 0 if doc_id is None else int(np.searchsorted(bounds, doc_id, "left"))

    dealt = slim.withColumn("part", part_of("doc_id"))

    def send(part: pa.Table) -> pa.Table:
        unique = np.unique(_part_hashes(_in_order(part)[1], width))
        cuts = [0, *np.searchsorted(unique, edges).tolist(), len(unique)]
        rows = [(k, unique[a:b].tobytes()) for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
        number = part.column("part")[0].as_py()
        return pa.table(
            {
                "part": pa.array([number] * len(rows), pa.int32()),
                "bucket": pa.array([r[0] for r in rows], pa.int32()),
                "hashes": pa.array([r[1] for r in rows], pa.binary()),
            }
        )

    def answer(bucket: pa.Table) -> pa.Table:
        order = np.argsort(bucket.column("part").to_numpy())
        packed = bucket.column("hashes").to_pylist()
        hashes = [np.frombuffer(packed[i], np.uint64) for i in order]
        pool = np.concatenate(hashes)
        later = np.ones(len(pool), bool)
        later[np.unique(pool, return_index=True)[1]] = False
        ends = np.cumsum([len(h) for h in hashes])[:-1]
        bits = [np.packbits(b).tobytes() for b in np.split(later, ends)]
        return pa.table(
            {
                "part": pa.array(bucket.column("part").to_numpy()[order], pa.int32()),
                "bucket": bucket.column("bucket"),
                "later": pa.array(bits, pa.binary()),
            }
        )

    def mark(part: pa.Table, answers: pa.Table) -> pa.Table:
        ids, texts = _in_order(part)
        unique, first, place = np.unique(_part_hashes(texts, width), return_index=True, return_inverse=True)
        cuts = [0, *np.searchsorted(unique, edges).tolist(), len(unique)]
        later = np.zeros(len(unique), bool)
        for bucket, bits in zip(answers.column("bucket").to_pylist(), answers.column("later").to_pylist()):
            a, b = cuts[bucket], cuts[bucket + 1]
            later[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a)
        flags = later[place] | (first[place] != np.arange(len(place)))
        kept, n_words, n_removed, removed, at = [], [], [], [], 0
        for text in texts:
            found = words(text)
            windows = max(0, len(found) - width + 1)
            own, at = flags[at : at + windows], at + windows
            if own.any():
                covered = _removed_words(own, len(found), width)
                left = [w for w, c in zip(found, covered.tolist()) if not c]
                removed.append(_intervals(covered))
            else:
                left = found
                removed.append([])
            kept.append(b" ".join(left).decode())
            n_words.append(len(found))
            n_removed.append(len(found) - len(left))
        span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "kept": pa.array(kept, pa.string()),
                "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "removed": pa.array(removed, pa.list_(span)),
            }
        )

    sent = dealt.groupBy("part").applyInArrow(send, "part int, bucket int, hashes binary")
    answers = sent.groupBy("bucket").applyInArrow(answer, "part int, bucket int, later binary")
    return dealt.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(mark, CLEANED)
