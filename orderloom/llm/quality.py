"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting of shallow trees over binned features learns one lookup table per
feature and per chosen pair of features. A score is the sum of the tables' entries
at a text's bins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# At most so many labelled texts are learnt from; their features go to the driver.
SAMPLE_ROWS = 20_000
FOLDS, HELD_OUT = 5, 0
CUTOFF = 0.3
BINS, PAIR_BINS = 64, 12
ROUNDS, PAIR_ROUNDS, PAIRS = 200, 100, 10
RATE, LEAF_ROWS = 0.1, 20

FEATURES = (
    "log_chars", "log_words", "word_bytes", "upper", "digits", "stops", "symbols", "marks", "spaces", "other_bytes",
    "distinct_words", "repeated_words", "distinct_lines", "words_per_line", "words_per_stop", "commas",
)


def _classes() -> np.ndarray:
    """Membership of byte values in classes, one column per class."""
    kinds = [
        lambda b: not 0x80 <= b <= 0xBF,  # starts a character
        lambda b: chr(b).isascii() and chr(b).isalpha(),
        lambda b: 65 <= b <= 90,
        lambda b: 48 <= b <= 57,
        lambda b: b in b".!?",
        lambda b: b in b"#$%&*|<>{}[]=_~^\\/@+",
        lambda b: b in b"!?",
        lambda b: b in b" \t\n\r\x0b\x0c",
        lambda b: b >= 0x80,
        lambda b: b in b",;:",
    ]
    return np.array([[kind(b) for kind in kinds] for b in range(256)], float)


_CLASSES = _classes()


def text_features(text) -> list[float]:
    """Features of a whole text; a null one counts as empty."""
    data = (text or "").encode()
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _CLASSES
    chars, letters, upper, digits, stops, symbols, marks, spaces, high, commas = counts.tolist()
    found, lines = data.split(), [line for line in data.split(b"\n") if line]
    n, size = max(1, len(found)), max(1, len(data))
    repeated = sum(map(eq, found, found[1:])) if len(found) > 1 else 0
    return [
        float(np.log1p(chars)),
        float(np.log1p(len(found))),
        (size - spaces) / n,
        upper / max(1.0, letters),
        digits / size,
        stops / n,
        symbols / n,
        marks / n,
        spaces / size,
        high / size,
        len(set(found)) / n,
        repeated / n,
        len(set(lines)) / max(1, len(lines)),
        n / max(1, len(lines)),
        n / max(1.0, stops),
        commas / n,
    ]


@dataclass
class Model:
    """Cuts of the features and the lookup tables over their bins."""

    start: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_cuts: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def score(self, rows: np.ndarray) -> np.ndarray:
        bins = _binned(rows, self.pair_cuts)
        total = np.full(len(rows), self.start)
        for column, (cuts, values) in enumerate(zip(self.cuts, self.tables)):
            total += values[np.searchsorted(cuts, rows[:, column], "right")]
        for (a, b), values in zip(self.pairs, self.pair_tables):
            total += values[bins[:, a], bins[:, b]]
        return 1 / (1 + np.exp(-total))


def _cut_points(rows: np.ndarray, bins: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(column, np.arange(1, bins) / bins)) for column in rows.T]


def _binned(rows: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x, "right") for c, x in zip(cuts, rows.T)], 1)


def _leaf(grad, hess):
    return grad / (hess + 1.0)


def _split(grad: np.ndarray, hess: np.ndarray, rows: np.ndarray) -> tuple[float, int]:
    """Best gain of a cut of neighbouring bins in two, and where it is."""
    g, h, n = np.cumsum(grad), np.cumsum(hess), np.cumsum(rows)
    allowed = (n[:-1] >= LEAF_ROWS) & (n[-1] - n[:-1] >= LEAF_ROWS)
    if not allowed.any():
        return 0.0, 0
    gain = g[:-1] ** 2 / (h[:-1] + 1) + (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + 1) - g[-1] ** 2 / (h[-1] + 1)
    gain = np.where(allowed, gain, 0)
    best = int(gain.argmax())
    return float(gain[best]), best + 1


def _shallow_tree(grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, depth: int = 2) -> np.ndarray:
    """Values per bin of a tree over the bins of one feature."""
    gain, at = _split(grad, hess, rows) if depth and len(grad) > 1 else (0.0, 0)
    if gain <= 1e-9:
        return np.full(len(grad), _leaf(grad.sum(), hess.sum()))
    parts = (slice(None, at), slice(at, None))
    return np.concatenate([_shallow_tree(grad[p], hess[p], rows[p], depth - 1) for p in parts])


def _pair_tree(grad: np.ndarray, hess: np.ndarray, rows: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of a cut of one feature with a cut of the other on either side."""
    best = (0.0, np.zeros_like(grad))
    for turned in (False, True):
        g, h, n = (x.T if turned else x for x in (grad, hess, rows))
        for at in range(1, len(g)):
            values, total = np.zeros_like(g), 0.0
            for part in (slice(None, at), slice(at, None)):
                gs, hs, ns = g[part].sum(0), h[part].sum(0), n[part].sum(0)
                gain, cut = _split(gs, hs, ns)
                total += gain + gs.sum() ** 2 / (hs.sum() + 1)
                values[part, :cut] = _leaf(gs[:cut].sum(), hs[:cut].sum()) if cut else 0
                values[part, cut:] = _leaf(gs[cut:].sum(), hs[cut:].sum())
            if total > best[0]:
                best = (total, values.T if turned else values)
    return best


def fit(rows: np.ndarray, labels: np.ndarray) -> Model:
    """Main effects first, one feature after the other in every round; then the
    pairs that explain most of what is left, in the same way."""
    if not len(rows):
        empty = [np.zeros(0)] * len(FEATURES)
        return Model(0.0, empty, [np.zeros(1)] * len(FEATURES), [], empty, [])
    rate = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(rate / (1 - rate)))
    cuts, pair_cuts = _cut_points(rows, BINS), _cut_points(rows, PAIR_BINS)
    bins, coarse = _binned(rows, cuts), _binned(rows, pair_cuts)
    sizes, coarse_sizes = [len(c) + 1 for c in cuts], [len(c) + 1 for c in pair_cuts]
    tables = [np.zeros(size) for size in sizes]
    total = np.full(len(rows), start)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return labels - p, p * (1 - p)

    def sums(at, size):
        grad, hess = slopes()
        return np.bincount(at, grad, size), np.bincount(at, hess, size), np.bincount(at, minlength=size)

    for _ in range(ROUNDS):
        for column, size in enumerate(sizes):
            step = RATE * _shallow_tree(*sums(bins[:, column], size))
            tables[column] += step
            total += step[bins[:, column]]

    def pair_sums(a, b):
        shape = (coarse_sizes[a], coarse_sizes[b])
        at = coarse[:, a] * shape[1] + coarse[:, b]
        return at, [x.reshape(shape) for x in sums(at, shape[0] * shape[1])]

    every = [(a, b) for a in range(len(sizes)) for b in range(a)]
    ranked = sorted(every, key=lambda ab: -_pair_tree(*pair_sums(*ab)[1])[0])[:PAIRS]
    pair_tables = [np.zeros((coarse_sizes[a], coarse_sizes[b])) for a, b in ranked]
    for _ in range(PAIR_ROUNDS):
        for values, (a, b) in zip(pair_tables, ranked):
            at, histograms = pair_sums(a, b)
            step = RATE * _pair_tree(*histograms)[1]
            values += step
            total += step.ravel()[at]
    return Model(start, cuts, tables, ranked, pair_cuts, pair_tables)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Model of labelled documents outside the held-out fold.

    At most ``sample_rows`` labelled ids, in order of a hash of the id, are learnt
    from. An id with several labels has the more frequent one (1 in a tie); null
    ids and labels don't count. Without labelled texts all scores are one half.
    """
    known = labels.where("doc_id is not null and quality is not null").where(~held_out(F.col("doc_id")))
    sample = (
        known.groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([text_features(t) for t in batch.column("text").to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), found], ["doc_id", "quality", "found"])

    # The sample is bounded, so it may be broadcast.
    joined = slim.join(F.broadcast(sample), "doc_id").select("doc_id", "quality", "text")
    found = joined.mapInArrow(of, "doc_id long, quality int, found array<double>")
    rows = found.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("found").alias("found")).toArrow()
    rows = rows.sort_by("doc_id")
    matrix = np.array(rows.column("found").to_pylist(), float).reshape(-1, len(FEATURES))
    return fit(matrix, np.array(rows.column("quality").to_pylist(), float))


def scored(docs: DataFrame, model: Model, name: str = "score_") -> DataFrame:
    """The documents, all columns kept, with a score between 0 and 1 under the name.

    Null and blank texts are scored like any other; repeated rows each.
    """

    @F.pandas_udf("double")
    def score(texts):
        rows = np.array([text_features(t) for t in texts], float).reshape(-1, len(FEATURES))
        return type(texts)(model.score(rows))

    return docs.withColumn(name, score(F.col("text").cast("string")))
