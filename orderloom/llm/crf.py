"""Main text of pages by a linear-chain conditional random field over leaf blocks."""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.blocks import Block, blocks
from orderloom.llm.labelled_pages import labelled_pages

LABELS = 2  # 1 is main text
STEPS, RATE, DECAY = 150, 0.1, 3e-4
LEAST_SEEN = 3

EXTRACTED = "page_id long, url string, text string, n_chars long"


@dataclass
class Model:
    """Weights of features by label, of pairs of labels and of the first label."""

    number: dict[str, int]
    weights: np.ndarray
    moves: np.ndarray
    first: np.ndarray

    def _scores(self, page: list[Block]) -> np.ndarray:
        number, weights = self.number, self.weights
        known = [[number[f] for f in block.features if f in number] for block in page]
        return np.array([weights[k].sum(0) for k in known])

    def labels(self, page: list[Block]) -> list[int]:
        """The most likely labels (Viterbi)."""
        if not page:
            return []
        scores, moves = self._scores(page).tolist(), self.moves.tolist()
        (a, b), back = [x + y for x, y in zip(scores[0], self.first.tolist())], []
        for zero, one in scores[1:]:
            to_zero, to_one = (a + moves[0][0], b + moves[1][0]), (a + moves[0][1], b + moves[1][1])
            back.append((to_zero[1] > to_zero[0], to_one[1] > to_one[0]))
            a, b = max(to_zero) + zero, max(to_one) + one
        path = [int(b > a)]
        for step in reversed(back):
            path.append(int(step[path[-1]]))
        return path[::-1]


def _sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(values - top).sum(axis=axis))


def fit(pages: list[tuple[list[Block], list[int]]], steps: int = STEPS) -> Model:
    """Weights of the largest regularised likelihood, by gradients from forward and
    backward sums over all pages at once."""
    seen = Counter(f for page, _ in pages for block in page for f in block.features)
    number = {f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n >= LEAST_SEEN))}
    count, longest = len(pages), max(len(page) for page, _ in pages)
    size = len(number)
    dense = np.zeros((count, longest, size), np.float32)
    truth = np.zeros((count, longest), int)
    there = np.zeros((count, longest), bool)
    for i, (page, labels) in enumerate(pages):
        truth[i, : len(labels)], there[i, : len(page)] = labels, True
        for j, block in enumerate(page):
            dense[i, j, [number[f] for f in block.features if f in number]] = 1
    flat = dense[there]
    given = np.eye(LABELS)[truth] * there[..., None]
    pairs_given = np.einsum("pta,ptb->ab", given[:, :-1], given[:, 1:])
    theta = np.zeros(size * LABELS + LABELS * LABELS + LABELS)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)

    def parts(vector):
        cut = size * LABELS
        return vector[:cut].reshape(size, LABELS), vector[cut : cut + 4].reshape(LABELS, LABELS), vector[cut + 4 :]

    for step in range(1, steps + 1):
        weights, moves, first = parts(theta)
        scores = np.zeros((count, longest, LABELS))
        scores[there] = flat @ weights.astype(np.float32)
        ahead, after = np.zeros_like(scores), np.zeros_like(scores)
        ahead[:, 0] = scores[:, 0] + first
        for t in range(1, longest):
            ahead[:, t] = _sum(ahead[:, t - 1, :, None] + moves, 1) + scores[:, t]
            ahead[:, t] = np.where(there[:, t, None], ahead[:, t], ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            behind = _sum(moves + (scores[:, t + 1] + after[:, t + 1])[:, None, :], 2)
            after[:, t] = np.where(there[:, t + 1, None], behind, 0)
        whole = _sum(ahead[:, -1], 1)
        chance = np.exp(ahead + after - whole[:, None, None]) * there[..., None]
        joint = np.exp(
            ahead[:, :-1, :, None]
            + moves
            + (scores[:, 1:] + after[:, 1:])[:, :, None, :]
            - whole[:, None, None, None]
        ) * there[:, 1:, None, None]
        slope = np.concatenate(
            [
                (flat.T @ (given - chance)[there].astype(np.float32)).ravel(),
                (pairs_given - joint.sum((0, 1))).ravel(),
                (given[:, 0] - chance[:, 0]).sum(0),
            ]
        ) / count - DECAY * theta
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        theta = theta + RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    weights, moves, first = parts(theta)
    return Model(number, weights, moves, first)


@functools.lru_cache(maxsize=1)
def trained() -> Model:
    """Model of the labelled pages; the same in every run."""
    pages = [(blocks(html), labels) for html, labels in labelled_pages()]
    return fit(pages)


def main_text(html, model: Model) -> str:
    page = blocks(html)
    return "\n".join(block.text for block, label in zip(page, model.labels(page)) if label)


def extract(pages: DataFrame, model: Model | None = None) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page.

    The text is that of the blocks labelled as main text, in page order and joined
    by line ends; empty for null and empty pages and pages without any. Repeated
    rows stay repeated, no pages give no rows.
    """
    model = model or trained()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html, model) for html in batch.column("html").to_pylist()]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), sizes]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    slim = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
    return slim.mapInArrow(of, EXTRACTED)
