import random

import numpy as np
from pyspark.sql import functions as F

from orderloom.llm import quality
from tests.llm.fixtures import documents, frame

LABELS = "doc_id long, quality int, toxic int, text string"


def example():
    draw = random.Random(1)
    words = ["alpha", "beta", "the", "of", "gamma", "delta", "house", "tree"] + [f"w{chr(97 + i)}" for i in range(26)]
    rows, labels = [], []
    for i in range(400):
        found = [draw.choice(words) for _ in range(draw.randrange(20, 120))]
        good = i % 4 != 0
        text = " ".join(found) + "." if good else " ".join(w.upper() + "!!" for w in found[:9] * 9)
        rows.append((i, text, None, None, 0, None, None))
        labels.append((i, int(good), 0, "x"))
    return rows, labels


def test_held_out_rows_are_told_apart(spark):
    rows, labels = example()
    docs = frame(spark, rows)
    model = quality.learn(docs, spark.createDataFrame(labels[:360] + [labels[0], (None, 1, 0, "x"), (3, None, 0, "x")], LABELS))
    found = quality.scored(docs, model).select("doc_id", "score_", quality.held_out(F.col("doc_id")).alias("held")).collect()
    truth = {i: q for i, q, *_ in labels}
    right = [(r.score_ >= quality.CUTOFF) == bool(truth[r.doc_id]) for r in found if r.held]
    assert len(right) > 40 and np.mean(right) > 0.97


def test_labels_of_held_out_rows_do_not_matter(spark):
    rows, labels = example()
    docs = frame(spark, rows)
    held = {r.doc_id for r in docs.where(quality.held_out(F.col("doc_id"))).collect()}
    turned = [(i, 1 - q if i in held else q, t, x) for i, q, t, x in labels]
    one, two = (quality.learn(docs, spark.createDataFrame(given, LABELS)) for given in (labels, turned))
    matrix = np.array([quality.text_features(r[1]) for r in rows])
    assert np.array_equal(one.score(matrix), two.score(matrix))


def test_scores_of_odd_documents(spark):
    docs = frame(spark)
    model = quality.learn(docs, spark.createDataFrame([], LABELS))
    found = quality.scored(docs, model)
    assert found.columns == [*docs.columns, "score_"]
    assert [r.score_ for r in found.collect()] == [0.5] * len(documents())
    model = quality.learn(docs, spark.createDataFrame([(i, i % 2, 0, "x") for i in range(60)], LABELS))
    scores = [r.score_ for r in quality.scored(docs, model).collect()]
    assert len(scores) == len(documents()) and all(0 <= s <= 1 for s in scores)
    assert quality.scored(frame(spark, []), model).collect() == []


def test_pairs_learn_what_single_features_cannot():
    draw = np.random.default_rng(0)
    rows = draw.random((2000, len(quality.FEATURES)))
    labels = ((rows[:, 0] > 0.5) ^ (rows[:, 1] > 0.5)).astype(float)
    assert np.mean((quality.fit(rows, labels).score(rows) > 0.5) == labels) > 0.95
