"""The pipeline's stages against plain versions, each on its own input."""

import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from orderloom.llm import mixing, quality, simhash
from orderloom.llm.common import staged
from tests.llm.fixtures import SCHEMA, documents, frame
from tests.llm.test_pii import brute as personal_data
from tests.llm.test_quality import LABELS, example
from tests.llm.test_simhash import brute_components, brute_print


def _own(text, i):
    """The text with every third word made one of its own, so that it is no near copy."""
    return " ".join(w if at % 3 else f"{w}{i}" for at, w in enumerate(text.split()))


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The folder and what each stage got and gave."""
    folder = str(tmp_path_factory.mktemp("tables"))
    good, labels = example()
    rows = [(i + 5000, *r) for i, *r in good]
    rows += [(i, t, *rest) for i, t, *rest in documents() if t is None or len(t) < 4000]
    rows += [(7000 + i, f"write to u{i}@mail.example or +1 (555) 123-45{i:02} about the house " + _own(t, i), "en", "b", None, 0.5, "x") for i, (_, t, *_) in enumerate(good[:8])]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    known = [(i + 5000, q, t, x) for i, q, t, x in labels]
    known += [(i, 1, 0, "x") for i, *_ in rows if i is not None and i < 5000]
    spark.createDataFrame(known, LABELS).write.parquet(f"{folder}/labels.parquet")
    docs, passed = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = staged(stage(spark, docs, folder), name)
        passed.append((docs, after))
        docs = after
    return folder, passed


def bag(table):
    return Counter(map(tuple, table.collect()))


def test_columns_stay(stages):
    for before, after in stages[1][:-1]:
        assert after.dtypes == before.dtypes and after.count() > 0


def test_quality(spark, stages):
    folder, ((before, after), *_) = stages
    model = quality.learn(before, spark.read.parquet(f"{folder}/labels.parquet"))
    rows = before.collect()
    scores = model.score(np.array([quality.text_features(r.text) for r in rows]))
    assert bag(after) == Counter(tuple(r) for r, s in zip(rows, scores) if s >= quality.CUTOFF)
    assert 0 < after.count() < before.count()


def test_near_duplicates(stages):
    before, after = stages[1][1]
    rows = before.collect()
    prints = [(r.doc_id, brute_print(r.text)) for r in rows]
    root = brute_components(prints, simhash.DISTANCE)
    left = after.collect()
    assert not bag(after) - bag(before)
    groups = Counter(root[brute_print(r.text)] for r in left)
    assert set(groups.values()) == {1} and set(groups) == set(root.values())
    assert all(r.doc_id == root[brute_print(r.text)] for r in left)


def test_personal_data(stages):
    before, after = stages[1][2]
    old = {r.doc_id: r for r in before.collect()}
    assert before.count() == after.count()
    hit = 0
    for row in after.collect():
        was = old[row.doc_id].text
        spans = personal_data(was)
        hit += bool(spans)
        if was is None or not spans and row.text == was:
            assert row.text == was
            continue
        assert not personal_data(row.text)
        assert len(re.findall(r"\[(?:EMAIL|IP|CARD|PHONE)\]", row.text)) >= bool(spans)
    assert hit >= 8


def test_mixing(stages):
    before, after = stages[1][3]
    taken = {r.doc_id: r.copies for r in mixing.mix(before).collect()}
    copies = Counter(r.doc_id for r in after.collect())
    assert copies == Counter({i: n for i, n in taken.items() if n}) and max(copies.values()) <= 3


def test_packing(stages):
    before, after = stages[1][4]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = Counter()
    for row in before.collect():
        expected[row.doc_id] += len(tokenizer.encode(row.text or "", add_special_tokens=False).ids) + 1
    found = Counter()
    for row in after.collect():
        found[row.doc_id] += row.length
    assert found == expected


def test_run_is_all_stages(spark, stages):
    folder, passed = stages
    columns = ["doc_id", "start", "length", "doc_tokens", "ids"]
    ran = corpus_pipeline.run(spark, folder)
    total = lambda t: Counter(r.doc_id for r in t.select("doc_id").distinct().collect())
    assert ran.columns == passed[-1][1].columns and total(ran) == total(passed[-1][1])
    sums = lambda t: t.selectExpr("sum(length)", "sum(crc32(ids) * length)", "count(distinct sequence_id)").first()[0]
    assert sums(ran) == sums(passed[-1][1]) and set(columns) <= set(ran.columns)


def test_extra_columns_and_empty_tables(spark):
    odd = frame(spark).withColumnsRenamed({"score": "score_", "print": "row_"})
    for _, stage in corpus_pipeline.STAGES[1:4]:
        assert stage(spark, odd, "").columns == odd.columns
        assert stage(spark, odd.limit(0), "").count() == 0
