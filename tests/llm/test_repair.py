import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from orderloom.llm import repair
from tests.llm.fixtures import documents, frame

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def whole(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_ids_are_the_tokenizers(tokenizer, monkeypatch):
    parts = ["a", "B", "É", "é", "́", " ", "　", "İ", "Σ", "ς", "'s", "'", "1", "<|endoftext|>", "☃", "漢", "‍"]
    parts += ["\x1c", "\x85", "!", ".", ",", "ß", "ñ", " ", "\n", "\t", " ", "᠎", "​", "²", "Ⅷ", "\x0b", " ", "\xa0"]
    draw = random.Random(5)
    texts = [None, *("".join(draw.choice(parts) for _ in range(draw.randrange(14))) for _ in range(6000)), "x" * 9000]
    monkeypatch.setattr(repair, "_BYTES_AT_ONCE", 5000)
    found = []
    for ids, counts in repair.token_ids(pa.array(texts), PATH):
        found += [part.tolist() for part in np.split(ids, np.cumsum(counts))[:-1]]
    for text, ids in zip(texts, found, strict=True):
        assert ids == whole(tokenizer, text), text


def sequences():
    draw = np.random.default_rng(3)
    yield from ([], [7], [7, 7], [7] * 1000, [1, 2] * 500, list(range(3000)))
    passage = draw.integers(0, 50000, 300)
    yield np.concatenate([p for _ in range(40) for p in (passage, draw.integers(0, 40, draw.integers(1, 90)))]).tolist()
    for high in (2, 3, 30, 60000):
        yield draw.integers(0, high, 5000).tolist()


def test_round_trip_and_ranges():
    draw = random.Random(1)
    for ids in sequences():
        ids = np.array(ids, np.uint32)
        rules, spans, symbols = repair.compress(ids)
        packed, left = repair._packed(symbols, rules)
        grammar = repair.Grammar(packed, spans.astype("<u4").tobytes(), left)
        assert grammar.read().tolist() == ids.tolist()
        for at, (pair, span) in enumerate(zip(rules.tolist(), spans.tolist())):
            assert max(pair) < repair.FIRST_RULE + at
            assert span == sum(1 if s < repair.FIRST_RULE else spans[s - repair.FIRST_RULE] for s in pair)
        for _ in range(30):
            start = draw.randrange(len(ids) + 1)
            stop = draw.randrange(start, len(ids) + 1)
            assert grammar.read(start, stop).tolist() == ids[start:stop].tolist()


def test_no_frequent_pair_is_left():
    for ids in sequences():
        _, _, symbols = repair.compress(np.array(ids, np.uint32), gain=0)
        places = {}
        for at, pair in enumerate(zip(symbols.tolist(), symbols.tolist()[1:])):
            places.setdefault(pair, []).append(at)
        for found in places.values():
            apart, last = 0, -2
            for at in found:
                apart, last = (apart + 1, at) if at > last + 1 else (apart, last)
            assert apart < repair.LEAST_COUNT


def test_passages_shrink():
    *_, ids = [s for s in sequences() if len(s) > 10000]
    rules, _, symbols = repair.compress(np.array(ids, np.uint32))
    assert len(symbols) + 2 * len(rules) < len(ids) / 3


@pytest.mark.parametrize("block_tokens", [repair.BLOCK_TOKENS, 3000])
def test_files(spark, tokenizer, tmp_path, block_tokens):
    rows = documents(seed=4)
    repair.write(frame(spark, rows), f"{tmp_path}/ids", PATH, block_tokens)
    found = repair.read(spark, f"{tmp_path}/ids").collect()
    assert Counter((r.doc_id, r.n_tokens, bytes(r.ids)) for r in found) == Counter(
        (i, len(ids := whole(tokenizer, t)), np.array(ids, "<u4").tobytes()) for i, t, *_ in rows
    )
    found.sort(key=lambda r: r.start)
    assert [r.start for r in found] == np.cumsum([0, *(r.n_tokens for r in found)])[:-1].tolist()
    order = [(r.doc_id is not None, r.doc_id or 0) for r in found]
    assert order == sorted(order)
    every = b"".join(r.ids for r in found)
    for start, stop in ((0, 10), (2500, 9100), (len(every) // 4 - 5, len(every)), (50, 50)):
        parts = repair.read_range(spark, f"{tmp_path}/ids", start, stop).orderBy("start").collect()
        assert b"".join(p.ids for p in parts) == every[4 * start : 4 * stop]
    assert zlib.crc32(every) and spark.read.parquet(f"{tmp_path}/ids/shards").count() >= 1


def test_no_documents(spark, tmp_path):
    repair.write(frame(spark, []), f"{tmp_path}/ids", PATH)
    assert repair.read(spark, f"{tmp_path}/ids").count() == 0
