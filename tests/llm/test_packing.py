import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from orderloom.llm import packing
from tests.llm.fixtures import documents, frame

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def whole(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_ids_are_the_tokenizers(tokenizer):
    parts = ["a", "B", "É", "é", "́", " ", "　", "İ", "Σ", "ς", "'s", "'", "1", "<|endoftext|>"]
    parts += ["☃", "漢", "‍", "\x1c", "\x85", "!", ".", ",", "ß", "ñ", " ", "\n", "\t", " "]
    draw = random.Random(5)
    for _ in range(4000):
        text = "".join(draw.choice(parts) for _ in range(draw.randrange(14)))
        assert packing.token_ids(text, PATH).tolist() == whole(tokenizer, text), text


@pytest.mark.parametrize("batch_tokens", [packing.BATCH_TOKENS, 3000])
def test_round_trip(spark, tokenizer, batch_tokens):
    rows = documents(seed=2)
    found = packing.pack_documents(frame(spark, rows), PATH, batch_tokens=batch_tokens).collect()
    by_sequence, by_document = defaultdict(list), defaultdict(list)
    for r in found:
        assert len(r.ids) == 4 * r.length > 0
        by_sequence[r.sequence_id].append(r)
        by_document[r.doc_id].append(r)
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == np.cumsum([0, *(r.length for r in pieces)])[:-1].tolist()
        size = sum(r.length for r in pieces)
        assert size <= 4096 and size & (size - 1) == 0 and {r.tier for r in pieces} == {size}
    expected = defaultdict(list)
    for doc_id, text, *_ in rows:
        expected[doc_id].append(whole(tokenizer, text))
    assert set(expected) == set(by_document)
    for doc_id, copies in expected.items():
        if len(copies) == 1:
            pieces = sorted(by_document[doc_id], key=lambda r: r.start)
            ids = np.frombuffer(b"".join(r.ids for r in pieces), "<u4").tolist()
            assert ids == copies[0]
            assert [r.start for r in pieces] == np.cumsum([0, *(r.length for r in pieces)])[:-1].tolist()
            assert {r.doc_tokens for r in pieces} == {len(ids)}
        else:
            assert sum(r.length for r in by_document[doc_id]) == sum(map(len, copies))


@pytest.mark.parametrize("seed", range(6))
def test_windows_are_full(seed):
    draw = random.Random(seed)
    sizes = [draw.choice([1, 5, draw.randrange(1, 9000), draw.randrange(1, 700)]) for _ in range(draw.randrange(1, 200))]
    covered = [[] for _ in sizes]
    for size, pieces in packing.pack(sizes):
        assert sum(p[2] for p in pieces) == size and size & (size - 1) == 0
        for doc, start, length in pieces:
            covered[doc].append((start, length))
    for size, parts in zip(sizes, covered):
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == size


def test_step_groups_are_balanced():
    sizes = [4096] * 40 + [1024] * 90 + [512] * 30
    held = defaultdict(int)
    for size, group in zip(sizes, packing.step_groups(sizes, 65536)):
        held[group] += size
    assert max(held.values()) - min(held.values()) <= 4096


def test_no_documents(spark):
    assert packing.pack_documents(frame(spark, []), PATH).collect() == []
