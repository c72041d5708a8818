import itertools

import numpy as np
import pytest

from orderloom.llm import crf
from orderloom.llm.blocks import Block, blocks
from orderloom.llm.labelled_pages import labelled_pages

SCHEMA = "page_id long, url string, html string, text string, n_chars long"
PAGE = """<!DOCTYPE html><html><head><title>No &amp; no</title><style>p{}</style><script>var t="</p>";</script></head>
<body><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><div class="ad">Buy this now.</div>
<article><h1>A  title &amp; more</h1><p><b>First\n\tparagraph of it, with words enough.<br><p>Second one &lt;is&gt; here&nbsp;too, also long.</p>
<p>Short.</p></article><footer>&copy; example &middot; All of it.</footer>"""
EXPECTED = "A title & more\nFirst paragraph of it, with words enough.\nSecond one <is> here too, also long.\nShort."


def test_blocks_of_a_page():
    assert [b.text for b in blocks(PAGE)] == ["Home", "News", "Buy this now.", *EXPECTED.split("\n"), "© example · All of it."]
    assert blocks(None) == blocks("") == blocks("<p> <br> </p><script>x") == []
    assert [b.text for b in blocks("bare < text &eacute; <b>bold</b>x<p>y<unknown>z")] == ["bare < text é boldx", "yz"]
    assert [b.text for b in blocks("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e" + "<div>" * 3000 + "deep")] == ["a", "b", "c", "d", "e", "deep"]


def test_extraction(spark):
    rows = [(1, "u", PAGE, "x", 5), (1, "u", PAGE, "x", 5), (2, None, None, "x", 5), (None, "v", "", None, None)]
    rows.append((3, "w", PAGE.replace("Short.", "Long one. " * 30000), "", 0))
    found = crf.extract(spark.createDataFrame(rows, SCHEMA).repartition(2)).collect()
    assert sorted((r.page_id or 0, r.url or "", r.text) for r in found)[:4] == [(0, "v", ""), (1, "u", EXPECTED), (1, "u", EXPECTED), (2, "", "")]
    assert all(r.n_chars == len(r.text) for r in found)
    assert max(len(r.text) for r in found) > 299_000
    assert crf.extract(spark.createDataFrame([], SCHEMA)).collect() == []


def test_held_out_accuracy():
    model, wrong, total = crf.trained(), 0, 0
    for html, labels in labelled_pages(150, seed=1234):
        found = model.labels(blocks(html))
        assert len(found) == len(labels)
        wrong += sum(a != b for a, b in zip(found, labels))
        total += len(labels)
    assert wrong / total < 0.02


def test_viterbi_finds_the_best_path():
    draw = np.random.default_rng(0)
    number = {f"f{i}": i for i in range(5)}
    model = crf.Model(number, draw.normal(size=(5, 2)), draw.normal(size=(2, 2)), draw.normal(size=2))
    for size in range(1, 9):
        page = [Block("x", [f"f{i}" for i in np.flatnonzero(draw.random(5) < 0.5)]) for _ in range(size)]
        scores = model._scores(page)

        def worth(path):
            return model.first[path[0]] + sum(scores[i, y] for i, y in enumerate(path)) + sum(model.moves[a, b] for a, b in zip(path, path[1:]))

        best = max(itertools.product((0, 1), repeat=size), key=worth)
        assert worth(tuple(model.labels(page))) == pytest.approx(worth(best))


def test_training_is_the_same_in_every_run():
    pages = [(blocks(h), y) for h, y in labelled_pages(20)]
    assert np.array_equal(crf.fit(pages, 5).weights, crf.fit(pages, 5).weights)


def test_every_name_of_a_tag_is_a_feature():
    names = " ".join(f"u{chr(97 + i)}" for i in range(20))
    (block,) = blocks(f'<div class="{names} sidebar">Text of it.</div>')
    assert "name:sidebar" in block.features
