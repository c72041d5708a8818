import pytest

from orderloom.llm import substrings
from tests.llm.fixtures import documents, frame


def brute(rows, width):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    seen, result = set(), []
    for doc_id, text in ordered:
        found = (text or "").encode().split()
        gone = [False] * len(found)
        for i in range(len(found) - width + 1):
            window = tuple(found[i : i + width])
            if window in seen:
                gone[i : i + width] = [True] * width
            seen.add(window)
        kept = b" ".join(w for w, g in zip(found, gone) if not g).decode()
        result.append((doc_id, kept, len(found), sum(gone)))
    return sorted(result, key=str)


@pytest.mark.parametrize("width", [1, 3, 20])
@pytest.mark.parametrize("range_bytes,bucket_hashes", [(substrings.RANGE_BYTES, substrings.BUCKET_HASHES), (512, 64)])
def test_by_definition(spark, width, range_bytes, bucket_hashes):
    rows = documents(seed=3)
    found = substrings.remove_repeats(frame(spark, rows), width, range_bytes, bucket_hashes).collect()
    assert sorted(((r.doc_id, r.kept, r.n_words, r.n_removed) for r in found), key=str) == brute(
        [r[:2] for r in rows], width
    )
    for row in found:
        assert sum(i.end - i.start for i in row.removed) == row.n_removed
        assert all(a.end < b.start for a, b in zip(row.removed, row.removed[1:]))


def test_no_documents(spark):
    assert substrings.remove_repeats(frame(spark, [])).collect() == []


def test_only_nulls(spark):
    rows = [(None, None, None, None, None, None, None)] * 3
    assert [r.n_words for r in substrings.remove_repeats(frame(spark, rows)).collect()] == [0, 0, 0]
