import itertools

import pytest
import xxhash

from orderloom.llm import simhash
from tests.llm.fixtures import documents, frame


def brute_print(text):
    found = (text or "").encode().lower().split()
    count = max(1, len(found) - 2)
    shingles = [b" ".join(found[i : i + 3]) for i in range(count)] if found else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance):
    """Smallest id reachable, by rows of (id, fingerprint)."""
    distinct = sorted({p for _, p in prints})
    near = {p: [q for q in distinct if bin(p ^ q).count("1") <= distance] for p in distinct}
    root = {}
    for start in distinct:
        if start in root:
            continue
        reached, todo = {start}, [start]
        while todo:
            for q in near[todo.pop()]:
                if q not in reached:
                    reached.add(q)
                    todo.append(q)
        ids = [i for i, p in prints if p in reached and i is not None]
        for p in reached:
            root[p] = min(ids, default=None)
    return root


def test_fingerprints_by_definition():
    texts = [r[1] for r in documents()] + ["x y z " * 30000]
    assert simhash.simhash(texts).tolist() == [brute_print(t) for t in texts]


def key(row):
    return tuple(str(v) for v in row)


@pytest.mark.parametrize("distance", [0, 3, 5])
@pytest.mark.parametrize("paired_at_most", [1, 4096])
def test_components_by_definition(spark, distance, paired_at_most):
    rows = documents()
    prints = [(r[0], brute_print(r[1])) for r in rows]
    root = brute_components(prints, distance)
    expected = sorted(((i, p - (1 << 64) if p >> 63 else p, root[p]) for i, p in prints), key=key)
    found = simhash.near_duplicates(frame(spark), distance=distance, paired_at_most=paired_at_most).collect()
    assert sorted((tuple(r) for r in found), key=key) == expected


def test_masks_share_a_block():
    masks = simhash._masks(3)
    for bits in itertools.combinations(range(0, 64, 7), 3):
        change = sum(1 << b for b in bits)
        assert any(not m & change for m in masks)


def test_no_documents(spark):
    assert simhash.near_duplicates(frame(spark, [])).collect() == []
