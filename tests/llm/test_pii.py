import hashlib
import re

from orderloom.llm import pii
from orderloom.llm.queries import op7_pii
from tests.llm.fixtures import documents, frame

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CASES = [
    "a@b.c_d@e.f x@y a@b.com. é.g@h-i.co@j.k %@1.2.3.4",
    "1.2.3.4.5.6.7.8 256.1.1.1 00255.0.0.1 0000256.1.1.1 999.1.2.3 1.2.3 1..2.3.4",
    "4111 1111 1111 1111, 4111-1111-1111-1112 4111  1111 1111 1111 42 04111111111111111",
    "+1 (375) 555-4393. +49-30-1234567) +1 2 +1234567890123456 ++15550001111 tel+1 555 000 11 11 ",
    "漢字 💡 a@b.cd 💡 +1 (375) 555-4393 漢",
    "1 " * 3000 + "4111111111111111 ",
    "a@b.cd " * 1300,
]


def luhn(digits):
    total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(map(int, reversed(digits))))
    return total % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {
        "email": True,
        "ip": all(int(p) <= 255 for p in value.split(".")[:4]) if kind == "ip" else True,
        "card": 14 <= len(digits) <= 19 and luhn(digits),
        "phone": 10 <= len(digits) <= 15,
    }[kind]


def brute(text):
    found = [
        (m.start(), number, m.end())
        for number, (kind, pattern) in enumerate(PLAIN.items())
        for m in re.finditer(pattern, text or "")
        if valid(kind, m[0])
    ]
    return sorted(found)


def cased(rows):
    return [(i, t, None, None, 0, None, None) for i, t in enumerate(rows)]


def test_base_by_definition(spark):
    texts = CASES + [r[1] for r in documents()]
    found = pii.find(frame(spark, cased(texts))).collect()
    assert len(found) == len(texts)
    for row in found:
        assert [(s.start, s.kind, s.end) for s in row.base] == brute(texts[row.doc_id]), texts[row.doc_id]


def test_query_by_definition(spark, tmp_path):
    texts = CASES + ["mail a@b.cd or +1 (375) 555-4393, 1.2.3.4, 4111111111111111, e@f.gh", None, ""]
    frame(spark, cased(texts)).write.parquet(f"{tmp_path}/documents.parquet")
    rows = op7_pii(spark, str(tmp_path)).collect()
    assert len(rows) == len(texts)
    for row in rows:
        spans = brute(texts[row.doc_id])
        counts = [sum(kind == number for _, kind, _ in spans) for number in range(len(PLAIN))]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == counts, texts[row.doc_id]
        listed = ",".join(f"{list(PLAIN)[kind]}:{start}:{end}" for start, kind, end in spans)
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()


def taught():
    """Customers' numbers of an own form, behind words that mails follow elsewhere."""
    texts = [f"please Write to u{i}@mail.example now" for i in range(12)]
    texts += ["nobody should write to KD-88-4711x, ever", "we write to 2024", "paid in 2024-11-12 at once"]
    texts += [f"built in year{i}00 and in u{i}@x.yz" for i in range(5)]
    return texts


def test_contexts_find_unseen_identifiers(spark):
    texts = taught()
    found = {r.doc_id: r for r in pii.find(frame(spark, cased(texts))).collect()}
    new = {(d, texts[d][s.start : s.end]) for d, r in found.items() for s in r.spans if s.kind == len(pii.PATTERNS)}
    assert new == {(12, "KD-88-4711x")}
    for row in found.values():
        assert [s for s in row.spans if s.kind < len(pii.PATTERNS)] == row.base


def test_members_of_a_list_share_what_stands_before_it(spark):
    texts = [
        "write to " + " ".join(f"m{i}@mail.example" for i in range(5000)),  # more than are summed up at once
        "who must write to AB-12-345x CD-34-567y, EF-56-789z | GH-78-901w. never",
        "write to " + ", ".join(f"id{i:06}" for i in range(700)),
        "write to 7 AB-12-999x",  # the short word stands between
        "write to AB-12-345x or CD-34-567y",
    ]
    found = {r.doc_id: r for r in pii.find(frame(spark, cased(texts))).collect()}
    new = {d: [texts[d][s.start : s.end] for s in r.spans if s.kind == len(pii.PATTERNS)] for d, r in found.items()}
    assert new[1] == ["AB-12-345x", "CD-34-567y", "EF-56-789z", "GH-78-901w"]
    assert new[2] == [f"id{i:06}" for i in range(700)]
    assert new[3] == [] and new[4] == ["AB-12-345x"]


def test_long_words_before_a_span_stay_whole(spark):
    key = "k" * 300
    texts = [f"my {key} u{i}@mail.example" for i in range(12)] + [f"my {key} ab12cd34", f"my {'k' * 200} ab12cd35"]
    found = {r.doc_id: r for r in pii.find(frame(spark, cased(texts))).collect()}
    assert [s.start for s in found[12].spans] == [304] and found[13].spans == []


def test_redaction(spark):
    docs = frame(spark, cased(taught() + [None, "", "x a@b.cd 4111111111111111@b.cd y"]))
    clean = pii.redact(docs)
    assert clean.columns == docs.columns and clean.dtypes == docs.dtypes
    texts = {r.doc_id: (r.text, r.n_chars) for r in clean.collect()}
    assert texts[0] == ("please Write to [EMAIL] now", 27)
    assert texts[12][0] == "nobody should write to [ID], ever"
    assert texts[20] == (None, None) and texts[21] == ("", 0)
    assert texts[22][0] == "x [EMAIL] [EMAIL] y"


def test_no_documents(spark):
    assert pii.find(frame(spark, [])).collect() == []
    assert pii.redact(frame(spark, [])).collect() == []


def test_main_path_is_native(spark):
    plan = pii.find(frame(spark, cased(taught())))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
