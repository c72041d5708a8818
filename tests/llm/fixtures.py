"""Small documents with the cases every operator has to bear."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, print string"


def documents(seed: int = 0, size: int = 60) -> list[tuple]:
    """Nulls, blanks, copies, near copies, shared passages, repeated rows, one long text."""
    draw = random.Random(seed)
    vocabulary = ["the", "The", "of", "été", "Ünder", "漢字", "x1", "a.b", "and", "line", "zoo", "I", "ŠĆ", " q"]
    vocabulary += [f"w{i}" for i in range(60)]
    gap = [" ", " ", " ", "\n", "\t", "  ", "\r\n", "\x0b", "\x0c"]

    def text(n):
        return "".join(draw.choice(vocabulary) + draw.choice(gap) for _ in range(n))

    passage, base = text(40), text(150)
    rows = [(1000, None), (1001, ""), (1002, " \n\t"), (1003, "one"), (1004, "one two"), (1005, "a b c"), (None, base)]
    rows += [(1006, text(9000)), (1007, "again " * 400), (1008, "again " * 30), (1009, "1" * 5000)]
    for i in range(size):
        kind = i % 6
        if kind == 0:
            body = base
        elif kind == 1:
            found = base.split(" ")
            found[draw.randrange(len(found))] = "changed"
            body = " ".join(found)
        elif kind == 2:
            body = text(draw.randrange(30)) + passage + text(draw.randrange(30))
        else:
            body = text(draw.randrange(1, 120))
        rows.append((i, body))
    rows += [rows[8], rows[20], rows[20], (None, None)]
    sources = ["b", "a", None, "ü", "b", "b", "b"]
    return [(i, t, "en", sources[k % 7], None, 0.5, "x") for k, (i, t) in enumerate(rows)]


def frame(spark, rows=None, parts: int = 3):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(parts)
