"""Personal data: base patterns with checks, and bootstrapped contextual extraction.

Built-in functions only. The base entities are seeds: the words before them are
patterns, patterns and the identifiers behind them form a graph, and scores go to
and fro in it. Patterns that mostly precede seeds find identifiers of other forms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import staged

# Kinds in order. The possessive forms find what the plain ones find, without
# going back; \G and the look-behind start at a run's first character only.
_LOCAL = r"[A-Za-z0-9._%+-]"
_HOST = r"[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:(?<![0-9])|\G)[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# Texts without a match of these have none of the kind.
_MAY_HOLD = {
    "email": lambda text: text.contains("@"),
    "ip": lambda text: text.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
    "card": lambda text: text.rlike(r"[0-9](?:[ -]?[0-9]){13}"),
    "phone": lambda text: text.contains("+"),
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_SPACE = r"\x20\x09-\x0D"
# A word with a digit; at least so many code points without the marks around it.
IDENTIFIER = rf"(?<![^{_SPACE}])[^{_SPACE}0-9]*+[0-9][^{_SPACE}]*+"
IDENTIFIER_LENGTH = 6
OTHER = "id"
# A pattern counts from so many different seeds and so large a share of what it precedes.
SUPPORT, CONFIDENCE, ROUNDS = 5, 0.8, 3
# What may stand between the members of a list, which share what stands before it.
_LISTED = r"^[,;/|&]+$"
_CHUNK = 512

_SPAN = "array<struct<start:int,end:int,value:string,gap:string>>"


def _let(value: Column, body) -> Column:
    """The body's value where the argument is worked out once."""
    return F.transform(F.array(value), body)[0]


def _last_words(words: Column) -> Column:
    """The last two of some words, null if all of them only separate."""
    size = F.size(words)
    two = F.array_join(F.slice(words, F.greatest(size - 1, F.lit(1)), F.lit(2)), " ")
    return F.when(F.exists(words, lambda w: ~w.rlike(_LISTED)), two)


def _placed(text: Column, pattern: str, may_hold: Column) -> Column:
    """All matches as structs of start, end, value and ``gap``, the last two words
    before it. A match that only separators part from the one before has that one's;
    after a short one, too short to be found itself, that one is the last word.
    Matches are summed up in chunks, so that many cost no square."""
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    steps = F.zip_with(
        found,
        gaps,
        lambda value, gap: F.struct(
            value.alias("value"),
            F.length(gap).alias("skip"),
            F.length(value).alias("size"),
            _let(F.filter(F.split(gap, rf"[{_SPACE}]+"), lambda w: w != ""), _last_words).alias("gap"),
        ),
    )

    def in_chunk(chunk):
        def add(done, step):
            start = done["at"] + step["skip"]
            end = start + step["size"]
            gap = F.coalesce(step["gap"], done["near"])
            span = F.struct(start.alias("start"), end.alias("end"), step["value"].alias("value"), gap.alias("gap"))
            last = F.element_at(F.split(F.coalesce(gap, F.lit("")), " "), -1)
            short = F.trim(F.concat_ws(" ", last, step["value"]))
            near = F.when(step["size"] < IDENTIFIER_LENGTH, short).otherwise(gap)
            return F.struct(
                end.alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"), near.alias("near")
            )

        empty = F.struct(
            F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"), F.lit(None).cast("string").alias("near")
        )
        return F.aggregate(chunk, empty, add)

    def all_chunks(steps):
        last = F.greatest(F.size(steps) - 1, F.lit(0))
        chunks = F.transform(
            F.sequence(F.lit(0), F.floor(last / _CHUNK).cast("int")),
            lambda c: in_chunk(F.slice(steps, c * _CHUNK + 1, F.lit(_CHUNK))),
        )

        def add(done, chunk):
            moved = F.transform(
                chunk["spans"],
                lambda s: F.struct(
                    (done["at"] + s["start"]).alias("start"),
                    (done["at"] + s["end"]).alias("end"),
                    s["value"].alias("value"),
                    F.coalesce(s["gap"], done["near"]).alias("gap"),
                ),
            )
            return F.struct(
                (done["at"] + chunk["at"]).alias("at"),
                F.concat(done["parts"], F.array(moved)).alias("parts"),
                F.coalesce(chunk["near"], done["near"]).alias("near"),
            )

        empty = F.struct(
            F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("parts"), F.lit("").alias("near")
        )
        return F.aggregate(chunks, empty, add, lambda done: F.flatten(done["parts"]))

    # A text has one piece more than it has matches; that last one has no value.
    whole = _let(F.filter(steps, lambda s: s["value"].isNotNull()), all_chunks)
    return F.when(may_hold, whole).otherwise(F.array().cast(_SPAN))


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", F.substring(digits, 1, 19))
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _base(text: Column) -> Column:
    """Base spans as structs of start, order of the kind, end, value and gap, in that order."""

    def of(number: int, kind: str):
        kept = F.filter(_placed(text, PATTERNS[kind], _MAY_HOLD[kind](text)), lambda s: _valid(kind, s["value"]))
        return F.transform(
            kept,
            lambda s: F.struct(
                s["start"].alias("start"),
                F.lit(number).alias("kind"),
                s["end"].alias("end"),
                s["value"].alias("value"),
                s["gap"].alias("gap"),
            ),
        )

    return F.array_sort(F.concat(*(of(number, kind) for number, kind in enumerate(PATTERNS))))


def _identifiers(text: Column) -> Column:
    """Words with a digit, without quotes, brackets and stops around them."""

    def trimmed(span):
        ahead = F.length(F.regexp_extract(span["value"], r"^[\"'(\[{<]*+", 0))
        behind = F.length(F.regexp_extract(span["value"], r"(?<![\"')\]}>.,;:!?])[\"')\]}>.,;:!?]*+$", 0))
        size = F.length(span["value"])
        return F.struct(
            (span["start"] + ahead).alias("start"),
            F.lit(len(PATTERNS)).alias("kind"),
            (span["end"] - behind).alias("end"),
            F.substr(span["value"], ahead + 1, size - ahead - behind).alias("value"),
            span["gap"].alias("gap"),
        )

    found = F.transform(_placed(text, IDENTIFIER, text.rlike("[0-9]")), trimmed)
    return F.filter(found, lambda s: s["end"] - s["start"] >= IDENTIFIER_LENGTH)


def _patterns(gap: Column) -> Column:
    """The last word and the last two words before a span."""
    text = F.lower(gap)
    one = F.regexp_extract(text, rf"([^{_SPACE}]+)[{_SPACE}]*$", 1)
    two = F.regexp_replace(F.regexp_extract(text, rf"([^{_SPACE}]+[{_SPACE}]+[^{_SPACE}]+)[{_SPACE}]*$", 1), rf"[{_SPACE}]+", " ")
    return F.filter(F.array_distinct(F.array(one, two)), lambda p: p != "")


def _looked(docs: DataFrame, *columns: str) -> DataFrame:
    """Documents with ``row_``, ``base_`` and ``others_``, the identifiers that no base
    span overlaps; written, so that row numbers stay."""
    named = docs.select(
        F.monotonically_increasing_id().alias("row_"),
        *columns,
        _base(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("base_"),
        _identifiers(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("others_"),
    )
    free = F.filter(
        "others_",
        lambda o: ~F.exists("base_", lambda b: (b["start"] < o["end"]) & (o["start"] < b["end"])),
    )
    return staged(named.withColumn("others_", free), "spans")


def _trusted(looked: DataFrame, support: int, confidence: float, rounds: int) -> DataFrame:
    """Patterns to trust, after rounds of scoring patterns by their instances and
    instances by their patterns."""
    spans = looked.select(F.explode(F.concat("base_", "others_")).alias("span")).select(
        F.explode(_patterns(F.col("span.gap"))).alias("pattern"),
        F.col("span.value").alias("instance"),
        (F.col("span.kind") < len(PATTERNS)).cast("int").alias("seed"),
    )
    edges = staged(spans.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "edges")
    scores = edges.groupBy("instance").agg(F.max("seed").cast("double").alias("score"))
    for turn in range(rounds):
        patterns = staged(
            edges.join(scores, "instance")
            .groupBy("pattern")
            .agg((F.sum("score") / (F.count("*") + 1)).alias("trust"), F.sum("seed").alias("seeds"))
            .where(F.col("seeds") >= support),
            "patterns",
        )
        if turn + 1 < rounds:
            scores = (
                edges.join(patterns, "pattern", "left")
                .groupBy("instance")
                .agg(F.greatest(F.max("seed"), F.coalesce(F.max("trust"), F.lit(0.0))).alias("score"))
            )
    return patterns.where(F.col("trust") >= confidence).select("pattern")


def _with_found(looked: DataFrame, *columns: str, support: int, confidence: float, rounds: int) -> DataFrame:
    """The columns with ``base`` and ``spans``, structs of start, kind and end.

    Only documents with further identifiers take part in the join.
    """
    trusted = _trusted(looked, support, confidence, rounds)
    plain = "transform({0}, s -> struct(s.start AS start, s.kind AS kind, s.end AS end))"
    base = F.expr(plain.format("base_")).alias("base")
    others = looked.where(F.size("others_") > 0)
    hits = (
        others.select("row_", F.explode("others_").alias("span"))
        .select("row_", "span", F.explode(_patterns(F.col("span.gap"))).alias("pattern"))
        .join(trusted, "pattern")
        .groupBy("row_")
        .agg(F.collect_set(F.struct("span.start", "span.kind", "span.end")).alias("found_"))
    )
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    alone = looked.where(F.size("others_") == 0).select(*columns, base, F.expr(plain.format("base_")).alias("spans"))
    joined = others.join(hits, "row_", "left").select(*columns, base, F.coalesce("found_", none).alias("found_"))
    return alone.union(joined.select(*columns, "base", F.array_sort(F.concat("base", "found_")).alias("spans")))


def find(
    docs: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE, rounds: int = ROUNDS
) -> DataFrame:
    """``doc_id``, ``base`` and ``spans`` of every document.

    Spans are structs of start, kind (number in the order of ``PATTERNS``, the next
    one for identifiers found by context) and end, in code points, sorted; ``spans``
    are the base ones and those found. Null and empty texts have none, repeated
    rows are treated each, no documents give no rows.
    """
    looked = _looked(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id")
    return _with_found(looked, "doc_id", support=support, confidence=confidence, rounds=rounds)


def listed(spans: str) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    kinds = F.array(*map(F.lit, [*PATTERNS, OTHER]))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"], s["end"])), ",")


def redact(
    docs: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE, rounds: int = ROUNDS
) -> DataFrame:
    """The documents with a mark such as ``[EMAIL]`` in place of every span.

    Overlapping spans become one mark, of the first one's kind. Columns stay as
    they are; null texts stay null. ``n_chars``, if there, follows the text.
    """
    marks = F.array(*(F.lit(f"[{kind.upper()}]") for kind in [*PATTERNS, OTHER]))
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc_"), F.col("text"))
    looked = _looked(whole, "doc_")
    found = _with_found(looked, "doc_", support=support, confidence=confidence, rounds=rounds)
    text = F.col("doc_.text")

    def replace(done, span):
        skip = F.greatest(span["start"] - done["at"], F.lit(0))
        mark = F.when(span["start"] >= done["at"], marks[span["kind"]]).otherwise("")
        return F.struct(
            F.greatest(span["end"], done["at"]).alias("at"),
            F.concat(done["parts"], F.array(F.substr(text, done["at"] + 1, skip), mark)).alias("parts"),
        )

    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    clean = F.aggregate(
        "spans", empty, replace, lambda d: F.concat(F.array_join(d["parts"], ""), F.substr(text, d["at"] + 1, F.length(text)))
    )
    done = found.select("doc_", F.when(F.size("spans") > 0, clean).otherwise(text).alias("text_"))
    columns = []
    for field in docs.schema.fields:
        value = F.col("doc_").getField(field.name)
        if field.name == "text":
            value = F.col("text_")
        elif field.name == "n_chars":
            value = F.when(value.isNull(), value).otherwise(F.length("text_")).cast(field.dataType)
        columns.append(value.alias(field.name))
    return done.select(*columns)
