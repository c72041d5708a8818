"""Mixing sources to target weights by hash thresholds, found in histograms of hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import WORD, staged

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
# Hash digits looked at per refinement, and in all: 256 buckets per source each time.
DIGITS, ALL_DIGITS = 2, 14
ROUNDS = 3


def _sized(docs: DataFrame, *columns: Column) -> DataFrame:
    """The columns, the source's ``key``, ``size`` in words, the row's ``hash`` and a
    ``salt`` of it."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text)
    return docs.select(
        *columns,
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("key"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.substring(F.md5(named), 1, ALL_DIGITS).alias("hash"),
    ).withColumn("salt", F.conv(F.substring("hash", ALL_DIGITS, 1), 16, 10).cast("int"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``key``, ``source_size`` and ``target`` of every source.

    Sources in order of their names, null last, take the weights in turn and share
    all words by them. No source gets more than ``most`` times its words; what it
    can't take is shared by the others, by weight, until none is above. That ends
    with sources of the smallest limit per weight at their limits and one level
    for the rest, which running sums over that order find at once.
    """
    cycle = F.array(*map(F.lit, weights))
    totals = sizes.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = totals.select("key", "source_size", F.get(cycle, turn).cast("long").alias("weight"))
    limited = weighed.withColumn("limit", most * F.col("source_size"))
    order = Window.orderBy(F.col("limit") / F.col("weight"), "key")
    before, everyone = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    share = limited.select(
        "*",
        (F.sum("source_size").over(everyone) - F.coalesce(F.sum("limit").over(before), F.lit(0))).alias("words"),
        (F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("heft"),
    ).withColumn("level", F.col("words").cast("double") / F.col("heft"))
    fits = F.col("level") * F.col("weight") <= F.col("limit")
    level = F.max_by(F.when(fits, F.col("level")), F.when(fits, F.col("heft"))).over(everyone)
    return share.select(
        "key",
        "source_size",
        F.least(F.col("limit").cast("double"), F.coalesce(level * F.col("weight"), F.lit(0.0))).alias("target"),
    )


def _salted(goals: DataFrame) -> DataFrame:
    """The few rows per source repeated by salt, so that no source is one task."""
    return goals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(15))))


def _cuts(sizes: DataFrame, goals: DataFrame, nearest: bool) -> DataFrame:
    """Where each source's rows, by hash, reach the ``left`` words of its goal.

    ``goals`` has ``key``, ``floor`` and ``most``, which say what rows count (those
    with a higher hash and at most that size), and ``left``. Words are summed by
    source and hash bucket, on the map side first. Running sums over at most 256
    buckets of a source find the one that the goal falls in; only its rows are
    looked at again, by their next digits. Returns ``key``, ``cut`` (the hash where
    the goal is reached), ``with_it`` (if its rows are taken) and the words ``left``
    without them; no row for a source that doesn't reach its goal.
    """
    cuts, open_ = None, goals.withColumn("head", F.lit(""))
    for digits in range(DIGITS, ALL_DIGITS + 1, DIGITS):
        headed = sizes.where("size > 0").withColumn("head", F.substring("hash", 1, digits - DIGITS))
        rows = headed.join(_salted(open_), ["key", "salt", "head"]).where("hash > floor and size <= most")
        buckets = rows.groupBy("key", "floor", "most", "left", F.substring("hash", 1, digits).alias("bucket")).agg(
            F.sum("size").alias("words"), F.min("hash").alias("low"), F.max("hash").alias("high")
        )
        to_here = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
        summed = buckets.withColumn("upto", F.sum("words").over(to_here))
        crossed = summed.where("upto >= left and upto - words < left")
        found = staged(crossed.withColumn("left", F.col("left") - (F.col("upto") - F.col("words"))), "cuts")
        with_it = F.lit(nearest) & (2 * F.col("left") >= F.col("words"))
        ended = found.where("low = high").select("key", F.col("low").alias("cut"), with_it.alias("with_it"), "left")
        cuts = ended if cuts is None else cuts.union(ended)
        open_ = found.where("low < high").select("key", "floor", "most", "left", F.col("bucket").alias("head"))
        if open_.isEmpty():
            break
    return cuts


def _chosen(sizes: DataFrame, goals: DataFrame, rounds: int) -> DataFrame:
    """``key`` and ``ranges``, the hashes and sizes of the rows taken once more.

    A round stops before the document that would pass the goal. The next goes on
    behind it with what still fits, and the last takes or leaves the document it
    meets, whichever comes nearer.
    """
    state = goals.where("part > 0").select(
        "key", F.lit("").alias("floor"), F.lit((1 << 63) - 1).alias("most"), F.col("part").alias("left")
    )
    ranges = None
    for turn in range(rounds):
        cuts = staged(_cuts(sizes, state, nearest=turn + 1 == rounds), "cuts")
        met = staged(state.drop("left").join(cuts, "key", "left"), "ranges")
        ranges = met if ranges is None else ranges.union(met)
        state = met.where("cut is not null").select(
            "key", F.col("cut").alias("floor"), F.floor("left").alias("most"), "left"
        ).where("left > 0")
    return ranges.groupBy("key").agg(F.collect_list(F.struct("floor", "most", "cut", "with_it")).alias("ranges"))


def _plan(sizes: DataFrame, weights: tuple[int, ...], most: int, rounds: int) -> DataFrame:
    goals = staged(_goals(sizes, weights, most), "targets")
    return _salted(goals.join(_chosen(sizes, goals, rounds), "key", "left"))


def _copies() -> Column:
    """How often a row is taken, by its source's plan."""
    taken = F.exists(
        "ranges",
        lambda r: (F.col("hash") > r["floor"])
        & (F.col("size") <= r["most"])
        & (r["cut"].isNull() | (F.col("hash") < r["cut"]) | ((F.col("hash") == r["cut"]) & r["with_it"])),
    )
    return F.col("whole") + F.coalesce(taken, F.lit(False)).cast("long")


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, rounds: int = ROUNDS
) -> DataFrame:
    """Words the mix takes of every document.

    Returns ``doc_id``, ``source``, ``size`` (0 for null and blank texts),
    ``source_size``, ``target`` (of its source), ``copies`` and ``taken`` = size
    times copies. A source takes all its documents as often as they fit whole, and
    some, told by hash thresholds, once more. The hash is of id and text, so reruns
    agree, and equal rows go together. No rows for no documents.
    """
    columns = F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source")
    sizes = staged(_sized(docs, *columns), "sizes")
    rows = sizes.join(_plan(sizes, weights, most, rounds), ["key", "salt"])
    return rows.select("doc_id", "source", "size", "source_size", "target", _copies().alias("copies")).withColumn(
        "taken", F.col("size") * F.col("copies")
    )


def mixed(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, rounds: int = ROUNDS
) -> DataFrame:
    """The documents that ``mix`` takes, each as often as it takes it, all columns kept."""
    sizes = staged(_sized(docs, F.col("source").cast("string").alias("source")), "sizes")
    whole = _sized(docs, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc_"))
    rows = whole.join(_plan(sizes, weights, most, rounds), ["key", "salt"])
    return rows.select("doc_", F.explode(F.array_repeat(F.lit(0), _copies().cast("int")))).select("doc_.*")


def _goals(sizes: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    goals = targets(sizes, weights, most)
    size = F.greatest("source_size", F.lit(1))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / size)).otherwise(0).cast("long")
    return goals.withColumn("whole", whole).withColumn("part", F.col("target") - F.col("whole") * F.col("source_size"))
