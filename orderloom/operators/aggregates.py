"""Grouped aggregates, roll-ups, totals and pivots.

Sums run on decimals, so that a result does not depend on the order in which
partitions arrive. Roll-ups and joins work on rows that have been summed per
item before: the first aggregation combines on the map side, so an item that
holds a third of all rows still shuffles as one row per task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom import fixed_values as V


def money(value: Column) -> Column:
    return value.cast("decimal(18,2)")


def rounded(value: Column, digits: int = 2) -> Column:
    return F.round(value, digits).cast("double")


def ratio(part: Column, whole: Column, digits: int = 2) -> Column:
    """Rounded quotient of two sums, NULL where the divisor is zero."""
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), digits)


def cost_per_item(inventory: DataFrame) -> DataFrame:
    """Highest cost of each item: one row per item, so a join cannot multiply."""
    return inventory.groupBy("spec_no").agg(F.max("cost_price").alias("cost_price"))


def stock_per_item(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("spec_no").agg(
        F.max("cost_price").alias("cost_price"), F.sum("stock_num").alias("stock")
    )


def rollup(
    table: DataFrame,
    group: str,
    measures: Sequence[Column],
    total: str = V.TOTAL_LABEL,
    unknown: str | None = V.UNKNOWN_LABEL,
    label: str = "label",
) -> DataFrame:
    """Groups plus a total row.

    ``grouping`` tells the total from a group whose value is NULL; the latter
    gets the label ``unknown``.
    """
    rolled = table.rollup(group).agg(F.grouping(group).alias("is_total"), *measures)
    named = F.coalesce(F.col(group), F.lit(unknown)) if unknown is not None else F.col(group)
    shown = F.when(F.col("is_total") == 1, total).otherwise(named)
    rest = [c for c in rolled.columns if c not in (group, "is_total")]
    return rolled.select(shown.alias(label), (F.col("is_total") == 1).alias("is_total"), *rest)


def with_total(
    table: DataFrame,
    texts: Sequence[str],
    total: str = V.TOTAL_LABEL,
    flag: str = "is_total",
) -> DataFrame:
    """All rows plus one that sums every other column, marked by ``flag``.

    One pass with grouping sets; cells that are no number are skipped. Text
    columns of the total row hold the label. Rows that agree in all texts
    would be added up, so the texts have to be a key of the table. One row of
    zeros joins in the total only: it is there for an empty table, too.
    """
    kinds = dict(table.dtypes)
    numbers = [c for c in table.columns if c not in texts]
    values = table.select(
        *texts, *(_as_number(c, kinds[c]).alias(c) for c in numbers), F.lit(False).alias("_zero")
    )
    zeros = table.sparkSession.range(1).select(
        *(F.lit(None).cast(kinds[c]).alias(c) for c in texts),
        *(F.lit(0).cast(values.schema[c].dataType).alias(c) for c in numbers),
        F.lit(True).alias("_zero"),
    )
    keys = [*texts, "_zero"]
    grouped = values.unionByName(zeros).groupingSets([keys, []], *keys).agg(
        F.grouping("_zero").alias(flag), *(F.sum(c).alias(c) for c in numbers)
    )
    is_total = F.col(flag) == 1
    return grouped.where(is_total | ~F.col("_zero")).select(
        is_total.alias(flag),
        *(F.when(is_total, total).otherwise(F.col(c)).alias(c) for c in texts),
        *numbers,
    )


def _as_number(column: str, kind: str) -> Column:
    return F.col(column).try_cast("double") if kind == "string" else F.col(column)


def distinct_days(table: DataFrame, ts: str, name: str = "day") -> DataFrame:
    return table.select(F.to_date(ts).alias(name)).distinct()


def daily_totals(
    table: DataFrame, keys: Sequence[str], ts: str, amount: str, count: str
) -> DataFrame:
    """Amount and count per key and day: the long form of the daily pivot."""
    return table.groupBy(*keys, F.to_date(ts).alias("day")).agg(
        F.sum(amount).alias("amount"), F.sum(count).alias("count")
    )


def daily_pivot(
    table: DataFrame,
    keys: Sequence[str],
    ts: str,
    amount: str,
    count: str,
    days: Sequence[dt.date],
    amount_name: str = "{day}_amount",
    count_name: str = "{day}_count",
    total: str | None = None,
) -> DataFrame:
    """Two columns per listed day; a key without rows on a day shows 0.

    The days are given, so Spark runs no extra job to find them. Rows are
    summed per key and day first and only those sums are spread out. With
    ``total`` one more row, marked by ``is_total``, sums all keys; it is added
    while the sums are still long, so wide rows are not shuffled for it.
    """
    long = daily_totals(table, keys, ts, amount, count)
    if total is not None:
        long = _with_daily_total(long, keys, total)
        keys = ["is_total", *keys]
    if not days:
        return long.select(*keys).distinct()
    shown = [day.isoformat() for day in days]
    wide = (
        long.withColumn("day", F.col("day").cast("string"))
        .groupBy(*keys)
        .pivot("day", shown)
        .agg(F.sum("amount").alias("amount"), F.sum("count").alias("count"))
    )
    zero = F.lit(0).cast("decimal(18,2)")
    cells = []
    for day in shown:
        cells += [
            F.coalesce(F.col(f"{day}_amount"), zero).alias(amount_name.format(day=day)),
            F.coalesce(F.col(f"{day}_count"), zero).alias(count_name.format(day=day)),
        ]
    return wide.select(*keys, *cells)


def numbered_days(days: DataFrame, width: int) -> DataFrame:
    """Days cut into blocks in order: ``block`` and ``place``, both from 1, and the
    days ``held`` by the block. There is one row per day, however long the window."""
    number = F.row_number().over(Window.orderBy("day")) - 1
    dealt = days.select("day", F.floor(number / width).cast("int").alias("block"), (number % width + 1).alias("place"))
    held = F.count(F.lit(1)).over(Window.partitionBy("block"))
    return dealt.select("day", (F.col("block") + 1).alias("block"), "place", held.alias("held"))


def blocked_pivot(
    long: DataFrame,
    keys: Sequence[str],
    days: DataFrame,
    amount_name: str = "amount_{place}",
    count_name: str = "count_{place}",
    total: str | None = None,
    width: int = V.LONG_WINDOW_DAYS + 1,
    order: Sequence[Column] = (),
) -> DataFrame:
    """The daily pivot of a window of any length, cut into blocks of days.

    ``long`` has the daily totals, one row per key and day, and ``days`` their numbers.
    Two columns per place in a block, and the blocks below each other: the plan is as
    wide as one block, and all of them come out of one shuffle. A key shows in the
    blocks it has rows in, with 0 on the other days there; places beyond the last day
    are NULL. ``total`` adds a row per block, as in ``daily_pivot``.

    The days of a key are gathered as the few entries they are and spread over the
    places last, as doubles, after the rows are put in ``order``: sums by place would
    hold, shuffle and sort all cells of a row, most of them empty.
    """
    if total is not None:
        long = _with_daily_total(long, keys, total)
        keys = ["is_total", *keys]
    placed = long.join(days, "day")
    zero, names = F.lit(0).cast("double"), ("amount", "count")
    nothing = F.struct(*(zero.alias(c) for c in names))
    entry = F.struct("place", F.struct(*(F.coalesce(F.col(c).cast("double"), zero).alias(c) for c in names)))
    packed = (
        placed.repartition("block", *keys)
        .groupBy("block", "held", *keys)
        .agg(F.map_from_entries(F.collect_list(entry)).alias("_cells"))
    )
    if order:
        packed = packed.orderBy(*order)
    cells = []
    for place in range(1, width + 1):
        # One expression for both columns: the code of a row stays small enough to be compiled.
        cell = F.coalesce(F.try_element_at("_cells", F.lit(place)), F.when(F.col("held") >= place, nothing))
        for name, shown in (("amount", amount_name), ("count", count_name)):
            cells.append(cell[name].alias(shown.format(place=place)))
    return packed.select("block", *keys, *cells)


def _with_daily_total(long: DataFrame, keys: Sequence[str], total: str) -> DataFrame:
    grouped = long.groupingSets([[*keys, "day"], ["day"]], *keys, "day").agg(
        F.grouping(keys[0]).alias("is_total"),
        F.sum("amount").alias("amount"),
        F.sum("count").alias("count"),
    )
    is_total = F.col("is_total") == 1
    names = [F.when(is_total, total).otherwise(F.col(k)).alias(k) for k in keys]
    return grouped.select(is_total.alias("is_total"), *names, "day", "amount", "count")


def slot_counts(table: DataFrame, ts: str, width: str = "1 hour", name: str = "n") -> DataFrame:
    """Rows per time slot; slots are half-open."""
    counted = table.groupBy(F.window(ts, width)).agg(F.count(F.lit(1)).alias(name))
    return counted.select(F.col("window.start").alias("slot"), name)
