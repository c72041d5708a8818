"""Joins of the reports.

No side carries a broadcast hint. Spark broadcasts one when its size is below the
threshold and shuffles otherwise, and AQE splits shuffle partitions that a hot key
makes too large. What is scanned counts with the size of its files, so the reports ask
for a shuffle where a side has a row per item (``never_sent``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Different values of a column up to which a scan is asked for each of them.
FEW_VALUES = 1000


@dataclass(frozen=True)
class Span:
    """Least and greatest value of a column of one side of a join, or its values
    where they are few.

    As plain values they reach the other side's scan, which then skips the row groups
    that can't hold them: tables written here are sorted by their keys, for spans,
    and have Bloom filters of them, for values.
    """

    low: object
    high: object
    nulls: bool = False
    values: tuple | None = None

    def holds(self, column: str) -> Column:
        """True for the values a row of the first side can have."""
        value = F.col(column)
        if self.low is None:
            return value.isNull() if self.nulls else F.lit(False)
        inside = value.between(F.lit(self.low), F.lit(self.high))
        if self.values is not None:
            inside = inside & value.isin(list(self.values))
        return inside | value.isNull() if self.nulls else inside


def span_of(rows: DataFrame, column: str) -> Span:
    """Span of a written table's column: however many rows there are, one comes back,
    and the values if there are no more than ``FEW_VALUES``."""
    value = F.col(column)
    nulls = F.coalesce(F.bool_or(value.isNull()), F.lit(False))
    *row, about = rows.agg(F.min(value), F.max(value), nulls, F.approx_count_distinct(value)).first()
    if about > 2 * FEW_VALUES:  # too many by far, so they aren't dealt out to be told apart
        return Span(*row, None)
    different = rows.where(value.isNotNull()).select(column).distinct().limit(FEW_VALUES + 1).collect()
    few = tuple(sorted(r[0] for r in different)) if len(different) <= FEW_VALUES else None
    return Span(*row, few)


def never_sent(side: DataFrame) -> DataFrame:
    """A side of a join that is shuffled at any size, never gathered by the driver.

    Spark takes the size of files for that of a table. Items compress well: a hundred
    times as many bytes, in each of several joins at once, then go to the driver.
    """
    return side.hint("merge")


def with_item_cost(lines: DataFrame, cost: DataFrame, item: str = "spec_no") -> DataFrame:
    """Lines with the cost of their item; lines of unknown items stay."""
    if item != "spec_no":
        cost = cost.withColumnRenamed("spec_no", item)
    return lines.join(cost, item, "left")


def with_header(
    lines: DataFrame, headers: DataFrame, columns: Sequence[str], fanout: bool = False
) -> DataFrame:
    """Lines with columns of their document header; lines without one stay.

    The document key is joined on. ``fanout`` joins on the trade number alone:
    a trade with several documents then repeats its lines.
    """
    keys = ["trade_no"] if fanout else ["stockout_id", "sid"]
    return lines.join(headers.select(*keys, *columns), keys, "left")


def with_product(
    items: DataFrame, products: DataFrame, columns: Sequence[str], item: str = "spec_no"
) -> DataFrame:
    """Items with product columns; an item listed twice among products repeats."""
    side = products.select(F.col("spec_no").alias(item), *columns)
    return items.join(side, item, "left")


def repeated_keys(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once: what would make a join multiply rows."""
    return table.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
