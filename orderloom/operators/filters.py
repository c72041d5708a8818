"""Row filters. All of them keep the bare column on one side, so that the
comparison reaches the Parquet scan and partition pruning."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom import fixed_values as V
from orderloom.functions.text import parse_day


def day_start(day: dt.date) -> Column:
    return F.lit(day.isoformat()).cast("timestamp_ntz")


def day_range(ts: str, start: str | int | dt.date, end: str | int | dt.date) -> Column:
    """Whole days from start to end, both included."""
    first, last = parse_day(start), parse_day(end)
    return (F.col(ts) >= day_start(first)) & (F.col(ts) < day_start(last + dt.timedelta(days=1)))


def days_of(
    table: DataFrame, ts: str, start: dt.date, end: dt.date, month: str
) -> DataFrame:
    """Rows of a range of days, read from the partitions of its months only
    where the table has the month of ``ts`` as a column."""
    found = table.where(day_range(ts, start, end))
    if month in table.columns:
        found = found.where(F.col(month).between(f"{start:%Y-%m}", f"{end:%Y-%m}"))
    return found


def lookback(ts: str, as_of: dt.datetime, days: int = V.LOOKBACK_DAYS) -> Column:
    """Records changed in the last days before ``as_of``, both ends included."""
    low = F.lit(str(as_of - dt.timedelta(days=days))).cast("timestamp_ntz")
    high = F.lit(str(as_of)).cast("timestamp_ntz")
    return F.col(ts).between(low, high)


def one_of(column: str, values: Iterable[str]) -> Column:
    return F.col(column).isin(list(values))


def none_of(column: str, values: Iterable[str]) -> Column:
    """Not one of the values; a NULL is dropped, as SQL's NOT IN does."""
    return ~F.col(column).isin(list(values))


def holds(column: str, text: str) -> Column:
    return F.col(column).contains(text)


def shipped(status: str = "status", lowest: int = V.SHIPPED_FROM_STATUS) -> Column:
    """Status code from ``lowest`` up; a code that is no number is dropped."""
    return F.col(status).try_cast("int") >= lowest


def first_match(table: DataFrame, column: str, value: str) -> DataFrame:
    """First row with this key."""
    return table.where(F.col(column) == value).limit(1)


def require_match(table: DataFrame, column: str, value: str) -> DataFrame:
    """Like ``first_match``, but a missing key is an error."""
    found = first_match(table, column, value)
    if found.isEmpty():
        raise LookupError(f"no row with {column} = {value}")
    return found


def in_scope(table: DataFrame, scope: DataFrame, column: str) -> DataFrame:
    """Rows whose key is listed in a scope table of any size."""
    return table.join(scope.select(column), column, "left_semi")
