"""Text, number and date expressions."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom import fixed_values as V

COMPACT_DAY = "yyyyMMdd"
DASHED_DAY = "yyyy-MM-dd"
SECOND = "yyyy-MM-dd HH:mm:ss"


def order_ref(
    remark: Column, phrase: str = V.ORDER_REF_PHRASE, marker: str = V.ORDER_REF_MARKER
) -> Column:
    """Digits after ``marker:``, only in remarks that hold the phrase, else NULL.

    The digit class covers every decimal digit, full-width ones included.
    """
    digits = F.regexp_extract(remark, re.escape(marker) + r":(\p{Nd}+)", 1)
    return F.when(remark.contains(phrase), F.nullif(digits, F.lit("")))


def to_number(value: Column) -> Column:
    """Number in a text, NULL where there is none."""
    return value.try_cast("double")


def report_number(value: Column, is_float: bool = False) -> Column:
    """Whole number with thousands separators; zero, NULL and NaN show as ''.

    Rounds half to even. ``is_float`` adds the NaN test, which decimals and
    integers do not need.
    """
    if is_float:
        value = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
    shown = F.format_number(F.when(value != 0, value), 0)
    return F.coalesce(shown, F.lit(""))


def compact_day(value: Column) -> Column:
    return F.date_format(value, COMPACT_DAY)


def dashed_day(value: Column) -> Column:
    return F.date_format(value, DASHED_DAY)


def second_stamp(value: Column) -> Column:
    return F.date_format(value, SECOND)


def parse_day(value: str | int | dt.date) -> dt.date:
    """A parameter given as a date, '20240101', '2024-01-01' or 20240101."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.datetime.strptime(str(value).replace("-", ""), "%Y%m%d").date()


def title(start: dt.date, end: dt.date, text: str) -> str:
    """Section title of a window."""
    return f"{start:%Y%m%d}-{end:%Y%m%d} {text}"
