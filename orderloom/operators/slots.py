"""Time slots of the back-fill."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom import fixed_values as V


def hourly_slots(
    spark: SparkSession, as_of: dt.date, days: int = V.BACKFILL_DAYS
) -> DataFrame:
    """Every hour of the days before ``as_of``, the day itself left out."""
    first = dt.datetime.combine(as_of - dt.timedelta(days=days), dt.time())
    last = dt.datetime.combine(as_of, dt.time()) - dt.timedelta(hours=1)
    spine = F.sequence(
        F.lit(str(first)).cast("timestamp_ntz"),
        F.lit(str(last)).cast("timestamp_ntz"),
        F.expr("INTERVAL 1 HOUR"),
    )
    return spark.range(1).select(F.explode(spine).alias("slot"))


def fill_slots(slots: DataFrame, counts: DataFrame, name: str = "n") -> DataFrame:
    """Counts of all slots; a slot nothing fell into shows 0."""
    return slots.join(counts, "slot", "left").select(
        "slot", F.coalesce(name, F.lit(0)).alias(name)
    )
