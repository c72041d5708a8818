"""Vectors in shards, queries in groups, and the pairs of both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

LEAST_SHARDS = 16


def usable(table: DataFrame, non_zero: bool = False) -> DataFrame:
    """``vec_id`` and ``vector`` (doubles) of rows that take part.

    Vectors that are null, empty or hold null or non-finite components don't, nor
    rows without an id; with ``non_zero`` neither do zero vectors. Rows equal in id
    and vector count once; an id with several vectors has a row for each.
    """
    rows = table.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")
    )
    rows = rows.where("vec_id is not null and size(vector) > 0")
    rows = rows.where(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    if non_zero:
        rows = rows.where(F.exists("vector", lambda x: x != 0))
    return rows.distinct()


def shard_of(shards: int) -> Column:
    return F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")


def shard_count(rows: int, shard_rows: int) -> int:
    return max(LEAST_SHARDS, -(-rows // shard_rows))


def asked() -> Column:
    """Tells the queries of one id apart."""
    return F.xxhash64("vector").alias("asked")


def every(count: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))


def nearest(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of all shards' results: query_id, rank, vec_id, score. Queries of
    one id are told apart by ``asked``."""
    order = Window.partitionBy("query_id", "asked").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
