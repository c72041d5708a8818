"""Stored tables: Parquet folders, catalog tables or a database."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class DatabaseScan:
    """A table in a database, read in ranges of a numeric or time column."""

    url: str
    table: str
    column: str
    lower: str
    upper: str
    partitions: int
    properties: dict[str, str]


def read_table(spark: SparkSession, source: str | DatabaseScan) -> DataFrame:
    """A path is read as Parquet, a plain or dotted name from the catalog."""
    if isinstance(source, DatabaseScan):
        return spark.read.jdbc(
            source.url,
            source.table,
            column=source.column,
            lowerBound=source.lower,
            upperBound=source.upper,
            numPartitions=source.partitions,
            properties=source.properties,
        )
    if "/" in source:
        return spark.read.parquet(source)
    return spark.table(source)


def rename(table: DataFrame, names: list[str] | tuple[str, ...]) -> DataFrame:
    """New names by position."""
    return table.toDF(*names)
