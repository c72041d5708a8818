"""Changing stored tables by key.

Plain Parquet has no MERGE. An upsert is an anti join of the stored rows with
the batch plus the winners of each key. The batch is the small side of all these
joins: when its keys stay below the broadcast threshold the stored rows are not
shuffled at all.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderloom.operators.joins import span_of
from orderloom.session import remove, staging_path


def latest_per_key(
    rows: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]
) -> DataFrame:
    """One row per key, the first in the given order.

    Spark applies the rank limit before the shuffle too, so each task sends at
    most one row per key and a hot key cannot pile up in one task. The order
    should be total, else ties are picked at random.
    """
    order = Window.partitionBy(*keys).orderBy(*newest_first)
    return rows.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def _key_columns(keys: Sequence[str]) -> list[Column]:
    """Keys in a form in which equality is enough: NULL equals NULL."""
    columns = []
    for key in keys:
        columns.append(F.coalesce(F.col(key).cast("string"), F.lit("")).alias(f"_{key}"))
        columns.append(F.col(key).isNull().alias(f"_{key}_null"))
    return columns


def _same_key(keys: Sequence[str]) -> Column:
    parts = []
    for key in keys:
        parts.append(F.coalesce(F.col(key).cast("string"), F.lit("")) == F.col(f"_{key}"))
        parts.append(F.col(key).isNull() == F.col(f"_{key}_null"))
    return reduce(lambda a, b: a & b, parts)


def _key_side(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each key once. Repeats go before the shuffle, which the join then shares."""
    return rows.select(*_key_columns(keys)).distinct()


def unknown_rows(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the batch whose key is not stored yet."""
    return batch.join(_key_side(target, keys), _same_key(keys), "left_anti")


def known_rows(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the batch whose key is stored."""
    return batch.join(_key_side(target, keys), _same_key(keys), "left_semi")


def fresh_rows(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the batch whose key is not stored yet, for a target much larger.

    Stored keys are first cut down to those of the batch, so that a small batch
    is broadcast and the stored keys stay where they are read.
    """
    return unknown_rows(batch, known_rows(target.select(*keys), batch, keys), keys)


def keyed(keys: Sequence[str]) -> Column:
    """No part of the key is NULL."""
    return reduce(lambda a, b: a & b, (F.col(key).isNotNull() for key in keys))


def total_order(rows: DataFrame, newest_first: Sequence[Column]) -> list[Column]:
    """The order, with ties broken by all values, so that no tie is left to chance."""
    return [*newest_first, F.xxhash64(*sorted(rows.columns))]


def stored_keys(target: DataFrame, keys: Sequence[str]) -> DataFrame:
    return target.select(*keys).distinct()


def upsert(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]
) -> DataFrame:
    """Stored rows with the batch written over them.

    ``newest_first`` decides between batch rows of one key; columns the target
    lacks are not carried over.
    """
    latest = latest_per_key(batch, keys, newest_first).select(*target.columns)
    return unknown_rows(target, batch, keys).unionByName(latest)


def append_new(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows plus the batch rows of keys not stored yet.

    The key is that of a document: all lines of a new one enter.
    """
    return target.unionByName(fresh_rows(batch, target, keys).select(*target.columns))


def insert_ignore(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], oldest_first: Sequence[Column]
) -> DataFrame:
    """Stored rows plus the first batch row of each key not stored yet."""
    fresh = latest_per_key(fresh_rows(batch, target, keys), keys, oldest_first)
    return target.unionByName(fresh.select(*target.columns))


def upsert_actions(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What an upsert does with each key: inserted, updated or unchanged.

    Both sides are put below each other and grouped: one shuffle, and a key
    that fills either side combines on the map side.
    """
    stored = target.select(*keys, F.lit(True).alias("stored"), F.lit(False).alias("sent"))
    sent = batch.select(*keys, F.lit(False).alias("stored"), F.lit(True).alias("sent"))
    seen = stored.unionByName(sent).groupBy(*keys).agg(
        F.max("stored").alias("stored"), F.max("sent").alias("sent")
    )
    action = (
        F.when(~F.col("stored"), "inserted").when(F.col("sent"), "updated").otherwise("unchanged")
    )
    return seen.select(*keys, action.alias("action"))


def upsert_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    newest_first: Sequence[Column],
    partition: str,
    keys_move: bool = True,
    load: str | None = None,
    origin: Sequence[str] = (),
) -> None:
    """Upsert into a partitioned Parquet table, reading and rewriting touched
    partitions only.

    Touched are the partitions the batch writes to and those its keys are
    stored in. Finding the latter reads the row groups that can hold the batch's keys:
    by Bloom filters where they are few, else between the least and the greatest;
    ``keys_move=False`` spares that where a key never changes its
    partition. The partition column
    is a plain text, such as a month.

    Stored rows compete with those of the batch: ``newest_first`` decides, ties
    go by all values, so the table does not depend on how its rows were split
    into batches or in which order these came.

    Merged rows go to a staging folder before the table is written, and the
    table is marked while its partitions are replaced: a run that breaks off
    there is finished by the next one from the staged rows. A run that breaks
    off earlier has changed nothing. Staging folders belong to the table, which
    takes one load at a time.

    With the name of a ``load``, what it did with each of its keys is written along
    with the partitions and read by ``table_changes``; ``origin`` are columns that
    don't count as values.
    """
    path = path.rstrip("/")
    finish_replacing(spark, path, partition, keys)
    stage = {name: staging_path(path, name) for name in ("batch", "touched", "merged", "changes")}
    sent = latest_per_key(batch, keys, total_order(batch, newest_first))
    sent.write.mode("overwrite").parquet(stage["batch"])
    latest = spark.read.parquet(stage["batch"])
    sent_rows = latest.count()
    if not sent_rows:
        remove(spark, stage["batch"])
        return
    target = stored_table(spark, path, latest.schema)
    touched = latest.select(partition)
    if keys_move:
        # Keys out of the batch's span are skipped where they are stored.
        near = target.where(span_of(latest, keys[0]).holds(keys[0]))
        stored = known_rows(near.select(*keys, partition), latest, keys)
        touched = touched.union(stored.select(partition))
    # Names of partitions, of which a table has a bounded number.
    names = sorted(row[0] for row in touched.distinct().collect())
    if odd := [name for name in names if not name or not PLAIN_NAME.fullmatch(name)]:
        raise ValueError(f"{partition} cannot name a folder: {odd[:3]}")
    # A list of names reaches the scan as a partition filter.
    old = target.where(F.col(partition).isin(names)).select(*latest.columns)
    merged = contest(old, latest, keys, newest_first, origin, few=sent_rows <= FEW_ROWS)
    merged.write.mode("overwrite").parquet(stage["merged"])
    if load is not None:
        changes = spark.read.parquet(stage["merged"]).where(F.col(ACTION).isNotNull())
        named = changes.select(*keys, F.col(ACTION).alias("action"), F.lit(load).alias("load"))
        named.write.mode("overwrite").parquet(stage["changes"])
    else:
        remove(spark, stage["changes"])
    spark.createDataFrame([(n,) for n in names], f"`{partition}` STRING").write.mode("overwrite").parquet(
        stage["touched"]
    )
    _mark(spark, path, REPLACING)
    finish_replacing(spark, path, partition, keys)


REPLACING, MERGING, WHOLE = "replacing", "merging ", "whole"
PLAIN_NAME = re.compile(r"[\w.-]+")


def _mark(spark: SparkSession, path: str, state: str) -> None:
    row = spark.range(1, numPartitions=1).select(F.lit(state).alias("state"))
    row.write.mode("overwrite").text(staging_path(path, "state"))


def _noted(spark: SparkSession, path: str) -> str | None:
    """The line of a note in a folder, None where there is no note."""
    try:
        row = spark.read.text(path).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return row and row.value


def finish_replacing(spark: SparkSession, path: str, partition: str, keys: Sequence[str] = ()) -> None:
    """Replace the touched partitions by the staged rows if the table is marked so."""
    path = path.rstrip("/")
    if _noted(spark, staging_path(path, "state")) != REPLACING:
        return
    staged = spark.read.parquet(staging_path(path, "merged")).drop(ACTION)
    touched = spark.read.parquet(staging_path(path, "touched"))
    write_partitions(staged, path, partition, keys)
    # Partitions all rows have moved out of.
    for row in touched.join(staged.select(partition).distinct(), partition, "left_anti").collect():
        remove(spark, f"{path}/{partition}={row[0]}")
    changes = stored_table(spark, staging_path(path, "changes"), None)
    if changes is not None:
        feed = changes.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        feed.partitionBy("load").parquet(f"{path}/_changes")
    _mark(spark, path, WHOLE)
    for name in ("batch", "touched", "merged", "changes"):
        remove(spark, staging_path(path, name))


ACTION = "_action"
# A batch of so many rows has its stored rivals looked up, so that others aren't shuffled.
FEW_ROWS = 100_000


def contest(
    old: DataFrame,
    latest: DataFrame,
    keys: Sequence[str],
    newest_first: Sequence[Column],
    origin: Sequence[str] = (),
    few: bool = False,
) -> DataFrame:
    """Stored rows with a batch of one row per key written over them, and what became of
    each key of the batch: inserted, updated or unchanged, by value. Others have no action.

    Both sides are put below each other and dealt by key once, which tells the winner as
    well as the action. With ``few`` rows in the batch only their rivals are dealt.
    """
    values = F.xxhash64(*sorted(set(latest.columns) - set(origin)))
    rivals = known_rows(old, latest, keys) if few else old
    both = rivals.withColumn("_sent", F.lit(False)).unionByName(latest.withColumn("_sent", F.lit(True)))
    order = Window.partitionBy(*keys).orderBy(*total_order(latest, newest_first))
    of_key = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seen = both.withColumn("_values", values).select(
        "*",
        F.row_number().over(order).alias("_rank"),
        F.max("_sent").over(of_key).alias("_meets"),
        F.max(F.when(~F.col("_sent"), F.col("_values"))).over(of_key).alias("_old"),
    )
    action = (
        F.when(~F.col("_meets"), None)
        .when(F.col("_old").isNull(), "inserted")
        .when(F.col("_old") == F.col("_values"), "unchanged")
        .otherwise("updated")
    )
    won = seen.where("NOT _meets OR _rank = 1").select(*latest.columns, action.alias(ACTION))
    if not few:
        return won
    none = F.lit(None).cast("string").alias(ACTION)
    return unknown_rows(old, latest, keys).select(*latest.columns, none).unionByName(won)


def table_changes(spark: SparkSession, path: str) -> DataFrame | None:
    """Keys of the loads that were given a name, with ``load`` and ``action``; None
    before the first."""
    return stored_table(spark, f"{path.rstrip('/')}/_changes", None)


def append_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    load: str,
    partition: str | None = None,
    run: str | None = None,
) -> None:
    """Write the batch rows of keys not stored yet to a folder of this load.

    A load that is run again replaces its own folder and does not count its
    earlier rows as stored, so a document never enters by halves. ``run`` tells
    what a load reads; a name that another run has taken is refused.

    The batch is staged, as it is asked for its keys first, and stored keys are read
    between its least and greatest only: loads lie in order of their keys.
    """
    path = path.rstrip("/")
    finish_merging(spark, path, partition, keys)
    note, run = f"{path}/_loads/{load}", run or load
    taken = _noted(spark, note)
    if taken not in (None, run):
        raise ValueError(f"load {load} has been used for other pages")
    schema = batch.select(*keys).schema.add("load", "string")
    known = stored_table(spark, path, schema)
    if known is not None:
        if taken is None and not known.where(F.col("load") == load).isEmpty():
            raise ValueError(f"load {load} is there, without a note of what it read")
    staged = staging_path(path, "batch")
    batch.write.mode("overwrite").parquet(staged)
    batch = spark.read.schema(batch.schema).parquet(staged)
    if known is not None:
        near = known.where((F.col("load") != load) & span_of(batch, keys[0]).holds(keys[0]))
        batch = fresh_rows(batch, near, keys)
    spark.range(1, numPartitions=1).select(F.lit(run)).write.mode("overwrite").text(note)
    _write_load(batch, f"{path}/load={load}", partition, keys)
    remove(spark, staged)


def _indexed(writer: DataFrameWriter, keys: Sequence[str]) -> DataFrameWriter:
    """With a Bloom filter of the first key in each row group, as large as it needs."""
    if not keys:
        return writer
    return writer.option(f"parquet.bloom.filter.enabled#{keys[0]}", "true").option(
        "parquet.bloom.filter.adaptive.enabled", "true"
    )


def _write_load(rows: DataFrame, folder: str, partition: str | None, keys: Sequence[str] = ()) -> None:
    if partition is None:
        dealt = rows.sortWithinPartitions(*keys) if keys else rows
        _indexed(dealt.write, keys).mode("overwrite").parquet(folder)
    else:
        dealt = rows.hint("rebalance", partition).sortWithinPartitions(partition, *keys)
        _indexed(dealt.write, keys).mode("overwrite").partitionBy(partition).parquet(folder)


def merge_loads(
    spark: SparkSession, path: str, into: str, partition: str | None = None, keys: Sequence[str] = ()
) -> None:
    """Put the rows of all loads so far into one, so that readers list few files.

    The rows are staged and the table is marked before a load goes, as an upsert
    does it. Notes of the merged loads stay: their names are not free again.
    """
    path = path.rstrip("/")
    finish_merging(spark, path, partition, keys)
    table = spark.read.parquet(path)
    table.select("load").distinct().write.mode("overwrite").parquet(staging_path(path, "touched"))
    table.drop("load").write.mode("overwrite").parquet(staging_path(path, "merged"))
    _mark(spark, path, MERGING + into)
    finish_merging(spark, path, partition, keys)


def finish_merging(
    spark: SparkSession, path: str, partition: str | None = None, keys: Sequence[str] = ()
) -> None:
    """Replace the merged loads by the staged rows if the table is marked so."""
    state = _noted(spark, staging_path(path, "state")) or ""
    if not state.startswith(MERGING):
        return
    into = state.removeprefix(MERGING)
    for row in spark.read.parquet(staging_path(path, "touched")).collect():  # a name per load
        remove(spark, f"{path}/load={row[0]}")
    _write_load(spark.read.parquet(staging_path(path, "merged")), f"{path}/load={into}", partition, keys)
    _mark(spark, path, WHOLE)
    for name in ("touched", "merged"):
        remove(spark, staging_path(path, name))


def stored_table(spark: SparkSession, path: str, schema: StructType | None) -> DataFrame | None:
    """The table at this path, or None where there is no such folder."""
    try:
        return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def write_partitions(rows: DataFrame, path: str, partition: str, keys: Sequence[str] = ()) -> None:
    """Replace the partitions that occur in the rows, with files of even size.

    Rows of a file are in order of the keys and each row group has a Bloom filter of
    the first one, so that readers who know which ones they want skip row groups. The
    writer sorts by partition in any case.
    """
    dealt = rows.hint("rebalance", partition).sortWithinPartitions(partition, *keys)
    (
        _indexed(dealt.write, keys)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
