"""Helpers of the operators: staged tables, words, connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.session import scratch_path

# Words are runs of anything but ASCII white space; ``bytes.split()`` finds the same ones.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def staged(frame: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again.

    Cuts the lineage: a lost executor costs no more than the tasks it ran.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def free_name(frame: DataFrame, name: str) -> str:
    """The name, or one like it, that no column has."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words(text) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").split()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Root of every node of an undirected graph, the smallest node it reaches.

    ``edges`` has long columns ``a`` and ``b``. Large-star and small-star steps
    alternate until the edges are stars; every step is a minimum per node,
    summed up before the shuffle, and a join Spark can split where a node has
    many edges. Returns ``node`` and ``root`` of the nodes that have edges; an
    empty graph gives no rows.
    """
    stars = staged(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
        .distinct(),
        "edges",
    )
    before = None
    for _ in range(rounds):
        after = stars.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(20,0)"))).first()
        if after == before:
            return stars
        before = after
        both = stars.union(stars.select("root", "node")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = moved.union(least).where("u <> v").distinct()
        stars = staged(small.toDF("node", "root"), "edges")
    raise RuntimeError(f"no components after {rounds} rounds")
