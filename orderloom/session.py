"""Session settings and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the plans count on. AQE sizes shuffles, turns joins with a small
# measured side into broadcasts and splits skewed join partitions.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    # Lists of so many keys reach the Bloom filters of a scan; longer ones go as a range.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None) -> SparkSession:
    """Session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("orderloom")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    session = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _folder_of_this_machine()


@functools.cache
def _folder_of_this_machine() -> str:
    return tempfile.mkdtemp(prefix="orderloom-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, never used before."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def drop_shuffles(spark: SparkSession) -> None:
    """From here on the shuffles of this session go with the execution that wrote them,
    not when the driver happens to collect what names them."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def staging_path(table: str, name: str) -> str:
    """The path that loads of a table stage rows in, below the table itself.

    Readers skip folders with an underscore, and whoever finds the table finds
    what a broken run has left, on any machine and however the path is written.
    """
    return f"{table.rstrip('/')}/_staging/{name}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of staged rows, or a partition that is to be empty."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
