"""All reports as one set of titled sections."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, replace
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom import fixed_values as V
from orderloom.functions.text import report_number, title
from orderloom.operators.joins import span_of
from orderloom.plans import reports as R
from orderloom.plans.params import ReportParams
from orderloom.session import scratch_path


SECTIONS_AT_ONCE = 4


@dataclass(frozen=True)
class Tables:
    detail: DataFrame
    headers: DataFrame
    inventory: DataFrame
    products: DataFrame
    purchases: DataFrame


@dataclass(frozen=True)
class Section:
    name: str
    title: str
    table: DataFrame
    texts: tuple[str, ...]
    plain: tuple[str, ...] = ()
    headings: tuple[str, ...] = ()

    def shown(self) -> DataFrame:
        """Numbers as report text; ``plain`` columns, such as rates, stay bare."""
        return self.table.select(*(self._cell(c, kind) for c, kind in self.table.dtypes))

    def _cell(self, column: str, kind: str) -> Column:
        value = F.col(column)
        if column in self.texts:
            return value
        if column in self.plain:
            return value.cast("string").alias(column)
        return report_number(value, kind == "double").alias(column)


def shared_window(spark: SparkSession, t: Tables, p: ReportParams) -> DataFrame:
    """Window sums all sections but one are made from, as a written table.

    Written, not cached: each section filters in its own way, and the filters
    would otherwise be pushed down into scans of their own.
    """
    path = scratch_path(spark, "window")
    R.window_items(t.detail, p).write.parquet(path)
    return spark.read.parquet(path)


def offline_report(
    spark: SparkSession, detail: DataFrame, headers: DataFrame, inventory: DataFrame, p: ReportParams
) -> DataFrame:
    """The offline report from its lines as a written table, whose documents then
    tell which headers are read."""
    path = scratch_path(spark, "offline")
    R.offline_lines(R.in_window(detail, p), p).write.parquet(path)
    lines = spark.read.parquet(path)
    return R.offline_summary(lines, headers, inventory, p, span=span_of(lines, "stockout_id"))


def shared_receipts(spark: SparkSession, purchases: DataFrame, p: ReportParams) -> DataFrame:
    """Receipt sums the purchase section and its message are made from, as a written table."""
    path = scratch_path(spark, "receipts")
    R.receipt_sums(purchases, p).write.parquet(path)
    return spark.read.parquet(path)


def sections(spark: SparkSession, t: Tables, p: ReportParams) -> list[Section]:
    """The sections in report order. Runs the job that sums up the window."""
    lines = shared_window(spark, t, p)
    window = (p.start, p.end)
    sku = R.sku_detail(lines, t.inventory, t.products, p.online_shops, p)
    offline_sku = R.sku_detail(lines, t.inventory, t.products, p.offline_shops, p)
    offline = offline_report(spark, t.detail, t.headers, t.inventory, p)
    rate = ("cost_ratio",)
    return [
        Section("channel", title(*window, V.TITLE_CHANNEL),
                R.channel_summary(lines, t.inventory, p), ("label",), rate, V.SALES_HEADINGS),
        Section("online", title(*window, V.TITLE_ONLINE),
                R.online_summary(lines, t.inventory, p), ("label",), rate, V.SALES_HEADINGS),
        Section("offline", title(*window, V.TITLE_OFFLINE),
                offline, ("label",), rate, V.SALES_HEADINGS),
        Section("inventory", f"{p.end:%Y%m%d} {V.TITLE_INVENTORY}",
                R.inventory_summary(lines, t.inventory, t.products, p), ("label",), (),
                V.INVENTORY_HEADINGS),
        Section("sku_offline", V.SHEET_SKU_OFFLINE, offline_sku,
                ("spec_no", "goods_name"), (), V.SKU_HEADINGS),
        Section("sku_online", V.SHEET_SKU_ONLINE, sku,
                ("spec_no", "goods_name"), (), V.SKU_HEADINGS),
    ]


def purchase_section(t: Tables, p: ReportParams) -> Section:
    wide = R.purchase_detail(
        t.purchases, p, "{day}_" + V.PURCHASE_AMOUNT_SUFFIX, "{day}_" + V.PURCHASE_COUNT_SUFFIX
    )
    headings = V.PURCHASE_HEADINGS + tuple(wide.columns[2:])
    return Section("purchases", V.SHEET_PURCHASES, wide, R.PURCHASE_KEYS, (), headings)


def purchase_blocks_section(t: Tables, p: ReportParams) -> Section:
    """The purchases of a long window: blocks of days, under the number of the day."""
    wide = R.purchase_blocks(
        t.purchases, p, "{place}_" + V.PURCHASE_AMOUNT_SUFFIX, "{place}_" + V.PURCHASE_COUNT_SUFFIX
    )
    headings = ("block", *V.PURCHASE_HEADINGS, *wide.columns[3:])
    return Section("purchases", V.SHEET_PURCHASES, wide, R.PURCHASE_KEYS, ("block",), headings)


def purchase_days_section(t: Tables, p: ReportParams) -> Section:
    """The purchases in long form: one row per item and day, for any window."""
    days = R.purchase_days(t.purchases, p).withColumn("day", F.col("day").cast("string"))
    return Section("purchases", V.SHEET_PURCHASES, days, (*R.PURCHASE_KEYS, "day"))


def empty_message(p: ReportParams) -> str:
    return title(p.long_start, p.end, V.EMPTY_PURCHASES)


def section_index(spark: SparkSession, parts: Sequence[Section]) -> DataFrame:
    rows = [(i, s.name, s.title) for i, s in enumerate(parts, 1)]
    return spark.createDataFrame(rows, "ordinal INT, section STRING, title STRING")


def stacked(parts: Sequence[Section]) -> DataFrame:
    """Sections below each other: every cell as text, by position."""
    width = max(len(s.table.columns) for s in parts)
    frames = []
    for ordinal, part in enumerate(parts, 1):
        shown = part.shown()
        cells = [F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(shown.columns, 1)]
        blank = [
            F.lit(None).cast("string").alias(f"c{i}")
            for i in range(len(cells) + 1, width + 1)
        ]
        head = [F.lit(ordinal).alias("ordinal"), F.lit(part.name).alias("section"),
                F.lit(part.title).alias("title")]
        frames.append(shown.select(*head, *cells, *blank))
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def write_report(
    spark: SparkSession, t: Tables, p: ReportParams, out: str, form: str = "parquet"
) -> str:
    """Write all sections below a folder named after the window.

    Each section is one folder, sorted, under its own headings; ``index`` lists
    the titles in order. Without receipts ``message`` holds a line that says so.
    Purchases of a window longer than the usual one come in blocks of days, and
    ``days=purchases`` tells which day a place in a block is. ``form`` may be csv
    for readers other than Spark.
    """
    folder = f"{out}/start_date={p.start:%Y%m%d}/end_date={p.end:%Y%m%d}"
    t = replace(t, purchases=shared_receipts(spark, t.purchases, p))
    blocked = p.end - p.long_start > dt.timedelta(days=V.LONG_WINDOW_DAYS)
    purchases = (purchase_blocks_section if blocked else purchase_section)(t, p)
    parts = [*sections(spark, t, p), purchases]

    def write(part: Section) -> None:
        shown = part.shown().toDF(*part.headings)
        writer = shown.write.mode("overwrite").format(form)
        (writer.option("header", True) if form == "csv" else writer).save(
            f"{folder}/section={part.name}"
        )

    # Sections are small next to the window they come from: run side by side.
    with ThreadPool(SECTIONS_AT_ONCE) as pool:
        pool.map(inheritable_thread_target(spark)(write), parts)
    if blocked:
        days = R.block_days(t.purchases, p).select("block", "place", F.col("day").cast("string").alias("day"))
        days.orderBy("block", "place").write.mode("overwrite").format(form).save(f"{folder}/days=purchases")
    message = R.or_message(R.completed_receipts(t.purchases, p), empty_message(p))
    message.write.mode("overwrite").text(f"{folder}/message=purchases")
    section_index(spark, parts).coalesce(1).write.mode("overwrite").parquet(f"{folder}/index")
    return folder


def written_sections(spark: SparkSession, folder: str) -> DataFrame:
    """The index of a written report with the number of rows of each section."""
    index = spark.read.parquet(f"{folder}/index")
    names = [row.section for row in index.select("section").collect()]
    counts = None
    for name in names:
        rows = spark.read.parquet(f"{folder}/section={name}").agg(
            F.lit(name).alias("section"), F.count(F.lit(1)).alias("rows")
        )
        counts = rows if counts is None else counts.unionByName(rows)
    return index.join(counts, "section")
