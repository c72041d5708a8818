"""Landed pages of nested documents.

A page file holds one JSON object per line: the request (tenant, window, page
number) and the response envelope with its list of documents.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from orderloom import fixed_values as V
from orderloom import schemas as S


@dataclass(frozen=True)
class PageKind:
    list_field: str
    page_size: int
    document: str
    key: str

    @property
    def schema(self) -> StructType:
        return S.page_schema(self.list_field, self.document)


SALES = PageKind(
    "stockout_list",
    V.SALES_PAGE_SIZE,
    S.struct_ddl(S.SALES_DOCUMENT_FIELDS, S.SALES_LINE_FIELDS),
    "stockout_id",
)
PURCHASE = PageKind(
    "stockin_list",
    V.PURCHASE_PAGE_SIZE,
    S.struct_ddl(S.PURCHASE_DOCUMENT_FIELDS, S.PURCHASE_LINE_FIELDS),
    "stockin_id",
)
ORDER = PageKind("trades", V.ORDER_PAGE_SIZE, S.struct_ddl(S.ORDER_FIELDS), "trade_id")

JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "corrupt",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
}


# Folder a page may land in: the last day of its request window.
DAY_FOLDER = "day"


def _schema(kind: PageKind, by_day: bool) -> StructType:
    return StructType(kind.schema.fields).add(DAY_FOLDER, "string") if by_day else kind.schema


def _with_arrival(pages: DataFrame) -> DataFrame:
    return pages.select(
        "*",
        F.col("_metadata.file_modification_time").alias("landed_at"),
        F.col("_metadata.file_path").alias("source"),
    )


def read_pages(spark: SparkSession, path: str, kind: PageKind, by_day: bool = False) -> DataFrame:
    """All landed pages below a folder, with the file they came in and its time;
    ``by_day`` adds the day of the folder they landed in, NULL without one."""
    return _with_arrival(spark.read.schema(_schema(kind, by_day)).options(**JSON_OPTIONS).json(path))


def stream_pages(
    spark: SparkSession,
    path: str,
    kind: PageKind,
    files_per_batch: int = 1000,
    by_day: bool = False,
    clean: bool = False,
) -> DataFrame:
    """Pages as they land, with the columns of ``read_pages``. With ``clean`` the files of
    a batch are deleted when it is through and the next one begins."""
    stream = spark.readStream.schema(_schema(kind, by_day)).options(**JSON_OPTIONS)
    if clean:
        stream = stream.option("cleanSource", "delete")
    return _with_arrival(stream.option("maxFilesPerTrigger", files_per_batch).json(path))


def chosen_pages(
    pages: DataFrame,
    as_of: dt.datetime | None = None,
    days: int = V.LOOKBACK_DAYS,
    tenants: Sequence[str] | None = None,
) -> DataFrame:
    """Pages whose request window meets the last days before ``as_of``, of some tenants.

    Windows that end before that time are known by the folder they landed in, where
    pages are read ``by_day``: their files aren't opened. Others are parsed and asked.
    """
    if as_of is not None:
        low = as_of - dt.timedelta(days=days)
        at = lambda time: F.lit(str(time)).cast("timestamp_ntz")
        if DAY_FOLDER in pages.columns:
            folder = F.col(DAY_FOLDER)
            pages = pages.where(folder.isNull() | (folder >= low.date().isoformat()))
        pages = pages.where((F.col("end_time") >= at(low)) & (F.col("start_time") <= at(as_of)))
    return pages if tenants is None else pages.where(F.col("sid").isin(list(tenants)))


def parse_pages(table: DataFrame, body: str, kind: PageKind) -> DataFrame:
    """Pages held as JSON text in a column of a table.

    ``inline`` keeps filters on page fields above the parser. Pushed below it
    they would parse every text a second time.
    """
    page = F.from_json(F.col(body), kind.schema, JSON_OPTIONS)
    return table.select(F.inline(F.array(page)))


def accepted() -> Column:
    """The envelope carries the error code 0 and no field of the page is malformed.

    A number or time that does not parse, zero dates included, refuses the page:
    read as NULL it would drop out of every report unseen.
    """
    return F.coalesce(F.col("response.errorcode") == 0, F.lit(False)) & F.col("corrupt").isNull()


def reason() -> Column:
    """Why a page is refused."""
    code = F.coalesce(F.col("response.errorcode").cast("string"), F.lit("missing"))
    broken = F.col("corrupt").isNotNull() & F.coalesce(F.col("response.errorcode") == 0, F.lit(False))
    return F.when(broken, F.lit("malformed")).otherwise(F.concat(F.lit("error code "), code))


def valid_pages(pages: DataFrame, strict: bool = False) -> DataFrame:
    """Accepted pages. ``strict`` fails the job on any other."""
    if not strict:
        return pages.where(accepted())
    message = F.concat(F.lit("page refused, "), reason())
    return pages.where(F.when(accepted(), True).otherwise(F.raise_error(message).cast("boolean")))


def rejected_pages(pages: DataFrame) -> DataFrame:
    """Pages with a missing or non-zero error code or malformed content."""
    return pages.where(~accepted())


def documents(pages: DataFrame, kind: PageKind) -> DataFrame:
    """One row per document, with the page and the place it came from.

    A page without documents gives no row.
    """
    arrival = [c for c in ("landed_at", "source") if c in pages.columns]
    exploded = pages.select("sid", "page_no", *arrival, F.posexplode(f"response.{kind.list_field}"))
    return exploded.select("sid", "page_no", *arrival, F.col("pos").alias("place"), "col.*")


WINDOW = ("sid", "start_time", "end_time")


def window_marks(pages: DataFrame, kind: PageKind) -> DataFrame:
    """What counts towards the completeness of request windows, each mark once.

    A mark is a page with the total it declares, or a document. Refused pages mark
    their window and nothing else.
    """
    good = accepted()
    ids = F.transform(F.col(f"response.{kind.list_field}"), lambda d: d[kind.key].cast("string"))
    none = lambda name, kind: F.lit(None).cast(kind).alias(name)
    page = F.struct(
        F.when(good, F.col("response.total_count")).alias("total"),
        F.when(good, F.col("page_no")).alias("page"),
        none("document", "string"),
    )
    documents_of = F.transform(
        F.filter(F.coalesce(F.when(good, ids), F.array().cast("array<string>")), lambda i: i.isNotNull()),
        lambda i: F.struct(none("total", "bigint"), none("page", "int"), i.alias("document")),
    )
    return merged_marks(pages.select(*WINDOW, F.inline(F.concat(F.array(page), documents_of))))


def merged_marks(marks: DataFrame) -> DataFrame:
    """Marks of several landings, each once: those of all their pages."""
    return marks.groupBy(*WINDOW, "page", "document").agg(F.max("total").alias("total"))


def completeness(marks: DataFrame, kind: PageKind) -> DataFrame:
    """Per request window: what was declared against what has landed, by its marks."""
    landed = marks.groupBy(*WINDOW).agg(
        F.max("total").alias("declared"), F.count("document").alias("landed"), F.count("page").alias("pages")
    )
    expected = F.ceil(F.col("declared") / kind.page_size)
    whole = (F.col("landed") >= F.col("declared")) & (F.col("pages") >= F.col("expected_pages"))
    return landed.withColumn("expected_pages", expected).withColumn("complete", F.coalesce(whole, F.lit(False)))


def page_completeness(pages: DataFrame, kind: PageKind) -> DataFrame:
    """Per request window: what was declared against what has landed.

    Every window that was asked for is there, also if all its pages were refused:
    nothing of it is declared then, and it isn't complete. Documents count once,
    however often a page or a document has landed. A window in which nothing was
    declared is complete with no document.
    """
    return completeness(window_marks(pages, kind), kind)
