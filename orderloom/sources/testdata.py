"""The test tables seen as the stored tables and as landed pages.

Nothing here groups or ranks: every stored row and every page comes from one
row of a test table plus key joins, so the mapping adds no hot spot of its own.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom import fixed_values as V
from orderloom.functions import classify, decode
from orderloom.operators import filters
from orderloom.operators.aggregates import money
from orderloom.sources import pages as P

SID = "s1"
WAREHOUSES = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
STATUS_CODES = {"F": "110", "O": "95", "P": "55"}
ORDER_CODES = {"F": "70", "O": "30", "P": "40"}
RECEIPT_CODES = {"F": "80", "O": "20"}
FLAG_CODES = {"A": "95", "N": "110", "R": "55"}
NOT_STOCKED_BRAND = "Brand#10"
NOT_LISTED_BRAND = "Brand#7"
NO_CLASS_TYPE = "PROMO"
NO_SHOP_SEGMENT = "FURNITURE"
NO_NAME_SEGMENT = "HOUSEHOLD"
WHOLESALE_SEGMENT = "MACHINERY"

# Stored rows lie before the cut, sent ones from a year before it on.
CUT = dt.date(2000, 1, 1)
RESENT_FROM = dt.date(1999, 1, 1)


# Given schemas spare a job per table that would read them from the files.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
    "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def code(column: str, codes: dict[str, str]) -> Column:
    return F.try_element_at(decode.literal_map(codes), F.col(column))


def line_key() -> Column:
    return F.concat_ws(
        "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.date_format("l_shipdate", "yyyyMMdd"),
    )


def shop_no() -> Column:
    segment = F.col("c_mktsegment")
    return (
        F.when(segment == WHOLESALE_SEGMENT, V.WHOLESALE_SHOP)
        .when(segment == NO_SHOP_SEGMENT, F.lit(None))
        .otherwise(segment)
    )


def shop_name() -> Column:
    segment = F.col("c_mktsegment")
    return F.when(segment != NO_NAME_SEGMENT, F.concat(F.lit("store "), segment))


HEADER_COLUMNS = {"status", "status_CN", "trade_type", "trade_type_name", "cs_remark"}
SHOP_COLUMNS = {"shop_no", "shop_name"}
WAREHOUSE_COLUMNS = {"warehouse_name"}


def documents(spark: SparkSession, folder: str, shop: bool = False) -> DataFrame:
    """One row per order with what its lines repeat of it."""
    orders = table(spark, folder, "orders")
    status, kind = code("o_orderstatus", STATUS_CODES), F.substring("o_orderpriority", 1, 1)
    columns = [
        F.col("o_orderkey"),
        status.alias("status"),
        decode.shipment_status(status).alias("status_CN"),
        kind.alias("trade_type"),
        decode.trade_type(kind).alias("trade_type_name"),
        F.col("o_orderpriority").alias("cs_remark"),
    ]
    if shop:
        customer = table(spark, folder, "customer")
        orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        columns += [shop_no().alias("shop_no"), shop_name().alias("shop_name")]
    return orders.select(*columns)


def suppliers(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers with the region that plays the warehouse."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return (
        table(spark, folder, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", F.col("r_name").alias("warehouse_name"))
    )


def sales_detail(spark: SparkSession, folder: str, columns: Iterable[str] = ()) -> DataFrame:
    """Sales lines. Document, shop and warehouse columns are joined on request."""
    wanted = set(columns)
    lines = table(spark, folder, "lineitem")
    shop = bool(wanted & SHOP_COLUMNS)
    extra = []
    if shop or wanted & HEADER_COLUMNS:
        docs = documents(spark, folder, shop)
        lines = lines.join(docs, F.col("l_orderkey") == F.col("o_orderkey"))
        extra += docs.columns[1:]
    if wanted & WAREHOUSE_COLUMNS:
        lines = lines.join(
            suppliers(spark, folder), F.col("l_suppkey") == F.col("s_suppkey")
        )
        extra.append("warehouse_name")
    return lines.select(
        line_key().alias("detail_rec_id"),
        F.col("l_orderkey").cast("string").alias("stockout_id"),
        F.col("l_orderkey").cast("string").alias("trade_no"),
        F.lit(SID).alias("sid"),
        F.col("l_partkey").cast("string").alias("detail_spec_no"),
        money(F.col("l_quantity")).alias("detail_goods_count"),
        money(F.col("l_extendedprice")).alias("detail_total_amount"),
        F.col("l_shipdate").alias("consign_time"),
        *extra,
    )


def sales_header(spark: SparkSession, folder: str) -> DataFrame:
    status = code("o_orderstatus", STATUS_CODES)
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("stockout_id"),
        F.lit(SID).alias("sid"),
        F.col("o_orderkey").cast("string").alias("trade_no"),
        status.alias("status"),
        decode.shipment_status(status).alias("status_CN"),
        money(F.col("o_totalprice")).alias("receivable"),
        F.col("o_orderpriority").alias("cs_remark"),
        F.col("o_orderdate").alias("consign_time"),
        F.col("o_orderdate").alias("modified"),
    )


def inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Each part in five warehouses; one brand is not stocked at all."""
    part = table(spark, folder, "part").where(F.col("p_brand") != NOT_STOCKED_BRAND)
    names = F.array(*(F.lit(w) for w in WAREHOUSES))
    return part.select("p_partkey", "p_size", "p_retailprice", F.posexplode(names)).select(
        F.col("p_partkey").cast("string").alias("spec_no"),
        F.col("col").alias("warehouse_name"),
        money(F.col("p_size") * (F.col("pos") + 1)).alias("stock_num"),
        (money(F.col("p_retailprice")) + money(F.col("pos") * 10))
        .cast("decimal(18,2)").alias("cost_price"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as products; one brand is not listed and one type has no class."""
    kind = F.col("p_type")
    return table(spark, folder, "part").where(F.col("p_brand") != NOT_LISTED_BRAND).select(
        F.lit(SID).alias("sid"),
        F.col("p_partkey").cast("string").alias("spec_no"),
        F.col("p_name").alias("goods_name"),
        F.when(kind != NO_CLASS_TYPE, kind).alias("class_name"),
        F.when(F.col("p_size") > 5, "pc").when(F.col("p_size") > 2, " ").alias("unit"),
    )


def purchases(spark: SparkSession, folder: str) -> DataFrame:
    """Lines as receipt lines: completed, shipped or unknown."""
    label = (
        F.when(F.col("l_linestatus") == "F", V.RECEIPT_DONE_LABEL)
        .when(F.col("l_returnflag") == "A", V.REPORT_STATUSES[1])
        .otherwise(V.SHIPMENT_STATUS_DEFAULT)
    )
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("stockin_id"),
        F.lit(SID).alias("sid"),
        line_key().alias("detail_rec_id"),
        F.col("l_shipdate").alias("stockin_time"),
        label.alias("status_CN"),
        F.col("l_partkey").cast("string").alias("detail_goods_no"),
        F.concat(F.lit("item "), "l_partkey").alias("detail_goods_name"),
        money(F.col("l_extendedprice")).alias("detail_total_cost"),
        money(F.col("l_quantity")).alias("detail_goods_count"),
        classify.tax_rate(F.col("l_tax").cast("decimal(9,4)")).alias("detail_tax"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return order_rows(table(spark, folder, "orders"))


def order_rows(rows: DataFrame) -> DataFrame:
    """The stored form of test orders, read at once or as a stream."""
    origin = F.substring("o_orderpriority", 1, 1)
    return rows.select(
        F.col("o_orderkey").cast("string").alias("trade_id"),
        F.lit(SID).alias("sid"),
        code("o_orderstatus", ORDER_CODES).alias("trade_status"),
        origin.alias("trade_from"),
        decode.order_origin(origin).alias("trade_from_CN"),
        money(F.col("o_totalprice")).alias("paid"),
        F.col("o_orderdate").alias("trade_time"),
        F.col("o_orderdate").alias("modified"),
        F.date_format("o_orderdate", "yyyy-MM").alias("trade_month"),
    )


def stored(rows: DataFrame, ts: str) -> DataFrame:
    return rows.where(F.col(ts) < filters.day_start(CUT))


def sent(rows: DataFrame, ts: str, changed: str) -> DataFrame:
    """Rows sent again or for the first time, with another amount."""
    dearer = (F.col(changed) + F.lit(10)).cast("decimal(18,2)")
    return rows.where(F.col(ts) >= filters.day_start(RESENT_FROM)).withColumn(changed, dearer)


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events")


# Landed pages -----------------------------------------------------------------

STAMP = "yyyy-MM-dd HH:mm:ss"

SALES_MAIN_LINE = {
    "rec_id": "key",
    "stockout_id": "key",
    "spec_no": "cast(l_partkey as string)",
    "goods_count": "cast(l_quantity as decimal(18,2))",
    "goods_name": "concat('item ', l_partkey)",
    "goods_no": "cast(l_partkey as string)",
    "total_amount": "cast(l_extendedprice as decimal(18,2))",
    "tax_rate": "cast(l_tax as decimal(9,4))",
    "modified": "stamp",
    "platform_id": "l_linenumber",
    "gift_type": "cast(null as string)",
}
SALES_GIFT_LINE = SALES_MAIN_LINE | {
    "rec_id": "concat(key, '-gift')",
    "goods_count": "cast(1 as decimal(18,2))",
    "total_amount": "cast(0 as decimal(18,2))",
    "gift_type": "'1'",
}
SALES_DOCUMENT = {
    "stockout_id": "key",
    "order_no": "concat('SO', l_orderkey)",
    "warehouse_no": "concat('wh-', l_suppkey)",
    "consign_time": "stamp",
    "status": "flag_code",
    "trade_status": "flag_code",
    "trade_type": "l_linenumber",
    "goods_count": "cast(l_quantity as decimal(18,2))",
    "receivable": "cast(l_extendedprice as decimal(18,2))",
    "trade_no": "l_orderkey",
    "shop_no": "cast(l_suppkey as string)",
    "modified": "stamp",
    "platform_id": "l_linenumber",
    "tax_rate": "cast(l_tax as decimal(9,4))",
    "cs_remark": "l_returnflag",
}
PURCHASE_MAIN_LINE = {
    "rec_id": "key",
    "spec_no": "cast(l_partkey as string)",
    "goods_count": "cast(l_quantity as decimal(18,2))",
    "tax": "cast(l_tax as decimal(9,4))",
    "total_cost": "cast(l_extendedprice as decimal(18,2))",
    "goods_name": "concat('item ', l_partkey)",
    "goods_no": "cast(l_partkey as string)",
}
PURCHASE_SPARE_LINE = PURCHASE_MAIN_LINE | {
    "rec_id": "concat(key, '-spare')",
    "total_cost": "cast(0 as decimal(18,2))",
}
PURCHASE_DOCUMENT = {
    "stockin_id": "key",
    "order_no": "concat('PO', l_orderkey)",
    "status": "receipt_code",
    "warehouse_no": "concat('wh-', l_suppkey)",
    "stockin_time": "stamp",
    "provider_no": "cast(l_suppkey as string)",
    "goods_count": "cast(l_quantity as decimal(18,2))",
    "total_price": "cast(l_extendedprice as decimal(18,2))",
    "modified": "stamp",
}
ORDER_DOCUMENT = {
    "trade_id": "o_orderkey",
    "trade_no": "concat('T', o_orderkey)",
    "platform_id": "o_custkey",
    "shop_no": "cast(o_custkey as string)",
    "trade_status": "order_code",
    "trade_type": "substring(o_orderpriority, 1, 1)",
    "trade_time": "stamp",
    "trade_from": "substring(o_orderpriority, 1, 1)",
    "modified": "stamp",
    "created": "stamp",
    "shop_remark": "o_orderpriority",
}


def _struct(fields: dict[str, str], *more: Column) -> Column:
    return F.struct(*(F.expr(sql).alias(name) for name, sql in fields.items()), *more)


def _page(list_field: str, errorcode: Column, total: Column, docs: Column) -> Column:
    """JSON text of a page; a NULL field is left out of it."""
    response = F.struct(
        errorcode.alias("errorcode"), total.alias("total_count"), docs.alias(list_field)
    )
    return F.to_json(
        F.struct(
            F.lit(SID).alias("sid"),
            F.col("stamp").alias("start_time"),
            F.col("next_stamp").alias("end_time"),
            F.col("page_no"),
            response.alias("response"),
        )
    )


def _with_stamps(rows: DataFrame, ts: str) -> DataFrame:
    return rows.withColumns(
        {
            "stamp": F.date_format(ts, STAMP),
            "next_stamp": F.date_format(F.col(ts) + F.expr("INTERVAL 1 DAY"), STAMP),
        }
    )


def _line_rows(spark: SparkSession, folder: str, only: Column | None = None) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    rows = _with_stamps(lines if only is None else lines.where(only), "l_shipdate")
    return rows.withColumns(
        {
            "key": line_key(),
            "flag_code": code("l_returnflag", FLAG_CODES),
            "receipt_code": code("l_linestatus", RECEIPT_CODES),
            "page_no": F.col("l_linenumber"),
            "errorcode": F.when(F.col("l_tax") == 0.07, 1050).when(F.col("l_tax") < 0.08, 0),
        }
    )


def _with_values(rows: DataFrame, *layouts: dict[str, str]) -> DataFrame:
    """Adds each value of the layouts under its SQL, so that it is made once per row."""
    found = dict.fromkeys(sql for fields in layouts for sql in fields.values())
    return rows.select("*", *(F.expr(sql).alias(f"value {sql}") for sql in found))


def _struct_of_values(fields: dict[str, str], *more: Column) -> Column:
    return F.struct(*(F.col(f"`value {sql}`").alias(name) for name, sql in fields.items()), *more)


def _one_or_two(first: Column, test: Column, second: Column) -> Column:
    """A list whose second entry depends on a test. Filtering a list instead would have
    everything in it evaluated without generated code."""
    return F.when(test, F.array(first, second)).otherwise(F.array(first))


def sales_pages(spark: SparkSession, folder: str) -> DataFrame:
    """A page per line: a document of one or two lines, at times one with none."""
    bare = SALES_DOCUMENT | {"stockout_id": "concat(key, '-empty')"}
    main, gift = _struct_of_values(SALES_MAIN_LINE), _struct_of_values(SALES_GIFT_LINE)
    lines = _one_or_two(main, F.col("l_discount") > 0.05, gift)
    shipped = _struct_of_values(SALES_DOCUMENT, lines.alias("details_list"))
    empty = _struct_of_values(bare, F.slice(F.array(main), 1, 0).alias("details_list"))
    docs = _one_or_two(shipped, F.col("l_discount") == 0, empty)
    total = F.when(F.col("l_discount") == 0, 2).otherwise(1)
    rows = _with_values(
        _line_rows(spark, folder), SALES_DOCUMENT, bare, SALES_MAIN_LINE, SALES_GIFT_LINE
    )
    return rows.select(_page("stockout_list", F.col("errorcode"), total, docs).alias("body"))


def purchase_pages(
    spark: SparkSession, folder: str, again: bool = False, only: Column | None = None
) -> DataFrame:
    """A page per receipt. ``again`` gives another copy, with other lines in it, and
    ``only`` those of some rows of the table."""
    changes = {"rec_id": "concat(key, '-again')", "total_cost": "cast(1 as decimal(18,2))"} if again else {}
    first = PURCHASE_MAIN_LINE | changes
    main, spare = _struct_of_values(first), _struct_of_values(PURCHASE_SPARE_LINE)
    lines = _one_or_two(main, F.col("l_discount") > 0.05, spare)
    docs = F.array(_struct_of_values(PURCHASE_DOCUMENT, lines.alias("details_list")))
    rows = _with_values(_line_rows(spark, folder, only), PURCHASE_DOCUMENT, first, PURCHASE_SPARE_LINE)
    return rows.select(_page("stockin_list", F.col("errorcode"), F.size(docs), docs).alias("body"))


def order_pages(
    spark: SparkSession,
    folder: str,
    only: str = "true",
    changes: dict[str, str] | None = None,
    files: int | None = None,
) -> DataFrame:
    """A page per order; a day declares all its orders, urgent ones fail to land.
    ``files`` deals them into so many parts, before their texts are built."""
    orders = table(spark, folder, "orders")
    declared = orders.groupBy("o_orderdate").agg(F.count(F.lit(1)).alias("total"))
    rows = _with_stamps(orders.join(declared, "o_orderdate"), "o_orderdate").withColumns(
        {
            "page_no": F.floor(F.col("o_orderkey") / V.ORDER_PAGE_SIZE).cast("int"),
            "order_code": code("o_orderstatus", ORDER_CODES),
            "errorcode": F.when(F.col("o_orderpriority") == "1-URGENT", 1050).otherwise(0),
        }
    )
    docs = F.array(_struct(ORDER_DOCUMENT | (changes or {})))
    chosen = rows.where(only)
    if files is not None:
        chosen = chosen.repartition(files, "o_orderkey")
    return chosen.select(
        _page("trades", F.col("errorcode"), F.col("total"), docs).alias("body")
    )


PAGES = {"sales": (sales_pages, P.SALES), "purchase": (purchase_pages, P.PURCHASE),
         "order": (order_pages, P.ORDER)}


def parsed_pages(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    build, layout = PAGES[kind]
    return P.parse_pages(build(spark, folder), "body", layout)


# Compressed files can't be read in parts, so none grows beyond so many pages.
PAGES_PER_FILE = 250_000
LANDING_OPTIONS = {
    "compression": "gzip",
    "zlib.compress.level": "BEST_SPEED",
    "maxRecordsPerFile": str(PAGES_PER_FILE),
}


def landing_files(spark: SparkSession, folder: str) -> int:
    """An even number of files for a landing of all orders, so that none is too large."""
    return 2 * max(1, -(-table(spark, folder, "orders").count() // (2 * PAGES_PER_FILE)))


# So many pages of receipts land between two loads.
PAGES_PER_LANDING = 32_000_000


def landing_steps(spark: SparkSession, folder: str) -> list[Column]:
    """Parts of the lines, by order, that land one after the other: one where they are few."""
    steps = max(1, -(-table(spark, folder, "lineitem").count() // PAGES_PER_LANDING))
    if steps == 1:
        return [F.lit(True)]
    return [F.pmod(F.xxhash64("l_orderkey"), F.lit(steps)) == step for step in range(steps)]


def land(pages: DataFrame, path: str, *folders: str) -> None:
    """Append pages as compressed JSON lines, as an extraction job would land them."""
    writer = pages.write.mode("append").partitionBy(*folders)
    writer.options(**LANDING_OPTIONS).text(path)


def land_pages(spark: SparkSession, folder: str, kind: str, path: str) -> str:
    """Write the pages of a kind."""
    land(PAGES[kind][0](spark, folder), path)
    return path
