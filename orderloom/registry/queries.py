"""Every operator and report as a query over the test tables.

A query takes a session and the folder of the tables and reads them whole.
Times are shown as text, so that results compare across engines.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom import fixed_values as V
from orderloom import schemas as S
from orderloom.functions import classify, decode, text
from orderloom.operators import aggregates as A
from orderloom.operators import filters, flatten, joins, slots
from orderloom.operators import upsert as U
from orderloom.plans import bundle, loads
from orderloom.plans import reports as R
from orderloom.plans.params import ReportParams
from orderloom.session import scratch_path
from orderloom.sources import pages as P
from orderloom.sources import tables
from orderloom.sources import testdata as D
from orderloom.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

COMMON = dict(
    warehouses=("ASIA", "EUROPE"),
    online_shops=("AUTOMOBILE", "BUILDING", "HOUSEHOLD"),
    remark_phrase="URGENT",
    remark_label="urgent",
    store_names={"store BUILDING": "BLD", "store AUTOMOBILE": "AUT"},
)
# All years of the tables, so that a report reads every line of them.
WHOLE = ReportParams(
    start=dt.date(1995, 1, 1), end=dt.date(2001, 12, 31), long_start=dt.date(1995, 1, 1), **COMMON
)
# The usual windows, as of one day.
WEEK = ReportParams.as_of(dt.date(1998, 3, 8), **COMMON)
MONTH = ReportParams.as_of(dt.date(1998, 3, 31), **COMMON)
AS_OF = dt.date(2024, 1, 31)

DETAIL_COLUMNS = ("status_CN", "shop_no", "shop_name", "warehouse_name", "trade_type_name")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def doubles(table: DataFrame, *columns: str) -> DataFrame:
    return table.withColumns({c: F.col(c).cast("double") for c in columns})


def stamp(column: str) -> Column:
    return text.second_stamp(F.col(column)).alias(column)


def plain(table: DataFrame) -> DataFrame:
    """Decimals as doubles and times as text."""
    shown = []
    for column, kind in table.dtypes:
        if kind.startswith("decimal"):
            shown.append(F.col(column).cast("double").alias(column))
        elif kind.startswith("timestamp"):
            shown.append(stamp(column))
        elif kind == "date":
            shown.append(text.dashed_day(F.col(column)).alias(column))
        else:
            shown.append(F.col(column))
    return table.select(*shown)


# Sources ----------------------------------------------------------------------

def _landed(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    path = D.land_pages(spark, folder, kind, scratch_path(spark, f"{kind}-pages"))
    layout = D.PAGES[kind][1]
    pages = P.read_pages(spark, path, layout)
    return plain(
        pages.select(
            "sid", "start_time", "end_time", "page_no",
            F.col("response.errorcode").cast("string").alias("errorcode"),
            F.col("response.total_count").alias("total_count"),
            F.size(f"response.{layout.list_field}").alias("documents"),
        )
    )


@query
def src_sales_pages(spark, folder):
    return _landed(spark, folder, "sales")


@query
def src_purchase_pages(spark, folder):
    return _landed(spark, folder, "purchase")


@query
def src_order_pages(spark, folder):
    return _landed(spark, folder, "order")


@query
def envelope_valid(spark, folder):
    pages = P.valid_pages(D.parsed_pages(spark, folder, "sales"))
    return pages.groupBy("page_no").agg(
        F.count(F.lit(1)).alias("pages"), F.sum("response.total_count").alias("documents")
    )


@query
def envelope_rejects(spark, folder):
    pages = P.rejected_pages(D.parsed_pages(spark, folder, "sales"))
    errorcode = F.col("response.errorcode").cast("string")
    return pages.groupBy(errorcode.alias("errorcode"), "page_no").agg(
        F.count(F.lit(1)).alias("pages")
    )


@query
def page_completeness(spark, folder):
    return plain(P.page_completeness(D.parsed_pages(spark, folder, "order"), P.ORDER))


@query
def hourly_spine_counts(spark, folder):
    counts = A.slot_counts(D.events(spark, folder), "ts")
    return plain(slots.fill_slots(slots.hourly_slots(spark, AS_OF, 31), counts))


@query
def lookback_filter(spark, folder):
    changed = filters.lookback("ts", dt.datetime.combine(AS_OF, dt.time()))
    found = D.events(spark, folder).where(changed)
    return found.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), text.second_stamp(F.min("ts")).alias("first")
    )


@query
def existing_keys(spark, folder):
    return U.stored_keys(D.purchases(spark, folder), S.PURCHASE_KEY)


@query
def key_lookup(spark, folder):
    customer = D.table(spark, folder, "customer")
    return filters.first_match(customer, "c_name", "Customer#000000007").select(
        "c_custkey", "c_name", "c_mktsegment"
    )


@query
def scope_filter(spark, folder):
    shop = D.table(spark, folder, "customer").where("c_mktsegment = 'BUILDING'")
    scope = shop.select(F.col("c_custkey").alias("o_custkey"))
    return filters.in_scope(D.table(spark, folder, "orders"), scope, "o_custkey").select(
        "o_orderkey", "o_custkey", "o_orderstatus"
    )


# Flattening -------------------------------------------------------------------

def _good(spark, folder, kind):
    return P.valid_pages(D.parsed_pages(spark, folder, kind))


@query
def flatten_sales_header(spark, folder):
    docs = flatten.shipped_documents(_good(spark, folder, "sales"))
    return plain(flatten.sales_headers(docs).drop(*flatten.ORIGIN))


@query
def flatten_sales_detail(spark, folder):
    docs = flatten.shipped_documents(_good(spark, folder, "sales"))
    return plain(flatten.sales_lines(docs).drop(*flatten.ORIGIN))


@query
def flatten_purchase_detail(spark, folder):
    return plain(flatten.purchase_lines(_good(spark, folder, "purchase")).drop(*flatten.ORIGIN))


ALLOWED = ("wh-1", "wh-2", "wh-3", "wh-5", "wh-8")


@query
def flatten_sales_detail_allowed(spark, folder):
    docs = flatten.shipped_documents(_good(spark, folder, "sales"), ALLOWED)
    return plain(flatten.sales_lines(docs).drop(*flatten.ORIGIN))


@query
def flatten_purchase_detail_allowed(spark, folder):
    lines = flatten.purchase_lines(_good(spark, folder, "purchase"), ALLOWED)
    return plain(lines.drop(*flatten.ORIGIN))


@query
def flatten_orders(spark, folder):
    return plain(flatten.orders(_good(spark, folder, "order")).drop(*flatten.ORIGIN))


@query
def normalise_keys(spark, folder):
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return flatten.text_keys(D.table(spark, folder, "lineitem").select(*keys), keys)


@query
def json_parse_explode(spark, folder):
    docs = P.documents(D.parsed_pages(spark, folder, "sales"), P.SALES)
    lines = docs.select("stockout_id", "page_no", "place", F.explode("details_list").alias("line"))
    return doubles(
        lines.select(
            "stockout_id", "page_no", "place",
            F.col("line.rec_id").alias("rec_id"),
            F.col("line.spec_no").alias("spec_no"),
            F.col("line.goods_count").alias("goods_count"),
        ),
        "goods_count",
    )


@query
def positional_rename(spark, folder):
    region = D.table(spark, folder, "region")
    return tables.rename(region, ["warehouse_id", "warehouse_name"])


@query
def status_threshold(spark, folder):
    docs = P.documents(_good(spark, folder, "sales"), P.SALES).where(filters.shipped())
    return docs.select("stockout_id", "status")


# Filters ----------------------------------------------------------------------

@query
def date_window_filter(spark, folder):
    lines = D.table(spark, folder, "lineitem")
    found = lines.where(filters.day_range("l_shipdate", 19980301, "19980331"))
    return plain(found.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"))


@query
def in_list_filter(spark, folder):
    docs = D.sales_header(spark, folder)
    return docs.where(filters.one_of("status_CN", V.REPORT_STATUSES)).select(
        "stockout_id", "status_CN"
    )


@query
def not_in_filter(spark, folder):
    shops = D.table(spark, folder, "customer").select("c_custkey", D.shop_no().alias("shop_no"))
    return shops.where(filters.none_of("shop_no", [V.WHOLESALE_SHOP]))


@query
def like_filter(spark, folder):
    orders = D.table(spark, folder, "orders")
    return orders.where(filters.holds("o_orderpriority", "URGENT")).select(
        "o_orderkey", "o_orderpriority"
    )


# Joins ------------------------------------------------------------------------

@query
def left_join_preagg(spark, folder):
    lines = D.sales_detail(spark, folder).select(
        "detail_rec_id", "detail_spec_no", "detail_goods_count"
    )
    cost = A.cost_per_item(D.inventory(spark, folder))
    joined = joins.with_item_cost(lines, cost, "detail_spec_no")
    return doubles(joined, "detail_goods_count", "cost_price")


@query
def left_join_header(spark, folder):
    lines = D.sales_detail(spark, folder).select("detail_rec_id", "stockout_id", "sid")
    return joins.with_header(lines, D.sales_header(spark, folder), ["cs_remark"])


@query
def left_join_header_fanout(spark, folder):
    """Trades of high priority have a second header, which repeats their lines."""
    lines = D.sales_detail(spark, folder).select("detail_rec_id", "trade_no")
    headers = D.sales_header(spark, folder).select("trade_no", "cs_remark")
    second = headers.where("cs_remark = '2-HIGH'").withColumn("cs_remark", F.lit("second"))
    return joins.with_header(lines, headers.union(second), ["cs_remark"], fanout=True)


@query
def left_join_dim(spark, folder):
    lines = D.sales_detail(spark, folder).select("detail_rec_id", "detail_spec_no")
    products = D.products(spark, folder)
    return joins.with_product(lines, products, ["goods_name", "class_name"], "detail_spec_no")


@query
def join_rollups(spark, folder):
    inventory, products = D.inventory(spark, folder), D.products(spark, folder)
    lines = D.sales_detail(spark, folder)
    stock = A.rollup(
        joins.with_product(A.stock_per_item(inventory), products, ["class_name"]),
        "class_name",
        [F.sum("stock").alias("stock")],
    )
    sold = A.rollup(
        joins.with_product(R.per_item(lines), products, ["class_name"]),
        "class_name",
        [F.sum("units").alias("units")],
    )
    joined = stock.drop("is_total").join(sold.drop("is_total"), "label", "left")
    return doubles(joined, "stock", "units")


@query
def multiway_left_join(spark, folder):
    lines = R.per_item(D.sales_detail(spark, folder))
    stock = A.stock_per_item(D.inventory(spark, folder))
    joined = joins.with_product(
        lines.join(stock, "spec_no", "left"), D.products(spark, folder), ["goods_name"]
    )
    grouped = joined.groupBy("spec_no", "goods_name", "stock", "cost_price").agg(
        F.sum("units").alias("units"), F.sum("amount").alias("amount")
    )
    return doubles(grouped, "stock", "cost_price", "units", "amount")


def _order_sides(spark, folder):
    rows = D.orders(spark, folder)
    return D.stored(rows, "trade_time"), D.sent(rows, "trade_time", "paid")


@query
def anti_join_new(spark, folder):
    target, batch = _order_sides(spark, folder)
    return plain(U.unknown_rows(batch, target, S.ORDER_KEY))


@query
def semi_join_existing(spark, folder):
    target, batch = _order_sides(spark, folder)
    return plain(U.known_rows(batch, target, S.ORDER_KEY))


# Aggregates -------------------------------------------------------------------

@query
def grouped_sum(spark, folder):
    lines = D.sales_detail(spark, folder, ["status_CN"])
    return doubles(
        lines.groupBy("status_CN").agg(
            F.sum("detail_goods_count").alias("units"),
            F.sum("detail_total_amount").alias("amount"),
        ),
        "units", "amount",
    )


@query
def sum_product(spark, folder):
    items = R.per_item(D.sales_detail(spark, folder, ["status_CN"]), F.col("status_CN"))
    costed = joins.with_item_cost(items, A.cost_per_item(D.inventory(spark, folder)))
    product = F.col("units") * F.col("cost_price")
    defaulted = F.col("units") * F.coalesce("cost_price", F.lit(0).cast("decimal(18,2)"))
    return doubles(
        costed.groupBy("status_CN").agg(
            F.sum(product).alias("cost"), F.sum(defaulted).alias("cost_or_zero")
        ),
        "cost", "cost_or_zero",
    )


@query
def max_per_key(spark, folder):
    return doubles(A.cost_per_item(D.inventory(spark, folder)), "cost_price")


@query
def ratio_of_sums(spark, folder):
    lines = D.table(spark, folder, "lineitem")
    grouped = lines.groupBy("l_linenumber", "l_returnflag").agg(
        F.sum(A.money(F.col("l_quantity"))).alias("part"),
        F.sum(
            F.when(F.col("l_returnflag") != "R", A.money(F.col("l_extendedprice")))
            .otherwise(F.lit(0).cast("decimal(18,2)"))
        ).alias("whole"),
    )
    return grouped.select(
        "l_linenumber", "l_returnflag",
        F.round(F.try_divide(F.col("part").cast("double"), F.col("whole").cast("double")), 6)
        .alias("share"),
    )


@query
def rollup_case(spark, folder):
    lines = D.sales_detail(spark, folder, ["shop_no"])
    channel = classify.channel(F.col("shop_no")).alias("channel")
    rolled = A.rollup(
        R.per_item(lines, channel), "channel", [F.sum("units").alias("units")]
    )
    return doubles(rolled.drop("is_total"), "units")


@query
def rollup_plain(spark, folder):
    lines = D.sales_detail(spark, folder, ["shop_name"])
    rolled = A.rollup(lines, "shop_name", [F.sum("detail_goods_count").alias("units")])
    return doubles(rolled, "units")


@query
def rollup_pattern(spark, folder):
    lines = D.sales_detail(spark, folder, ["cs_remark"])
    kind = classify.remark_class(F.col("cs_remark"), "URGENT", "urgent")
    rolled = A.rollup(
        lines.withColumn("kind", kind), "kind", [F.sum("detail_total_amount").alias("amount")]
    )
    return doubles(rolled.drop("is_total"), "amount")


@query
def rollup_null_bucket(spark, folder):
    items = joins.with_product(
        R.per_item(D.sales_detail(spark, folder)), D.products(spark, folder), ["class_name"]
    )
    rolled = A.rollup(items, "class_name", [F.sum("amount").alias("amount")])
    return doubles(rolled.drop("is_total"), "amount")


@query
def distinct_dates(spark, folder):
    return plain(A.distinct_days(D.table(spark, folder, "lineitem"), "l_shipdate"))


@query
def conditional_sum(spark, folder):
    amount, zero = A.money(F.col("l_extendedprice")), F.lit(0).cast("decimal(18,2)")
    lines = D.table(spark, folder, "lineitem")
    sums = [
        F.sum(F.when(F.col("l_returnflag") == flag, amount).otherwise(zero)).alias(f"amount_{flag}")
        for flag in "ANR"
    ]
    return doubles(
        lines.groupBy("l_linenumber").agg(*sums), "amount_A", "amount_N", "amount_R"
    )


def _daily(spark, folder):
    return (
        D.purchases(spark, folder), ["detail_goods_no"], "stockin_time",
        "detail_total_cost", "detail_goods_count",
    )


@query
def pivot_daily(spark, folder):
    """All years in blocks of days."""
    purchases, *shape = _daily(spark, folder)
    path = scratch_path(spark, "daily")
    A.daily_totals(R.completed_receipts(purchases, WHOLE), *shape).write.parquet(path)
    long = spark.read.parquet(path)
    days = A.numbered_days(long.select("day").distinct(), 31)
    wide = A.blocked_pivot(long, shape[0], days)
    return doubles(wide, *wide.columns[2:])


@query
def pivot_daily_month(spark, folder):
    purchases, *shape = _daily(spark, folder)
    found = R.completed_receipts(purchases, MONTH)
    days = [MONTH.long_start + dt.timedelta(days=i) for i in range(31)]
    wide = A.daily_pivot(found, *shape, days)
    return doubles(wide, *wide.columns[1:])


@query
def pivot_daily_long(spark, folder):
    return plain(A.daily_totals(*_daily(spark, folder)))


def _item_sums(spark, folder):
    return D.purchases(spark, folder).groupBy("detail_goods_no").agg(
        F.sum("detail_total_cost").alias("amount"),
        F.sum("detail_goods_count").alias("units"),
        F.max("detail_tax").cast("string").alias("rate"),
        F.concat(F.lit("n"), F.count(F.lit(1))).alias("note"),
    )


@query
def total_row_first(spark, folder):
    table = A.with_total(_item_sums(spark, folder), ["detail_goods_no"])
    ordered = table.orderBy(F.desc("is_total"), "detail_goods_no")
    return doubles(ordered, "amount", "units").withColumn("rate", F.round("rate", 2))


@query
def union_total(spark, folder):
    rows = R.per_item(D.sales_detail(spark, folder))
    total = rows.agg(F.sum("units").alias("units"), F.sum("amount").alias("amount"))
    named = total.select(F.lit(V.TOTAL_LABEL).alias("spec_no"), "units", "amount")
    return doubles(named.unionByName(rows), "units", "amount")


@query
def hourly_counts(spark, folder):
    return plain(A.slot_counts(D.events(spark, folder), "ts"))


@query
def latest_per_key(spark, folder):
    keys = ["l_orderkey", "l_linenumber"]
    newest = [F.desc("l_shipdate"), F.asc("l_partkey"), F.asc("l_suppkey")]
    return plain(U.latest_per_key(D.table(spark, folder, "lineitem"), keys, newest))


@query
def sort_desc(spark, folder):
    items = R.per_item(D.sales_detail(spark, folder))
    return doubles(items, "units", "amount").orderBy(F.desc("amount"), "spec_no")


# Scalars ----------------------------------------------------------------------

@query
def date_formats(spark, folder):
    ts = F.col("ts")
    return D.events(spark, folder).select(
        "event_id",
        text.compact_day(ts).alias("compact"),
        text.dashed_day(ts).alias("dashed"),
        text.second_stamp(ts).alias("second"),
        text.dashed_day(F.date_sub(F.to_date(ts), V.SHORT_WINDOW_DAYS)).alias("week_before"),
    )


@query
def extract_order_ref(spark, folder):
    marked = F.concat(
        F.when(F.col("o_orderpriority").contains("URGENT"), V.ORDER_REF_PHRASE).otherwise("-"),
        F.lit(" "),
        F.when(F.col("o_orderstatus") != "P", V.ORDER_REF_MARKER).otherwise("?"),
        F.lit(":"),
        F.col("o_orderkey"),
        F.lit(" x"),
    )
    return D.table(spark, folder, "orders").select("o_orderkey", text.order_ref(marked).alias("ref"))


@query
def coerce_numeric(spark, folder):
    raw = F.when(F.col("l_returnflag") == "A", F.concat(F.lit("q"), "l_linenumber")).otherwise(
        F.col("l_linenumber").cast("string")
    )
    return D.table(spark, folder, "lineitem").select(
        D.line_key().alias("key"), text.to_number(raw).alias("number")
    )


@query
def format_report_number(spark, folder):
    value = F.when(F.col("l_returnflag") == "A", F.lit(None)).otherwise(
        F.col("l_extendedprice") * F.when(F.col("l_discount") == 0, 0).otherwise(1)
    )
    exact = A.money(F.col("l_quantity") * F.col("l_linenumber")) / F.lit(2).cast("decimal(18,2)")
    return D.table(spark, folder, "lineitem").select(
        D.line_key().alias("key"),
        text.report_number(value, is_float=True).alias("amount"),
        text.report_number(exact.cast("decimal(18,1)")).alias("half"),
    )


@query
def map_label_default(spark, folder):
    names = {"AUTOMOBILE": "car shop", "BUILDING": "house shop"}
    return D.table(spark, folder, "customer").select(
        "c_custkey", decode.relabel(F.col("c_mktsegment"), names).alias("shop")
    )


def _decoded(spark, folder, codes: dict[str, str], label) -> DataFrame:
    """Codes spread over the lines, with one no table knows and one NULL."""
    raw = F.try_element_at(
        decode.literal_map(codes), F.concat("l_returnflag", "l_linenumber")
    )
    coded = D.table(spark, folder, "lineitem").select(raw.alias("code"))
    return coded.groupBy("code", label(F.col("code")).alias("label")).agg(
        F.count(F.lit(1)).alias("n")
    )


def spread(codes: list[str]) -> dict[str, str]:
    places = [f"{flag}{line}" for flag in "ANR" for line in range(1, 8)]
    return dict(zip(places, [*codes, "999"]))


@query
def decode_status(spark, folder):
    return _decoded(spark, folder, spread(list(V.SHIPMENT_STATUS)), decode.shipment_status)


@query
def decode_trade_status(spark, folder):
    codes = spread(list(V.SHIPMENT_TRADE_STATUS))
    return _decoded(spark, folder, codes, decode.shipment_trade_status)


@query
def decode_trade_type(spark, folder):
    return _decoded(spark, folder, spread(list(V.TRADE_TYPE)), decode.trade_type)


@query
def decode_order_origin(spark, folder):
    return _decoded(spark, folder, spread(list(V.ORDER_ORIGIN)), decode.order_origin)


@query
def decode_platform(spark, folder):
    return _decoded(spark, folder, spread(list(V.PLATFORM)), decode.platform)


@query
def decode_order_status(spark, folder):
    return _decoded(spark, folder, spread(list(V.ORDER_STATUS)), decode.order_status)


@query
def default_rate(spark, folder):
    return doubles(D.purchases(spark, folder).select("detail_rec_id", "detail_tax"), "detail_tax")


@query
def classify_channel(spark, folder):
    return D.table(spark, folder, "customer").select(
        "c_custkey", classify.channel(D.shop_no()).alias("channel")
    )


@query
def classify_remark(spark, folder):
    kind = classify.remark_class(F.col("o_orderpriority"), "URGENT", "urgent")
    return D.table(spark, folder, "orders").select("o_orderkey", kind.alias("kind"))


@query
def missing_unit_report(spark, folder):
    return R.missing_units(D.products(spark, folder))


# Changing tables --------------------------------------------------------------

@query
def append_new(spark, folder):
    rows = D.purchases(spark, folder)
    target = D.stored(rows, "stockin_time")
    batch = D.sent(rows, "stockin_time", "detail_total_cost")
    return plain(U.append_new(target, batch, S.PURCHASE_KEY))


def _detail_sides(spark, folder):
    lines = D.table(spark, folder, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("detail_rec_id"),
        F.lit(D.SID).alias("sid"),
        F.col("l_partkey").cast("string").alias("detail_spec_no"),
        A.money(F.col("l_quantity")).alias("detail_goods_count"),
        A.money(F.col("l_extendedprice")).alias("detail_total_amount"),
        F.col("l_suppkey").alias("place"),
        F.col("l_shipdate").alias("modified"),
    )
    newest = [F.desc("modified"), F.asc("detail_spec_no"), F.desc("place")]
    target = U.latest_per_key(D.stored(lines, "modified"), S.SALES_DETAIL_KEY, newest)
    return target, D.sent(lines, "modified", "detail_total_amount"), newest


@query
def upsert_detail(spark, folder):
    target, batch, newest = _detail_sides(spark, folder)
    return plain(U.upsert(target, batch, S.SALES_DETAIL_KEY, newest))


@query
def upsert_header(spark, folder):
    rows = D.sales_header(spark, folder)
    target, batch = D.stored(rows, "modified"), D.sent(rows, "modified", "receivable")
    return plain(U.upsert(target, batch, S.SALES_HEADER_KEY, [F.desc("modified")]))


@query
def upsert_orders(spark, folder):
    target, batch = _order_sides(spark, folder)
    return plain(U.upsert(target, batch, S.ORDER_KEY, [F.desc("modified")]))


@query
def insert_ignore(spark, folder):
    target, batch, newest = _detail_sides(spark, folder)
    oldest = [F.asc("modified"), F.asc("detail_spec_no"), F.asc("place")]
    return plain(U.insert_ignore(target, batch, S.SALES_DETAIL_KEY, oldest))


@query
def upsert_actions(spark, folder):
    target, batch = _order_sides(spark, folder)
    actions = U.upsert_actions(target, batch, S.ORDER_KEY)
    return actions.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


# Streams ----------------------------------------------------------------------

@query
def stream_upsert(spark, folder):
    base = scratch_path(spark, "stream-upsert")
    target, _ = _order_sides(spark, folder)
    U.write_partitions(target, f"{base}/table", "trade_month")
    stream = jobs.stream_table(spark, folder, "orders.parquet")
    # Of equally old copies the dearer one, which is the one sent, counts.
    jobs.upsert_stream(
        stream, f"{base}/table", f"{base}/checkpoint", S.ORDER_KEY,
        lambda: [F.desc("modified"), F.desc("paid")], "trade_month",
        lambda batch: D.sent(D.order_rows(batch), "trade_time", "paid"),
    )
    return plain(spark.read.schema(target.schema).parquet(f"{base}/table"))


@query
def stream_dedupe(spark, folder):
    """All events land twice, in files of several batches."""
    base = scratch_path(spark, "stream-dedupe")
    events = D.events(spark, folder)
    for _ in range(2):
        events.repartition(3, "event_id").write.mode("append").parquet(f"{base}/landed")
    jobs.dedupe_stream(
        jobs.stream_table(spark, f"{base}/landed", files_per_batch=2),
        f"{base}/table", f"{base}/checkpoint", ["event_id"], lambda: [F.desc("ts")],
    )
    return plain(spark.read.parquet(f"{base}/table").drop("load"))


# Loads ------------------------------------------------------------------------

def _day_later(days: int) -> str:
    return f"date_format(o_orderdate + interval '{days}' day, '{D.STAMP}')"


@query
def load_orders_pages(spark, folder):
    """Finished orders land in a newer state first, then all as they were, then
    open ones in an older state; refused pages are set aside."""
    base = scratch_path(spark, "load-orders")
    newer = {"trade_status": "'newer'", "modified": _day_later(1)}
    older = {"trade_status": "'older'", "modified": _day_later(-1)}
    files = D.landing_files(spark, folder)
    for pages in (
        D.order_pages(spark, folder, "o_orderstatus = 'F'", newer, files),
        D.order_pages(spark, folder, files=files),
        D.order_pages(spark, folder, "o_orderstatus = 'O'", older, files),
    ):
        D.land(pages, f"{base}/pages")

    def load(session, pages, name):
        loads.load_orders(session, pages, f"{base}/table", f"{base}/rejects/load={name}")

    loads.load_landed(spark, f"{base}/pages", P.ORDER, f"{base}/checkpoint", load, files_per_batch=files)
    return plain(spark.read.parquet(f"{base}/table").drop(*flatten.ORIGIN, S.TRADE_MONTH))


LOOKBACK_FROM, LOOKBACK_DAYS = dt.datetime(1998, 3, 8, 12), 365


@query
def load_orders_lookback(spark, folder):
    """All orders have landed by the last day of their window; a year before a day is loaded."""
    base = scratch_path(spark, "load-lookback")
    pages = D.order_pages(spark, folder).withColumn(P.DAY_FOLDER, F.substring(F.get_json_object("body", "$.end_time"), 1, 4))
    whole = F.concat(F.col(P.DAY_FOLDER), F.lit("-12-31"))
    # A folder per year keeps the test small; it is named by its last day.
    landed = pages.withColumn(P.DAY_FOLDER, whole).hint("rebalance", P.DAY_FOLDER)
    D.land(landed, f"{base}/pages", P.DAY_FOLDER)
    found = P.chosen_pages(P.read_pages(spark, f"{base}/pages", P.ORDER, by_day=True), LOOKBACK_FROM, LOOKBACK_DAYS, [D.SID])
    loads.load_orders(spark, found, f"{base}/table", f"{base}/rejects")
    return plain(spark.read.parquet(f"{base}/table").drop(*flatten.ORIGIN, S.TRADE_MONTH))


@query
def load_orders_changes(spark, folder):
    """What three loads of orders did: finished ones, all with finished ones in a newer
    state, and all again."""
    base = scratch_path(spark, "load-changes")
    newer = {"trade_status": "'newer'", "modified": _day_later(1)}
    for number, pages in enumerate((
        D.order_pages(spark, folder, "o_orderstatus = 'F'"),
        D.order_pages(spark, folder, "o_orderstatus = 'F'", newer).union(
            D.order_pages(spark, folder, "o_orderstatus <> 'F'")
        ),
        D.order_pages(spark, folder),
    )):
        parsed = P.parse_pages(pages, "body", P.ORDER)
        loads.load_orders(spark, parsed, f"{base}/table", f"{base}/rejects/{number}", load=f"load-{number}")
    changes = U.table_changes(spark, f"{base}/table")
    return changes.groupBy("load", "action").agg(F.count(F.lit(1)).alias("n"))


@query
def stream_completeness(spark, folder):
    """Pages of orders land in three steps, and marks are kept; older ones land again."""
    base = scratch_path(spark, "stream-completeness")
    files = D.landing_files(spark, folder)
    for only in ("o_orderstatus = 'F'", "o_orderstatus <> 'F'", "o_orderkey % 5 = 0"):
        D.land(D.order_pages(spark, folder, only, files=files), f"{base}/pages")
    stream = P.stream_pages(spark, f"{base}/pages", P.ORDER, files_per_batch=files // 2)
    jobs.completeness_stream(stream, P.ORDER, f"{base}/marks", f"{base}/checkpoint", compact_every=2)
    return plain(jobs.known_completeness(spark, f"{base}/marks", P.ORDER))


@query
def load_purchases_pages(spark, folder):
    """Receipts land, are loaded, and land again with other lines; many do so in steps.
    Their files go when they have been loaded."""
    base = scratch_path(spark, "load-purchases")

    def load(session, pages, name):
        loads.load_purchases(session, pages, f"{base}/table", name, None, f"{base}/rejects/load={name}")

    for again in (False, True):
        for part in D.landing_steps(spark, folder):
            D.land(D.purchase_pages(spark, folder, again, part), f"{base}/pages")
            loads.load_landed(spark, f"{base}/pages", P.PURCHASE, f"{base}/checkpoint", load, clean=True)
    return plain(spark.read.parquet(f"{base}/table").drop(*flatten.ORIGIN, S.STOCKIN_MONTH, "load"))


@query
def stream_hourly_counts(spark, folder):
    base = scratch_path(spark, "stream-counts")
    events = jobs.stream_table(spark, folder, "events.parquet")
    jobs.slot_count_stream(events, "ts", f"{base}/table", f"{base}/checkpoint")
    return plain(jobs.current_slots(spark, f"{base}/table"))


# Landings of events by time, and of those among them that come late.
LANDINGS = 5
LANDING_DAYS = 6
LANDING = (
    f"least({LANDINGS - 1}, cast(floor((day(ts) - 1) / {LANDING_DAYS}) as int) "
    "+ CASE WHEN event_id % 11 = 0 THEN 3 WHEN event_id % 7 = 0 THEN 1 ELSE 0 END)"
)


def _land(events: DataFrame, folder: str) -> None:
    """Two files: what a batch of two takes."""
    events.repartition(2).write.mode("append").parquet(folder)


def _late_counts(spark, folder) -> tuple[str, DataFrame]:
    """Events land in order of time, some of them one or three landings late."""
    base = scratch_path(spark, "stream-late")
    events = D.events(spark, folder).withColumn("landing", F.expr(LANDING))
    for landing in range(LANDINGS):
        _land(events.where(F.col("landing") == landing).drop("landing"), f"{base}/landed")
    stream = jobs.stream_table(spark, f"{base}/landed", files_per_batch=2)
    jobs.slot_count_stream(stream, "ts", f"{base}/table", f"{base}/checkpoint", delay=jobs.WATERMARK)
    return f"{base}/table", events.drop("landing")


@query
def stream_late_slots(spark, folder):
    """Hourly counts without the rows that come after their hour is closed."""
    table, _ = _late_counts(spark, folder)
    return plain(jobs.current_slots(spark, table))


@query
def stream_late_rows(spark, folder):
    """The rows that come after their hour is closed."""
    table, events = _late_counts(spark, folder)
    return plain(jobs.late_rows(spark, table, events.schema))


@query
def stream_counts_compacted(spark, folder):
    """All events in nine batches, whose folders are put into one after every fourth."""
    base = scratch_path(spark, "stream-compacted")
    D.events(spark, folder).repartition(9).write.parquet(f"{base}/landed")
    stream = jobs.stream_table(spark, f"{base}/landed", files_per_batch=1)
    jobs.slot_count_stream(stream, "ts", f"{base}/table", f"{base}/checkpoint", compact_every=4)
    return plain(jobs.current_slots(spark, f"{base}/table"))


@query
def stream_dedupe_window(spark, folder):
    """Events land in order of time. A fifth land again with the next landing, an hour
    younger, and go; a seventh of the first landing come back three landings later with
    a time of then, when their keys are forgotten, and enter again."""
    base = scratch_path(spark, "stream-window")
    span = f"INTERVAL {LANDING_DAYS} DAYS"
    landing = F.expr(f"cast(floor((day(ts) - 1) / {LANDING_DAYS}) as int)")
    events = D.events(spark, folder).withColumn("landing", landing)
    soon = events.where("event_id % 5 = 0").withColumns(
        {"landing": F.col("landing") + 1, "ts": F.expr("ts + INTERVAL 1 HOUR")}
    )
    back = events.where("landing = 0 AND event_id % 7 = 0").withColumns(
        {"landing": F.lit(3), "ts": F.expr(f"ts + 3 * {span}")}
    )
    sent = events.unionByName(soon).unionByName(back)
    for number in range(LANDINGS + 1):
        _land(sent.where(F.col("landing") == number).drop("landing"), f"{base}/landed")
    stream = jobs.stream_table(spark, f"{base}/landed", files_per_batch=2)
    jobs.dedupe_in_window_stream(stream, f"{base}/table", f"{base}/checkpoint", ["event_id"], "ts")
    return plain(spark.read.parquet(f"{base}/table").drop("batch_id"))


# Reports ----------------------------------------------------------------------

def _lines(spark, folder, p, *columns):
    return R.in_window(D.sales_detail(spark, folder, ["status_CN", *columns]), p)


def _channel(p):
    def run(spark, folder):
        lines = _lines(spark, folder, p, "shop_no", "warehouse_name")
        return R.channel_summary(lines, D.inventory(spark, folder), p)
    return run


def _online(p):
    def run(spark, folder):
        return R.online_summary(
            _lines(spark, folder, p, *DETAIL_COLUMNS), D.inventory(spark, folder), p
        )
    return run


def _offline(p):
    def run(spark, folder):
        lines = D.sales_detail(spark, folder, ["status_CN", "shop_no"]).drop("cs_remark")
        headers = D.sales_header(spark, folder)
        return bundle.offline_report(spark, lines, headers, D.inventory(spark, folder), p)
    return run


def _inventory(p):
    def run(spark, folder):
        return R.inventory_summary(
            _lines(spark, folder, p), D.inventory(spark, folder), D.products(spark, folder), p
        )
    return run


def _sku(p, shops):
    def run(spark, folder):
        return R.sku_detail(
            _lines(spark, folder, p, "shop_no"),
            D.inventory(spark, folder), D.products(spark, folder), shops, p,
        )
    return run


for _suffix, _p in (("", WHOLE), ("_week", WEEK)):
    QUERIES["report_channel_summary" + _suffix] = _channel(_p)
    QUERIES["report_online" + _suffix] = _online(_p)
    QUERIES["report_offline" + _suffix] = _offline(_p)
    QUERIES["report_inventory" + _suffix] = _inventory(_p)
    QUERIES["report_sku_online" + _suffix] = _sku(_p, _p.online_shops)
    QUERIES["report_sku_offline" + _suffix] = _sku(_p, _p.offline_shops)


@query
def report_purchases(spark, folder):
    """All years in blocks of days."""
    return R.purchase_blocks(bundle.shared_receipts(spark, D.purchases(spark, folder), WHOLE), WHOLE)


@query
def report_purchases_month(spark, folder):
    return R.purchase_detail(D.purchases(spark, folder), MONTH)


@query
def empty_placeholder(spark, folder):
    """The message of a section that is empty and of one that is not."""
    lines = D.purchases(spark, folder)
    none = lines.where(filters.one_of("status_CN", ["no such status"]))
    message = bundle.empty_message(MONTH)
    return R.or_message(none, message).unionByName(R.or_message(lines, "not shown"))


def _tables(spark, folder):
    return bundle.Tables(
        detail=D.sales_detail(spark, folder, DETAIL_COLUMNS).drop("cs_remark"),
        headers=D.sales_header(spark, folder),
        inventory=D.inventory(spark, folder),
        products=D.products(spark, folder),
        purchases=D.purchases(spark, folder),
    )


@query
def report_bundle(spark, folder):
    t = _tables(spark, folder)
    parts = [*bundle.sections(spark, t, WHOLE), bundle.purchase_days_section(t, WHOLE)]
    return bundle.stacked(parts)


def _sections(p):
    def run(spark, folder):
        """What has been written of each section: its title and its rows."""
        out = scratch_path(spark, "report")
        written = bundle.write_report(spark, _tables(spark, folder), p, out)
        return bundle.written_sections(spark, written)
    return run


QUERIES["report_sections"] = _sections(WHOLE)
QUERIES["report_sections_month"] = _sections(MONTH)
