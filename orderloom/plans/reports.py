"""The reports.

Every report sums its lines per item before it joins anything. What then is
joined and rolled up grows with the number of items, not with the lines.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom import fixed_values as V
from orderloom import schemas as S
from orderloom.functions import classify, decode
from orderloom.operators import aggregates as A
from orderloom.operators import filters, joins
from orderloom.plans.params import ReportParams

ITEM = "detail_spec_no"
UNITS = "detail_goods_count"
AMOUNT = "detail_total_amount"

SUMMARY_COLUMNS = ("label", "units", "revenue", "cost", "cost_ratio", "profit")
INVENTORY_COLUMNS = ("label", "stock", "stock_cost", "units", "revenue")
SKU_COLUMNS = ("spec_no", "goods_name", "units", "revenue", "cost", "stock")


def in_window(detail: DataFrame, p: ReportParams) -> DataFrame:
    """Shipped lines of the short window: what all sales reports start from."""
    found = filters.days_of(detail, "consign_time", p.start, p.end, S.CONSIGN_MONTH)
    return found.where(filters.one_of("status_CN", p.statuses))


GROUPS = ("shop_no", "shop_name", "warehouse_name", "trade_type_name")


def window_items(detail: DataFrame, p: ReportParams) -> DataFrame:
    """The window summed per item and everything the reports group or filter by.

    The result has the line columns still and can stand in for the lines of
    the window: the large table is then read once for all reports.
    """
    return in_window(detail, p).groupBy(*GROUPS, ITEM).agg(
        F.sum(UNITS).alias(UNITS), F.sum(AMOUNT).alias(AMOUNT)
    )


def per_item(lines: DataFrame, *groups: Column) -> DataFrame:
    """Units and amount per item, within the given groups."""
    return lines.groupBy(*groups, F.col(ITEM).alias("spec_no")).agg(
        F.sum(UNITS).alias("units"), F.sum(AMOUNT).alias("amount")
    )


def cost_summary(items: DataFrame, inventory: DataFrame, group: str) -> DataFrame:
    """Units, revenue, cost, ratio and profit per group and in total.

    Items without a cost add to units and revenue but not to cost, so the
    profit counts their revenue in full.
    """
    costed = joins.with_item_cost(items, joins.never_sent(A.cost_per_item(inventory)))
    rolled = A.rollup(
        costed,
        group,
        [
            F.sum("units").alias("units"),
            F.sum("amount").alias("amount"),
            F.sum(F.col("units") * F.col("cost_price")).alias("cost"),
        ],
    )
    amount, cost = F.col("amount"), F.col("cost")
    return rolled.select(
        "label",
        F.col("units").cast("double").alias("units"),
        A.rounded(amount).alias("revenue"),
        A.rounded(cost).alias("cost"),
        A.ratio(cost, amount).alias("cost_ratio"),
        A.rounded(amount - cost).alias("profit"),
        "is_total",
    )


def _by_units(summary: DataFrame, columns: Sequence[str]) -> DataFrame:
    return summary.orderBy(F.asc(columns[1]), "is_total", "label").select(*columns)


def channel_summary(lines: DataFrame, inventory: DataFrame, p: ReportParams) -> DataFrame:
    """Online against wholesale."""
    chosen = lines.where(filters.one_of("warehouse_name", p.warehouses))
    channel = classify.channel(F.col("shop_no"), p.wholesale_shop).alias("channel")
    summary = cost_summary(per_item(chosen, channel), inventory, "channel")
    return _by_units(summary, SUMMARY_COLUMNS)


def online_summary(lines: DataFrame, inventory: DataFrame, p: ReportParams) -> DataFrame:
    """Each online shop; shop names are shortened after they have been grouped."""
    chosen = lines.where(
        filters.one_of("warehouse_name", p.warehouses)
        & filters.one_of("trade_type_name", p.trade_types)
        & filters.none_of("shop_no", [p.wholesale_shop])
    )
    summary = cost_summary(per_item(chosen, F.col("shop_name")), inventory, "shop_name")
    shown = summary.withColumn("label", decode.relabel(F.col("label"), p.store_names))
    return _by_units(shown, SUMMARY_COLUMNS)


def offline_lines(lines: DataFrame, p: ReportParams) -> DataFrame:
    """What the offline report needs of the lines of the wholesale shop."""
    chosen = lines.where(filters.one_of("shop_no", [p.wholesale_shop]))
    return chosen.select("shop_no", "stockout_id", "sid", "trade_no", ITEM, UNITS, AMOUNT)


def offline_summary(
    lines: DataFrame,
    headers: DataFrame,
    inventory: DataFrame,
    p: ReportParams,
    fanout: bool = False,
    span: joins.Span | None = None,
) -> DataFrame:
    """The wholesale shop, split by what the service remark says.

    Needs real lines, as the remark is found by document. Only headers whose
    remark holds the phrase are joined: that filter reaches their scan, and a
    line that meets none belongs to the other class. With ``fanout`` every
    header of a trade counts, so all of them are joined. ``span`` is that of the
    lines' documents (their trades, with ``fanout``): headers out of it aren't read.
    """
    needed = offline_lines(lines, p).drop("shop_no")
    if not fanout:
        headers = headers.where(filters.holds("cs_remark", p.remark_phrase))
    if span is not None:
        headers = headers.where(span.holds("trade_no" if fanout else "stockout_id"))
    remarked = joins.with_header(needed, headers, ["cs_remark"], fanout)
    kind = classify.remark_class(F.col("cs_remark"), p.remark_phrase, p.remark_label)
    summary = cost_summary(per_item(remarked, kind.alias("kind")), inventory, "kind")
    return _by_units(summary, SUMMARY_COLUMNS)


def stock_by_class(inventory: DataFrame, products: DataFrame, p: ReportParams) -> DataFrame:
    """Stock and its cost per product class and in total."""
    stock = (
        inventory.where(filters.one_of("warehouse_name", p.warehouses))
        .groupBy("spec_no")
        .agg(
            F.sum("stock_num").alias("stock"),
            F.sum(F.col("stock_num") * F.col("cost_price")).alias("stock_cost"),
        )
    )
    classed = joins.with_product(stock, joins.never_sent(products), ["class_name"])
    return classed.rollup("class_name").agg(
        F.grouping("class_name").alias("is_total"),
        F.sum("stock").alias("stock"),
        F.sum("stock_cost").alias("stock_cost"),
    )


def sales_by_class(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Sales of all warehouses per product class and in total."""
    sold = joins.with_product(per_item(lines), joins.never_sent(products), ["class_name"])
    return sold.rollup("class_name").agg(
        F.grouping("class_name").alias("is_total"),
        F.sum("units").alias("units"),
        F.sum("amount").alias("amount"),
    )


def inventory_summary(
    lines: DataFrame, inventory: DataFrame, products: DataFrame, p: ReportParams
) -> DataFrame:
    """Stock against sales; classes that are only sold do not show.

    Totals meet totals and unknown meets unknown: the join compares the
    grouping flag and the class itself, NULL included, not the labels.
    """
    stock = stock_by_class(inventory, products, p)
    sales = sales_by_class(lines, products).select(
        F.col("class_name").alias("sold_class"),
        F.col("is_total").alias("sold_total"),
        "units",
        "amount",
    )
    same = (F.col("is_total") == F.col("sold_total")) & F.col("class_name").eqNullSafe(
        F.col("sold_class")
    )
    label = F.when(F.col("is_total") == 1, V.TOTAL_LABEL).otherwise(
        F.coalesce("class_name", F.lit(V.UNKNOWN_LABEL))
    )
    joined = stock.join(sales, same, "left").select(
        label.alias("label"),
        F.col("stock").cast("double").alias("stock"),
        A.rounded(F.col("stock_cost")).alias("stock_cost"),
        A.rounded(F.col("units")).alias("units"),
        A.rounded(F.col("amount")).alias("revenue"),
        (F.col("is_total") == 1).alias("is_total"),
    )
    return _by_units(joined, INVENTORY_COLUMNS)


def sku_rows(
    lines: DataFrame,
    inventory: DataFrame,
    products: DataFrame,
    shops: Sequence[str],
    p: ReportParams,
) -> DataFrame:
    """Sales, cost and stock per item and product name, as decimals.

    Stock and cost are those of the given warehouses; a missing one counts 0.
    """
    chosen = lines.where(filters.one_of("shop_no", shops))
    stock = A.stock_per_item(
        inventory.where(filters.one_of("warehouse_name", p.warehouses))
    )
    zero = F.lit(0).cast("decimal(18,2)")
    stocked = per_item(chosen).join(joins.never_sent(stock), "spec_no", "left")
    joined = joins.with_product(stocked, joins.never_sent(products), ["goods_name"])
    return joined.groupBy("spec_no", "goods_name", "stock", "cost_price").agg(
        F.sum("units").alias("units"),
        F.round(F.sum("amount"), 2).alias("revenue"),
        F.round(F.sum(F.col("units") * F.coalesce("cost_price", zero)), 2).alias("cost"),
    ).select(
        "spec_no", "goods_name", "units", "revenue", "cost",
        F.coalesce("stock", zero).alias("stock"),
    )


def as_doubles(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    return table.withColumns({c: F.col(c).cast("double") for c in columns})


def sku_detail(
    lines: DataFrame,
    inventory: DataFrame,
    products: DataFrame,
    shops: Sequence[str],
    p: ReportParams,
) -> DataFrame:
    """Items by falling revenue below one total row."""
    rows = sku_rows(lines, inventory, products, shops, p)
    table = A.with_total(rows, ["spec_no", "goods_name"])
    ordered = table.orderBy(F.desc("is_total"), F.desc("revenue"), "spec_no", "goods_name")
    return as_doubles(ordered, SKU_COLUMNS[2:]).select(*SKU_COLUMNS)


def receipts(purchases: DataFrame, p: ReportParams, statuses: Sequence[str]) -> DataFrame:
    """Receipt lines of the long window."""
    found = filters.days_of(purchases, "stockin_time", p.long_start, p.end, S.STOCKIN_MONTH)
    return found.where(filters.one_of("status_CN", statuses))


def receipt_days(purchases: DataFrame, p: ReportParams) -> list[dt.date]:
    """Days of the long window with a receipt: at most one value per day of it."""
    days = A.distinct_days(receipts(purchases, p, p.statuses), "stockin_time")
    return [row.day for row in days.orderBy("day").collect()]


def completed_receipts(purchases: DataFrame, p: ReportParams) -> DataFrame:
    return receipts(purchases, p, [V.RECEIPT_DONE_LABEL])


PURCHASE_KEYS = ("detail_goods_no", "detail_goods_name")


def receipt_sums(purchases: DataFrame, p: ReportParams) -> DataFrame:
    """Receipts of the long window summed by status, item and day, under the names
    of the stored table: what the purchase section asks for, in one scan."""
    day = F.to_date("stockin_time").cast("timestamp_ntz").alias("stockin_time")
    sums = [F.sum(c).alias(c) for c in ("detail_total_cost", "detail_goods_count")]
    return receipts(purchases, p, p.statuses).groupBy("status_CN", *PURCHASE_KEYS, day).agg(*sums)


def purchase_detail(
    purchases: DataFrame,
    p: ReportParams,
    amount_name: str = "{day}_amount",
    count_name: str = "{day}_count",
) -> DataFrame:
    """Amount and count per item and day of the long window, total on top."""
    wide = A.daily_pivot(
        completed_receipts(purchases, p),
        PURCHASE_KEYS,
        "stockin_time",
        "detail_total_cost",
        "detail_goods_count",
        receipt_days(purchases, p),
        amount_name,
        count_name,
        total=V.TOTAL_LABEL,
    )
    ordered = wide.orderBy(F.desc("is_total"), *PURCHASE_KEYS).drop("is_total")
    return as_doubles(ordered, ordered.columns[2:])


def block_days(purchases: DataFrame, p: ReportParams) -> DataFrame:
    """Days of the long window with a receipt, numbered by block and place."""
    return A.numbered_days(A.distinct_days(receipts(purchases, p, p.statuses), "stockin_time"), V.LONG_WINDOW_DAYS + 1)


def purchase_blocks(
    purchases: DataFrame,
    p: ReportParams,
    amount_name: str = "amount_{place}",
    count_name: str = "count_{place}",
) -> DataFrame:
    """Amount and count per item and day for windows too long for a column a day:
    blocks of days below each other, total on top of each."""
    ordered = A.blocked_pivot(
        purchase_days(purchases, p), PURCHASE_KEYS, block_days(purchases, p), amount_name, count_name, V.TOTAL_LABEL,
        order=["block", F.desc("is_total"), *PURCHASE_KEYS],
    ).drop("is_total")
    return as_doubles(ordered, ordered.columns[3:])


def purchase_days(purchases: DataFrame, p: ReportParams) -> DataFrame:
    """The same numbers in long form."""
    return A.daily_totals(
        completed_receipts(purchases, p),
        PURCHASE_KEYS,
        "stockin_time",
        "detail_total_cost",
        "detail_goods_count",
    )


def or_message(section: DataFrame, message: str) -> DataFrame:
    """A text section: one message row where the given section is empty."""
    found = section.limit(1).agg(F.count(F.lit(1)).alias("n"))
    return found.where("n = 0").select(F.lit(message).alias("message"))


def missing_units(products: DataFrame) -> DataFrame:
    """A report line for each product without a unit, one row per line.

    The lines stay rows: joined into one text they would all have to pass
    through a single task. Written as text, sorted, they give that text.
    """
    lacking = products.where(F.coalesce(F.trim("unit"), F.lit("")) == "")
    line = F.format_string(V.MISSING_UNIT_LINE, "sid", "spec_no")
    return lacking.select("sid", "spec_no", line.alias("line")).orderBy("sid", "spec_no")
