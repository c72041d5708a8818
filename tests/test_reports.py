"""Reports on literal rows, against sums made line by line in Python."""

import datetime as dt
import io
import random
from collections import defaultdict
from contextlib import redirect_stdout
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderloom import fixed_values as V
from orderloom import schemas as S
from orderloom.operators import upsert as U
from orderloom.plans import bundle, loads
from orderloom.plans import reports as R
from orderloom.plans.params import ReportParams

P = ReportParams.as_of(
    dt.date(2024, 1, 31), warehouses=("w1", "w2"), online_shops=("a", "b"),
    remark_phrase="gift", remark_label="gifts", store_names={"shop a": "A"},
)
DETAIL = (
    "stockout_id STRING, sid STRING, trade_no STRING, detail_spec_no STRING, "
    "detail_goods_count DECIMAL(18,2), detail_total_amount DECIMAL(18,2), consign STRING, "
    "status_CN STRING, shop_no STRING, shop_name STRING, warehouse_name STRING, "
    "trade_type_name STRING"
)


def line(doc="d1", item="i1", units=1, amount="10", day="2024-01-30", status="已完成", shop="a",
         name="shop a", warehouse="w1", kind="网店销售"):
    return (doc, "s", "t" + doc, item, Decimal(units), Decimal(amount), day + " 10:00:00", status,
            shop, name, warehouse, kind)


def detail(spark, *rows):
    table = spark.createDataFrame(list(rows), DETAIL)
    return table.withColumn("consign_time", F.col("consign").cast("timestamp_ntz"))


def window(spark, *rows):
    return R.in_window(detail(spark, *rows), P)


@pytest.fixture(scope="module")
def inventory(spark):
    rows = [("i1", "w1", 5, 4), ("i1", "w3", 7, 6), ("i2", "w2", 3, 1), ("i4", "w1", 2, 9)]
    return spark.createDataFrame(
        [(a, b, Decimal(c), Decimal(d)) for a, b, c, d in rows],
        "spec_no STRING, warehouse_name STRING, stock_num DECIMAL(18,2), cost_price DECIMAL(18,2)",
    )


@pytest.fixture(scope="module")
def products(spark):
    rows = [("i1", "item 1", "c1"), ("i2", "item 2", None), ("i4", "item 4", "c2")]
    return spark.createDataFrame(rows, "spec_no STRING, goods_name STRING, class_name STRING")


@pytest.fixture(scope="module")
def headers(spark):
    rows = [("d1", "s", "td1", "a gift"), ("d2", "s", "td2", None)]
    return spark.createDataFrame(
        rows, "stockout_id STRING, sid STRING, trade_no STRING, cs_remark STRING"
    )


def found(table):
    return [tuple(r) for r in table.collect()]


def test_window_is_eight_whole_days_and_shipped_only(spark):
    rows = [line(day=d) for d in ("2024-01-23", "2024-01-24", "2024-01-31", "2024-02-01")]
    rows += [line(status="未知状态"), line(status="已发货")]
    assert window(spark, *rows).count() == 3


def test_window_prunes_months(spark, tmp_path):
    path = str(tmp_path / "detail")
    rows = detail(spark, *(line(day=d) for d in ("2024-01-30", "2023-11-02", "2024-02-01")))
    monthly = loads.by_month(rows, "consign_time", S.CONSIGN_MONTH)
    U.write_partitions(monthly, path, S.CONSIGN_MONTH)
    found = R.in_window(spark.read.parquet(path), P)
    assert found.count() == 1
    text = io.StringIO()
    with redirect_stdout(text):
        found.explain()
    assert "consign_month" in text.getvalue().split("PartitionFilters: [")[1].split("]")[0]


def test_channel_summary(spark, inventory):
    lines = window(
        spark, line(units=2, amount="30"), line(item="i3", amount="5"),
        line(shop="010", units=1, amount="12"), line(shop=None, units=4, amount="0"),
        line(warehouse="w3", units=100),
    )
    # Costs are the highest over all warehouses; item i3 has none.
    assert found(R.channel_summary(lines, inventory, P)) == [
        (V.CHANNEL_ONLINE, 3.0, 35.0, 12.0, 0.34, 23.0),
        (V.CHANNEL_WHOLESALE, 5.0, 12.0, 30.0, 2.5, -18.0),
        (V.TOTAL_LABEL, 8.0, 47.0, 42.0, 0.89, 5.0),
    ]


def test_no_cost_at_all_and_no_revenue(spark, inventory):
    lines = window(spark, line(item="i3", amount="0"))
    assert found(R.channel_summary(lines, inventory, P)) == [
        (V.CHANNEL_ONLINE, 1.0, 0.0, None, None, None), (V.TOTAL_LABEL, 1.0, 0.0, None, None, None)
    ]
    free = window(spark, line(amount="0"))
    assert found(R.channel_summary(free, inventory, P))[0] == (
        V.CHANNEL_ONLINE, 1.0, 0.0, 6.0, None, -6.0
    )


def test_returns_sort_the_total_first(spark, inventory):
    lines = window(spark, line(units=-5, amount="-50"), line(shop="010", units=1))
    assert [r[0] for r in found(R.channel_summary(lines, inventory, P))] == [
        V.CHANNEL_ONLINE, V.TOTAL_LABEL, V.CHANNEL_WHOLESALE
    ]


def test_online_summary(spark, inventory):
    lines = window(
        spark, line(), line(shop="b", name="shop b", units=2), line(shop="c", name=None, units=3),
        line(shop="010", units=9), line(shop=None, units=9), line(kind="寄样", units=9),
    )
    assert [r[:2] for r in found(R.online_summary(lines, inventory, P))] == [
        ("A", 1.0), ("shop b", 2.0), (V.UNKNOWN_LABEL, 3.0), (V.TOTAL_LABEL, 6.0)
    ]


def test_offline_summary(spark, inventory, headers):
    lines = window(
        spark, line(shop="010"), line(doc="d2", shop="010", units=2),
        line(doc="d3", shop="010", units=3, warehouse="w9"), line(units=50),
    )
    assert [r[:2] for r in found(R.offline_summary(lines, headers, inventory, P))] == [
        ("gifts", 1.0), (V.REMARK_UNMATCHED, 5.0), (V.TOTAL_LABEL, 6.0)
    ]
    twice = headers.union(headers.withColumn("stockout_id", F.lit("other")))
    fanned = R.offline_summary(lines, twice, inventory, P, fanout=True)
    assert found(fanned)[-1][:2] == (V.TOTAL_LABEL, 9.0)


def test_offline_headers_are_filtered_in_their_scan(spark, tmp_path, inventory, headers):
    headers.write.parquet(str(tmp_path / "headers"))
    stored = spark.read.parquet(str(tmp_path / "headers"))
    report = R.offline_summary(window(spark, line(shop="010")), stored, inventory, P)
    text = io.StringIO()
    with redirect_stdout(text):
        report.explain()
    assert "StringContains(cs_remark,gift)" in text.getvalue()


def test_inventory_summary(spark, inventory, products):
    lines = window(spark, line(units=2), line(item="i9", units=3), line(item="i2", warehouse="w3"))
    assert found(R.inventory_summary(lines, inventory, products, P)) == [
        ("c2", 2.0, 18.0, None, None),
        (V.UNKNOWN_LABEL, 3.0, 3.0, 4.0, 20.0),
        ("c1", 5.0, 20.0, 2.0, 10.0),
        (V.TOTAL_LABEL, 10.0, 41.0, 6.0, 30.0),
    ]


def test_sku_detail(spark, inventory, products):
    lines = window(
        spark, line(units=2, amount="10"), line(shop="b", units=1, amount="15"),
        line(item="i3", amount="40"), line(shop="c", units=99),
    )
    assert found(R.sku_detail(lines, inventory, products, P.online_shops, P)) == [
        (V.TOTAL_LABEL, V.TOTAL_LABEL, 4.0, 65.0, 12.0, 5.0),
        ("i3", None, 1.0, 40.0, 0.0, 0.0),
        ("i1", "item 1", 3.0, 25.0, 12.0, 5.0),
    ]
    repeated = products.union(products)
    rows = found(R.sku_detail(lines, inventory, repeated, P.online_shops, P))
    assert ("i1", "item 1", 6.0, 50.0, 24.0, 5.0) in rows


def test_empty_window_gives_no_rows(spark, inventory, products):
    none = window(spark, line(day="2020-01-01"))
    assert found(R.channel_summary(none, inventory, P)) == []


def purchases(spark, *rows):
    table = spark.createDataFrame(
        [(a, b, c + " 09:00:00", d, Decimal(e), Decimal(f)) for a, b, c, d, e, f in rows],
        "detail_goods_no STRING, detail_goods_name STRING, at STRING, status_CN STRING, "
        "detail_total_cost DECIMAL(18,2), detail_goods_count DECIMAL(18,2)",
    )
    return table.withColumn("stockin_time", F.col("at").cast("timestamp_ntz"))


def test_purchase_detail(spark):
    rows = purchases(
        spark, ("g1", "n1", "2024-01-01", "已完成", 5, 1), ("g2", "n2", "2024-01-31", "已完成", 7, 2),
        ("g3", "n3", "2024-01-15", "已发货", 9, 3), ("g1", "n1", "2023-12-31", "已完成", 90, 9),
    )
    table = R.purchase_detail(rows, P)
    # A day with shipped receipts only has its columns, without a row.
    assert table.columns[2:] == [
        f"2024-01-{d}_{m}" for d in ("01", "15", "31") for m in ("amount", "count")
    ]
    assert found(table) == [
        (V.TOTAL_LABEL, V.TOTAL_LABEL, 5.0, 1.0, 0.0, 0.0, 7.0, 2.0),
        ("g1", "n1", 5.0, 1.0, 0.0, 0.0, 0.0, 0.0),
        ("g2", "n2", 0.0, 0.0, 0.0, 0.0, 7.0, 2.0),
    ]


def test_missing_units(spark):
    table = spark.createDataFrame(
        [("s", "1", "pc"), ("s", "2", " "), ("s", "3", None)],
        "sid STRING, spec_no STRING, unit STRING",
    )
    assert [r.line for r in R.missing_units(table).collect()] == [
        "卖家账号 = s, 货品编码 = 2", "卖家账号 = s, 货品编码 = 3"
    ]


def tables_of(spark, inventory, products, headers, lines, receipts):
    return bundle.Tables(detail(spark, *lines), headers, inventory, products, receipts)


def test_report_files(spark, tmp_path, inventory, products, headers):
    receipts = purchases(spark, ("g1", "n1", "2024-01-01", "已完成", 5, 1))
    lines = [line(), line(shop="010", units=2000, amount="12345.5")]
    t = tables_of(spark, inventory, products, headers, lines, receipts)
    folder = bundle.write_report(spark, t, P, str(tmp_path))
    assert folder.endswith("start_date=20240124/end_date=20240131")
    index = spark.read.parquet(f"{folder}/index").orderBy("ordinal").collect()
    assert [r.section for r in index] == [
        "channel", "online", "offline", "inventory", "sku_offline", "sku_online", "purchases"
    ]
    assert index[0].title == "20240124-20240131 " + V.TITLE_CHANNEL
    channel = spark.read.parquet(f"{folder}/section=channel")
    assert tuple(channel.columns) == V.SALES_HEADINGS
    assert ("批发业务", "2,000", "12,346", "12,000", "0.97", "346") in {
        tuple(r) for r in channel.collect()
    }
    assert spark.read.text(f"{folder}/message=purchases").isEmpty()
    bare = tables_of(spark, inventory, products, headers, lines, receipts.limit(0))
    folder = bundle.write_report(spark, bare, P, str(tmp_path / "bare"))
    assert spark.read.text(f"{folder}/message=purchases").first().value == (
        "20240101-20240131 " + V.EMPTY_PURCHASES
    )


def scanned_rows(table):
    """Rows each scan of a finished plan has put out, by the columns it reads."""
    found = []

    def walk(node):
        name = node.nodeName()
        if name.startswith("Scan parquet"):
            found.append((node.schema().simpleString(), node.metrics().apply("numOutputRows").value()))
        inner = [node.children().apply(i) for i in range(node.children().size())]
        inner += [node.executedPlan()] if name == "AdaptiveSparkPlan" else [node.plan()] if "QueryStage" in name else []
        for each in inner:
            walk(each)

    walk(table._jdf.queryExecution().executedPlan())
    return found


def test_headers_out_of_the_span_are_not_read(spark, inventory, tmp_path):
    """20,000 headers in months of their own; the window's documents are 200 of them."""
    path = str(tmp_path / "headers")
    rows = spark.range(20_000).select(
        F.format_string("d%06d", "id").alias("stockout_id"), F.lit("s").alias("sid"),
        F.format_string("t%06d", "id").alias("trade_no"),
        F.when(F.col("id") % 3 == 0, "a gift").otherwise("none").alias("cs_remark"),
        F.format_string("2024-%02d", F.expr("id div 2000")).alias("month"),
    )
    U.upsert_table(spark, path, rows, ["stockout_id", "sid"], [F.desc("trade_no")], "month")
    headers = spark.read.parquet(path)
    lines = detail(spark, *(line(doc=f"d{i:06}", shop="010", amount=str(i)) for i in range(4100, 4300)))
    plain = R.offline_summary(R.in_window(lines, P), headers, inventory, P)
    expected = plain.collect()
    report = bundle.offline_report(spark, lines, headers, inventory, P)
    assert report.collect() == expected and len(expected) == 3
    assert expected[0].revenue + expected[1].revenue == expected[2].revenue

    def of_headers(table):
        return sum(n for columns, n in scanned_rows(table) if "cs_remark" in columns)

    assert of_headers(plain) > 19_000 and of_headers(report) <= 2_000


def test_long_window_comes_in_blocks(spark, tmp_path, inventory, products, headers):
    days = [dt.date(2023, 1, 1) + dt.timedelta(days=3 * i) for i in range(70)]
    receipts = purchases(spark, *(("g1", "n1", str(d), "已完成", 5, 1) for d in days), ("g2", "n2", "2023-01-01", "已完成", 7, 2))
    p = replace(P, long_start=dt.date(2023, 1, 1))
    t = tables_of(spark, inventory, products, headers, [line()], receipts)
    folder = bundle.write_report(spark, t, p, str(tmp_path))
    places = {(r.block, r.place): r.day for r in spark.read.parquet(f"{folder}/days=purchases").collect()}
    assert [places[k] for k in sorted(places)] == [str(d) for d in days]
    section = spark.read.parquet(f"{folder}/section=purchases")
    assert len(section.columns) == 3 + 62
    rows = {(r.block, r[1]): r for r in section.collect()}
    assert sorted(rows) == sorted([("1", V.TOTAL_LABEL), ("1", "g1"), ("1", "g2"), *((b, n) for b in "23" for n in (V.TOTAL_LABEL, "g1"))])
    assert rows["1", V.TOTAL_LABEL][3:5] == ("12", "3") and rows["1", "g2"][5:7] == ("", "")
    assert {r.section: r.rows for r in bundle.written_sections(spark, folder).collect()}["purchases"] == 7


def test_hot_item_against_line_by_line_sums(spark, inventory, headers, products):
    """A third of the lines are of one item and one document."""
    chance = random.Random(7)
    rows = []
    for i in range(1500):
        hot = i % 3 == 0
        rows.append(line(
            doc="d1" if hot else f"d{i % 40}", item="i1" if hot else f"i{i % 90}",
            units=chance.randint(-2, 9), amount=str(chance.randint(0, 9000)),
            shop=chance.choice(["010", "a", "b", None]), name=None,
            warehouse=chance.choice(["w1", "w2", "w3"]),
        ))
    cost = defaultdict(lambda: None, {"i1": 6, "i2": 1, "i4": 9})
    expected = defaultdict(lambda: [0, 0, 0])
    for r in rows:
        if r[10] == "w3":
            continue
        group = V.CHANNEL_ONLINE if r[8] not in ("010", None) else V.CHANNEL_WHOLESALE
        for label in (group, V.TOTAL_LABEL):
            expected[label][0] += r[4]
            expected[label][1] += r[5]
            expected[label][2] += r[4] * (cost[r[3]] or 0)
    lines = window(spark, *rows).repartition(5)
    shown = {r[0]: list(r[1:4]) for r in found(R.channel_summary(lines, inventory, P))}
    assert shown == {k: [float(x) for x in v] for k, v in expected.items()}
    # The summed window stands in for the lines.
    items = R.window_items(R.in_window(lines, P), P)
    assert {r[0]: list(r[1:4]) for r in found(R.channel_summary(items, inventory, P))} == shown
    assert found(R.inventory_summary(items, inventory, products, P)) == found(
        R.inventory_summary(lines, inventory, products, P)
    )


def test_items_are_not_sent_to_the_driver(spark, tmp_path):
    """Files of a few hundred KB hold 50,000 items; no join of a report gathers them."""
    items = spark.range(50_000).select(F.col("id").cast("string").alias("spec_no"))
    items.select(
        "*", F.lit("w1").alias("warehouse_name"),
        *(F.lit(n).cast("decimal(18,2)").alias(c) for c, n in (("stock_num", 2), ("cost_price", 3))),
    ).write.parquet(f"{tmp_path}/inventory")
    items.select("*", F.lit("name").alias("goods_name"), F.lit("c").alias("class_name")).write.parquet(f"{tmp_path}/products")
    inventory, products = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("inventory", "products"))
    lines = window(spark, line(item="7", units=2, amount="30"), line(item="none", amount="5"))
    for report, joins, rows in (
        (R.channel_summary(lines, inventory, P), 1, 2),
        (R.sku_detail(lines, inventory, products, P.online_shops, P), 2, 3),
        (R.inventory_summary(lines, inventory, products, P), 2, 2),
    ):
        assert report.count() == rows
        report.collect()
        final = report._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert final.count("SortMergeJoin") >= joins
        # Classes, which are few, may meet by a broadcast.
        assert final.count("BroadcastHashJoin") <= (report.columns[1] == "stock")
