"""Column expressions on literal rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderloom import fixed_values as V
from orderloom import schemas as S
from orderloom.functions import classify, decode, text
from orderloom.operators import filters
from orderloom.operators import aggregates as A


def column(spark, values, kind, expression):
    table = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {kind}")
    return [r.x for r in table.orderBy("i").select(expression(F.col("v")).alias("x")).collect()]


def test_report_number_of_floats(spark):
    values = [0.0, None, float("nan"), 0.5, 1.5, 2.5, -0.3, 1234567.5, -1234.0]
    shown = column(spark, values, "DOUBLE", lambda c: text.report_number(c, is_float=True))
    assert shown == ["", "", "", "0", "2", "2", "-0", "1,234,568", "-1,234"]


def test_report_number_agrees_with_python(spark):
    values = [i / 8 for i in range(-4000, 4000, 7)]
    shown = column(spark, values, "DOUBLE", lambda c: text.report_number(c, is_float=True))
    assert shown == ["" if v == 0 else f"{v:,.0f}" for v in values]


def test_report_number_of_decimals_and_integers(spark):
    def as_decimal(c):
        return text.report_number(c.cast("decimal(18,2)"))

    assert column(spark, ["0", None, "0.50", "2.50", "3.50", "1234.51"], "STRING", as_decimal) == [
        "", "", "0", "2", "4", "1,235"
    ]
    assert column(spark, [0, 7, 12345], "BIGINT", text.report_number) == ["", "7", "12,345"]


@pytest.mark.parametrize(
    ("decoder", "table", "default"),
    [
        (decode.shipment_status, V.SHIPMENT_STATUS, V.SHIPMENT_STATUS_DEFAULT),
        (decode.shipment_trade_status, V.SHIPMENT_TRADE_STATUS, V.SHIPMENT_TRADE_STATUS_DEFAULT),
        (decode.trade_type, V.TRADE_TYPE, V.TRADE_TYPE_DEFAULT),
        (decode.order_origin, V.ORDER_ORIGIN, V.ORDER_ORIGIN_DEFAULT),
    ],
)
def test_decoders(spark, decoder, table, default):
    codes = [*table, "12345", None]
    assert column(spark, codes, "STRING", decoder) == [*table.values(), default, default]


def test_decoders_take_integers(spark):
    assert column(spark, [95, 110, 1], "INT", decode.shipment_status) == [
        "已发货", "已完成", "未知状态"
    ]


def test_codes_without_default_pass_through(spark):
    assert column(spark, ["39", "77", None], "STRING", decode.platform) == ["拼多多", "77", None]
    assert column(spark, ["70", "77", None], "STRING", decode.order_status) == ["已完成", "77", None]
    names = {"a": "x"}
    assert column(spark, ["a", "b", None], "STRING", lambda c: decode.relabel(c, names)) == [
        "x", "b", None
    ]
    assert column(spark, ["a"], "STRING", lambda c: decode.relabel(c, {})) == ["a"]


def test_channel_of_missing_shop_is_wholesale(spark):
    assert column(spark, ["010", "011", "", None], "STRING", classify.channel) == [
        V.CHANNEL_WHOLESALE, V.CHANNEL_ONLINE, V.CHANNEL_ONLINE, V.CHANNEL_WHOLESALE
    ]


def test_remark_class(spark):
    kinds = column(
        spark, ["a promo b", "none", None], "STRING",
        lambda c: classify.remark_class(c, "promo", "hit"),
    )
    assert kinds == ["hit", V.REMARK_UNMATCHED, V.REMARK_UNMATCHED]


def test_tax_rate(spark):
    rates = column(
        spark, ["0", "0.06", None], "STRING", lambda c: classify.tax_rate(c.cast("decimal(9,4)"))
    )
    assert [None if r is None else float(r) for r in rates] == [0.13, 0.06, None]


def test_order_ref(spark):
    remarks = [
        "售后返修换新 原订单号:123-4", "原订单号:123", "售后返修换新 原订单号:", "售后返修换新",
        "售后返修换新,原订单号:１２3;原订单号:9", None,
    ]
    assert column(spark, remarks, "STRING", text.order_ref) == ["123", None, None, None, "１２3", None]


def test_to_number(spark):
    assert column(spark, ["1.5", "x", "", None, "-2"], "STRING", text.to_number) == [
        1.5, None, None, None, -2.0
    ]


@pytest.mark.parametrize("value", [20240101, "20240101", "2024-01-01", dt.date(2024, 1, 1)])
def test_parse_day(value):
    assert text.parse_day(value) == dt.date(2024, 1, 1)


def test_day_range_is_whole_days(spark):
    stamps = ["2024-01-01 00:00:00", "2024-01-02 23:59:59", "2023-12-31 23:59:59",
              "2024-01-03 00:00:00", None]
    table = spark.createDataFrame([(s,) for s in stamps], "s STRING").select(
        F.col("s"), F.col("s").cast("timestamp_ntz").alias("ts")
    )
    found = table.where(filters.day_range("ts", 20240101, "20240102"))
    assert {r.s for r in found.collect()} == set(stamps[:2])


def test_lookback_includes_both_ends(spark):
    stamps = ["2024-01-08 12:00:00", "2024-01-10 12:00:00", "2024-01-08 11:59:59",
              "2024-01-10 12:00:01"]
    table = spark.createDataFrame([(s,) for s in stamps], "s STRING").select(
        "s", F.col("s").cast("timestamp_ntz").alias("ts")
    )
    found = table.where(filters.lookback("ts", dt.datetime(2024, 1, 10, 12)))
    assert {r.s for r in found.collect()} == set(stamps[:2])


def test_not_in_drops_null(spark):
    table = spark.createDataFrame([("a",), ("b",), (None,)], "v STRING")
    assert [r.v for r in table.where(filters.none_of("v", ["a"])).collect()] == ["b"]


def test_shipped_reads_codes_as_numbers(spark):
    table = spark.createDataFrame([("95",), ("110",), ("55",), ("x",), (None,)], "status STRING")
    assert {r.status for r in table.where(filters.shipped()).collect()} == {"95", "110"}


def test_lookup(spark):
    table = spark.createDataFrame([("a", 1), ("b", 2)], "k STRING, v INT")
    assert filters.require_match(table, "k", "b").first().v == 2
    with pytest.raises(LookupError):
        filters.require_match(table, "k", "c")


def test_ratio_by_zero_is_null(spark):
    table = spark.createDataFrame([(1.0, 0.0), (1.0, 8.0)], "a DOUBLE, b DOUBLE")
    assert [r.x for r in table.select(A.ratio(F.col("a"), F.col("b")).alias("x")).collect()] == [
        None, 0.13
    ]


def test_column_lists():
    assert len(S.SALES_HEADER_COLUMNS) == 46
    assert len(S.SALES_DETAIL_COLUMNS) == 76
    assert len(S.PURCHASE_DETAIL_COLUMNS) == 52
    assert len(S.ORDER_COLUMNS) == 23
    for columns in (S.SALES_HEADER_COLUMNS, S.SALES_DETAIL_COLUMNS, S.PURCHASE_DETAIL_COLUMNS):
        assert len(set(columns)) == len(columns)
