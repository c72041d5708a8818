"""Operators on literal rows: properties, hot keys and the shape of plans."""

import datetime as dt
import io
import random
import re
import shutil
from contextlib import redirect_stdout
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderloom import fixed_values as V
from orderloom.operators import aggregates as A
from orderloom.operators import joins, slots
from orderloom.operators import upsert as U
from orderloom.sources import tables

KEY = ["k"]
NEWEST = ["modified", "page"]


def newest():
    return [F.desc("modified"), F.asc("page")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "k STRING, v INT, modified INT, page INT")


def plan(table) -> str:
    text = io.StringIO()
    with redirect_stdout(text):
        table.explain()
    return text.getvalue()


def as_set(table):
    found = [tuple(r) for r in table.collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_latest_per_key(spark):
    rows = frame(spark, [("a", 1, 1, 0), ("a", 2, 2, 5), ("a", 3, 2, 1), ("b", 4, 0, 0)])
    assert as_set(U.latest_per_key(rows, KEY, newest())) == {("a", 3, 2, 1), ("b", 4, 0, 0)}


def test_latest_per_key_ignores_row_order(spark):
    rows = [(random.choice("abcde"), i, random.randint(0, 5), i) for i in range(200)]
    expected = {}
    for row in rows:
        best = expected.get(row[0])
        if best is None or (-row[2], row[3]) < (-best[2], best[3]):
            expected[row[0]] = row
    for _ in range(3):
        random.shuffle(rows)
        found = U.latest_per_key(frame(spark, rows).repartition(5), KEY, newest())
        assert as_set(found) == set(expected.values())


def test_latest_per_key_reduces_before_the_shuffle(spark):
    shown = plan(U.latest_per_key(frame(spark, [("a", 1, 1, 1)]), KEY, newest()))
    before = shown[shown.index("Exchange"):]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_upsert(spark):
    target = frame(spark, [("a", 1, 1, 0), ("b", 2, 1, 0), (None, 9, 1, 0)])
    batch = frame(spark, [("b", 5, 2, 0), ("c", 6, 2, 0), ("c", 7, 3, 0), (None, 8, 2, 0)])
    once = U.upsert(target, batch, KEY, newest())
    expected = {("a", 1, 1, 0), ("b", 5, 2, 0), ("c", 7, 3, 0), (None, 8, 2, 0)}
    assert as_set(once) == expected
    assert as_set(U.upsert(once, batch, KEY, newest())) == expected


def test_append_takes_whole_documents(spark):
    target = frame(spark, [("a", 1, 0, 0)])
    batch = frame(spark, [("a", 2, 0, 0), ("b", 3, 0, 0), ("b", 4, 0, 0)])
    assert as_set(U.append_new(target, batch, KEY)) == {
        ("a", 1, 0, 0), ("b", 3, 0, 0), ("b", 4, 0, 0)
    }


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_key_join_shuffles_each_side_once(spark, no_broadcast):
    columns = "k STRING, sid STRING, v INT"
    target = spark.createDataFrame([("a", "s", 1)], columns)
    batch = spark.createDataFrame([("a", "s", 2), ("b", "s", 3)], columns)
    fresh = U.unknown_rows(batch, target, ["k", "sid"])
    assert plan(fresh).count("Exchange hashpartitioning") == 2
    assert as_set(fresh) == {("b", "s", 3)}


def test_insert_ignore_keeps_the_first(spark):
    target = frame(spark, [("a", 1, 0, 0)])
    batch = frame(spark, [("a", 2, 0, 0), ("b", 3, 0, 1), ("b", 4, 0, 0)])
    found = U.insert_ignore(target, batch, KEY, [F.asc("page")])
    assert as_set(found) == {("a", 1, 0, 0), ("b", 4, 0, 0)}


def test_membership_and_actions(spark):
    target = frame(spark, [("a", 1, 0, 0), ("a", 2, 0, 0), ("x", 1, 0, 0)])
    batch = frame(spark, [("a", 2, 0, 0), ("b", 3, 0, 0)])
    assert as_set(U.known_rows(batch, target, KEY)) == {("a", 2, 0, 0)}
    assert as_set(U.unknown_rows(batch, target, KEY)) == {("b", 3, 0, 0)}
    assert as_set(U.upsert_actions(target, batch, KEY)) == {
        ("a", "updated"), ("b", "inserted"), ("x", "unchanged")
    }


def hot(spark, n=3000):
    """One key holds a third of the rows."""
    rows = [("hot" if i % 3 == 0 else f"k{i % 500}", i, i % 7, i) for i in range(n)]
    return rows, frame(spark, rows).repartition(6)


def test_hot_key_upsert(spark):
    rows, batch = hot(spark)
    target = frame(spark, [(f"k{i}", -1, 0, 0) for i in range(400, 600)] + [("hot", -1, 0, 0)])
    expected = {}
    for row in rows:
        best = expected.get(row[0])
        if best is None or (-row[2], row[3]) < (-best[2], best[3]):
            expected[row[0]] = row
    kept = {(f"k{i}", -1, 0, 0) for i in range(400, 600) if f"k{i}" not in expected}
    found = as_set(U.upsert(target, batch, KEY, newest()))
    assert found == set(expected.values()) | kept


def test_rollup_tells_null_group_from_total(spark):
    table = spark.createDataFrame([("a", 1), (None, 2), ("a", 4)], "g STRING, v INT")
    rolled = A.rollup(table, "g", [F.sum("v").alias("v")])
    assert as_set(rolled) == {
        ("a", False, 5), (V.UNKNOWN_LABEL, False, 2), (V.TOTAL_LABEL, True, 7)
    }


def test_total_row_skips_text(spark):
    table = spark.createDataFrame(
        [("p", None, "1.5", 1), ("q", "n", "x", 2), ("q", None, None, None)],
        "a STRING, b STRING, t STRING, v INT",
    )
    assert as_set(A.with_total(table, ["a", "b"])) == {
        (False, "p", None, 1.5, 1), (False, "q", "n", None, 2), (False, "q", None, None, None),
        (True, V.TOTAL_LABEL, V.TOTAL_LABEL, 1.5, 3),
    }
    assert as_set(A.with_total(table.limit(0), ["a", "b"])) == {
        (True, V.TOTAL_LABEL, V.TOTAL_LABEL, 0.0, 0)
    }


@pytest.fixture(scope="module")
def receipts(spark):
    rows = [
        ("a", "x", "2024-01-01 08:00:00", "1.50", 1), ("a", "x", "2024-01-01 23:59:59", "2.50", 1),
        ("a", "x", "2024-01-03 00:00:00", "4.00", 2), ("b", "y", "2024-01-03 10:00:00", "8.00", 3),
        ("b", None, "2024-01-02 10:00:00", "16.00", 4),
    ]
    table = spark.createDataFrame(rows, "no STRING, name STRING, ts STRING, cost STRING, n INT")
    return table.withColumns({
        "ts": F.col("ts").cast("timestamp_ntz"), "cost": F.col("cost").cast("decimal(18,2)"),
        "n": F.col("n").cast("decimal(18,2)"),
    })


DAYS = [dt.date(2024, 1, d) for d in (1, 2, 3)]


def numbers(table):
    return {tuple(float(x) if hasattr(x, "quantize") else x for x in r) for r in table.collect()}


def test_pivot_fills_with_zero_and_totals(spark, receipts):
    wide = A.daily_pivot(receipts, ["no", "name"], "ts", "cost", "n", DAYS, total="T")
    assert wide.columns == [
        "is_total", "no", "name", "2024-01-01_amount", "2024-01-01_count", "2024-01-02_amount",
        "2024-01-02_count", "2024-01-03_amount", "2024-01-03_count",
    ]
    assert numbers(wide) == {
        (False, "a", "x", 4.0, 2.0, 0.0, 0.0, 4.0, 2.0),
        (False, "b", "y", 0.0, 0.0, 0.0, 0.0, 8.0, 3.0),
        (False, "b", None, 0.0, 0.0, 16.0, 4.0, 0.0, 0.0),
        (True, "T", "T", 4.0, 2.0, 16.0, 4.0, 12.0, 5.0),
    }


def test_long_pivot_gives_the_wide_one(spark, receipts):
    wide = A.daily_pivot(receipts, ["no"], "ts", "cost", "n", DAYS).collect()
    long = A.daily_totals(receipts, ["no"], "ts", "cost", "n").collect()
    from_long = {(r.no, str(r.day)): (r.amount, r["count"]) for r in long}
    for row in wide:
        for day in DAYS:
            cell = (row[f"{day}_amount"], row[f"{day}_count"])
            assert cell == from_long.get((row.no, str(day)), (0, 0))


def test_blocks_give_the_long_form(spark):
    """Five blocks of three days, the last one with one day, against the daily totals."""
    chance = random.Random(3)
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=2 * i) for i in range(13)]
    rows = [
        (chance.choice(["a", "b", None]), str(chance.choice(days)), Decimal(chance.randrange(9)), Decimal(1)) for _ in range(60)
    ] + [("c", str(day), Decimal(0), Decimal(2)) for day in days]
    table = spark.createDataFrame(rows, "no STRING, day STRING, cost DECIMAL(18,2), n DECIMAL(18,2)").withColumn(
        "ts", F.col("day").cast("timestamp_ntz")
    )
    long = A.daily_totals(table, ["no"], "ts", "cost", "n")
    numbered = A.numbered_days(long.select("day").distinct(), 3)
    places = {(r.block, r.place): r.day for r in numbered.collect()}
    assert [places[b, p] for b, p in sorted(places)] == days
    assert {r.block: r.held for r in numbered.collect()} == {1: 3, 2: 3, 3: 3, 4: 3, 5: 1}
    expected = {(r.no, r.day): (r.amount, r["count"]) for r in long.collect()}
    for key, day in list(expected):
        total = expected.get(("T", day), (0, 0))
        expected["T", day] = tuple(a + b for a, b in zip(total, expected[key, day]))
    wide = A.blocked_pivot(long, ["no"], numbered, total="T", width=3).collect()
    seen = {}
    for row in wide:
        assert row.is_total == (row.no == "T")
        for place in (1, 2, 3):
            cell = (row[f"amount_{place}"], row[f"count_{place}"])
            if (row.block, place) not in places:
                assert cell == (None, None)
            elif cell != (0, 0) or (row.no, places[row.block, place]) in expected:
                seen[row.no, places[row.block, place]] = cell
    assert seen == expected and len({(r.block, r.no) for r in wide}) == len(wide)
    assert A.blocked_pivot(long.limit(0), ["no"], numbered, width=3).count() == 0


def test_blocks_are_spread_over_places_last(spark):
    """Few entries per key are gathered and sorted, and no sums by place."""
    long = spark.createDataFrame(
        [("a", dt.date(2024, 1, 1), Decimal(1), None), ("b", dt.date(2024, 1, 3), None, Decimal(2))],
        "no STRING, day DATE, amount DECIMAL(28,2), count DECIMAL(28,2)",
    )
    numbered = A.numbered_days(long.select("day"), 2)
    wide = A.blocked_pivot(long, ["no"], numbered, width=2, order=["block", F.desc("no")])
    assert [tuple(r) for r in wide.collect()] == [(1, "b", 0, 0, 0, 2), (1, "a", 1, 0, 0, 0)]
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    assert "pivotfirst" not in plan and plan.index("amount_2") < plan.index("Sort [")


def test_a_block_of_days_is_compiled(spark):
    """Java leaves methods of more than 8000 bytes to its interpreter."""
    long = spark.createDataFrame([], "no STRING, day DATE, amount DECIMAL(28,2), count DECIMAL(28,2)")
    days = spark.createDataFrame([], "day DATE, block INT, place INT, held BIGINT")
    wide = A.blocked_pivot(long, ["no"], days)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        shown = wide._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert 0 < max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", shown)) <= 8000


def test_pivot_without_days(spark, receipts):
    assert A.daily_pivot(receipts, ["no"], "ts", "cost", "n", []).columns == ["no"]


def test_slots(spark):
    table = spark.createDataFrame(
        [("2024-01-09 00:00:00",), ("2024-01-09 00:59:59",), ("2024-01-09 01:00:00",),
         ("2024-01-08 23:59:59",)], "ts STRING"
    ).select(F.col("ts").cast("timestamp_ntz").alias("ts"))
    filled = slots.fill_slots(
        slots.hourly_slots(spark, dt.date(2024, 1, 10), 1), A.slot_counts(table, "ts")
    ).orderBy("slot").collect()
    assert [r.n for r in filled] == [2, 1] + [0] * 22
    assert slots.hourly_slots(spark, dt.date(2024, 1, 10)).count() == 288


def test_span_of_nulls_and_nothing(spark, monkeypatch):
    rows = spark.createDataFrame([("b",), ("d",), (None,)], "k STRING")
    other = spark.createDataFrame([("a",), ("c",), ("e",), (None,)], "k STRING")

    def inside(span):
        return {r.k for r in other.where(span.holds("k")).collect()}

    assert inside(joins.span_of(rows, "k")) == {None}  # few values are asked for one by one
    assert inside(joins.span_of(other, "k")) == {"a", "c", "e", None}
    monkeypatch.setattr(joins, "FEW_VALUES", 0)
    assert inside(joins.span_of(rows, "k")) == {"c", None}
    assert inside(joins.span_of(rows.where("k IS NOT NULL"), "k")) == {"c"}
    assert inside(joins.span_of(rows.where("k IS NULL"), "k")) == {None}
    assert inside(joins.span_of(rows.limit(0), "k")) == set()


def test_joins_keep_unmatched_rows(spark):
    lines = spark.createDataFrame(
        [("1", "s", "t", "i1"), ("2", "s", "t", "i2")],
        "stockout_id STRING, sid STRING, trade_no STRING, spec_no STRING",
    )
    headers = spark.createDataFrame(
        [("1", "s", "t", "r1"), ("9", "s", "t", "r9")],
        "stockout_id STRING, sid STRING, trade_no STRING, cs_remark STRING",
    )
    by_key = joins.with_header(lines, headers, ["cs_remark"]).select("stockout_id", "cs_remark")
    assert as_set(by_key) == {("1", "r1"), ("2", None)}
    assert joins.with_header(lines, headers, ["cs_remark"], fanout=True).count() == 4
    products = spark.createDataFrame(
        [("i1", "n1"), ("i1", "n2")], "spec_no STRING, goods_name STRING"
    )
    named = joins.with_product(lines.select("spec_no"), products, ["goods_name"])
    assert as_set(named) == {("i1", "n1"), ("i1", "n2"), ("i2", None)}
    assert as_set(joins.repeated_keys(products, ["spec_no"])) == {("i1", 2)}


def test_upsert_table_rewrites_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")

    def rows(*values):
        return spark.createDataFrame(values, "k STRING, v INT, modified INT, page INT, month STRING")

    U.upsert_table(
        spark, path, rows(("a", 1, 1, 0, "m1"), ("b", 1, 1, 0, "m2")), KEY, newest(), "month"
    )
    before = {p.name for p in (tmp_path / "t" / "month=m1").iterdir()}
    U.upsert_table(
        spark, path, rows(("b", 2, 2, 0, "m2"), ("c", 2, 2, 0, "m3")), KEY, newest(), "month"
    )
    assert {p.name for p in (tmp_path / "t" / "month=m1").iterdir()} == before
    stored = tables.read_table(spark, path).select("k", "v", "month")
    assert as_set(stored) == {("a", 1, "m1"), ("b", 2, "m2"), ("c", 2, "m3")}
    U.upsert_table(spark, path, rows().limit(0), KEY, newest(), "month")
    # A key that changes its partition leaves the old one, the last row of it too.
    U.upsert_table(spark, path, rows(("a", 3, 3, 0, "m2")), KEY, newest(), "month")
    stored = tables.read_table(spark, path).select("k", "v", "month")
    assert as_set(stored) == {("a", 3, "m2"), ("b", 2, "m2"), ("c", 2, "m3")}
    U.upsert_table(
        spark, path, rows(("c", 4, 4, 0, "m3"), ("e", 4, 4, 0, "m1")), KEY, newest(), "month",
        keys_move=False,
    )
    stored = tables.read_table(spark, path).select("k", "v", "month")
    assert as_set(stored) == {("a", 3, "m2"), ("b", 2, "m2"), ("c", 4, "m3"), ("e", 4, "m1")}


def test_upsert_finishes_a_broken_run(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")

    def rows(*values):
        return spark.createDataFrame(values, "k STRING, v INT, modified INT, page INT, month STRING")

    def upsert(*values):
        U.upsert_table(spark, path, rows(*values), KEY, newest(), "month")

    upsert(("a", 1, 1, 0, "m1"), ("b", 1, 1, 0, "m1"), ("c", 1, 1, 0, "m2"))

    def lose_partition(*_):
        shutil.rmtree(tmp_path / "t" / "month=m1")
        raise OSError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(U, "write_partitions", lose_partition)
        with pytest.raises(OSError):
            upsert(("a", 2, 2, 0, "m1"))
    upsert(("d", 3, 3, 0, "m2"))
    stored = tables.read_table(spark, path).select("k", "v", "month")
    assert as_set(stored) == {("a", 2, "m1"), ("b", 1, "m1"), ("c", 1, "m2"), ("d", 3, "m2")}


def test_rename_and_catalog(spark):
    tables.rename(spark.range(1), ["n"]).createOrReplaceTempView("renamed")
    assert tables.read_table(spark, "renamed").columns == ["n"]
