"""Loads of landed pages: order, splits, copies, refused pages, names, recovery."""

import datetime as dt
import itertools
import json
import os
import re
import shutil

import pytest
from pyspark.sql import functions as F

from orderloom import schemas as S
from orderloom.__main__ import main
from orderloom.operators import upsert as U
from orderloom.plans import loads
from orderloom.registry.queries import QUERIES
from orderloom.sources import pages as P
from orderloom.sources import tables
from orderloom.sources import testdata as D
from orderloom.streaming import jobs
from tests.test_ingest import land, page, receipt
from tests.test_reports import scanned_rows


def order(number, status, day, **more):
    return {"trade_id": number, "trade_status": status, "trade_from": 1,
            "modified": f"2024-01-{day:02} 00:00:00", "trade_time": f"2024-0{1 + day % 2}-01 00:00:00"} | more


def write(folder, *pages):
    folder.mkdir(exist_ok=True)
    for number, each in enumerate(pages, len(list(folder.iterdir()))):
        (folder / f"p{number}.json").write_text(json.dumps(each) + "\n")


@pytest.mark.parametrize("files_per_batch", [1, 2, 1000])
def test_splits_and_landing_order_do_not_matter(spark, tmp_path, files_per_batch):
    pages = [
        page(P.ORDER, [order(1, 70, 5), order(2, 10, 1)], page_no=0),
        page(P.ORDER, [order(1, 30, 3), order(2, 20, 1)], page_no=1),
        page(P.ORDER, [order(3, 30, 2), order(2, 5, 1)], page_no=2),
    ]
    for at, landed in enumerate(itertools.permutations(pages)):
        if at % 2 and files_per_batch != 1:
            continue
        base = tmp_path / str(at)
        write(base, *landed)
        table = str(tmp_path / f"t{at}")
        loads.load_landed(
            spark, str(base), P.ORDER, str(tmp_path / f"cp{at}"),
            lambda s, p, _, to=table: loads.load_orders(s, p, to), files_per_batch,
        )
        stored = tables.read_table(spark, table).select("trade_id", "trade_status", "trade_month").collect()
        assert sorted(map(tuple, stored)) == [("1", "70", "2024-02"), ("2", "10", "2024-02"), ("3", "30", "2024-01")]


def test_upsert_reads_touched_partitions_only(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = spark.range(300).select(
        F.col("id").cast("string").alias("k"), F.lit(1).alias("v"), F.concat(F.lit("m"), F.col("id") % 3).alias("month")
    )
    U.upsert_table(spark, path, rows, ["k"], [F.desc("v")], "month")
    plans = []
    plain = U.unknown_rows
    monkeypatch.setattr(U, "unknown_rows", lambda a, b, k: plans.append(a._jdf.queryExecution().toString()) or plain(a, b, k))
    U.upsert_table(spark, path, rows.where("k = '4'").withColumn("v", F.lit(2)), ["k"], [F.desc("v")], "month", False)
    assert re.search(r"PartitionFilters: \[[^\]]*month#\d+ = m1", plans[0])
    assert tables.read_table(spark, path).agg(F.sum("v"), F.count("*")).first()[:] == (301, 300)


def test_keys_out_of_the_batchs_span_are_skipped(spark, tmp_path, monkeypatch):
    """What locating a small batch reads does not grow with the table."""
    path, read = str(tmp_path / "t"), []
    plain = U.known_rows

    def watched(rows, other, keys):
        if "v" not in rows.columns:
            rows.collect()
            read.append(sum(n for columns, n in scanned_rows(rows) if "k:" in columns))
        return plain(rows, other, keys)

    monkeypatch.setattr(U, "known_rows", watched)
    for month in range(5):
        rows = spark.range(1000 * month, 1000 * month + 1000).select(
            F.format_string("%06d", "id").alias("k"), F.lit(1).alias("v"), F.lit(f"m{month}").alias("month")
        )
        U.upsert_table(spark, path, rows, ["k"], [F.desc("v")], "month")
        moved = spark.createDataFrame([("000007", month + 2, "m0"), ("000009", 9, "m9")], "k STRING, v INT, month STRING")
        U.upsert_table(spark, path, moved, ["k"], [F.desc("v")], "month")
    table = tables.read_table(spark, path)
    assert table.count() == 5000 and {r.month for r in table.where("k = '000009'").collect()} == {"m9"}
    assert table.where("k = '000007'").first().v == 6
    # The first month's files and the one row of the month a key has moved to.
    assert set(read[1::2]) <= {1000, 1001}
    # The first and the last key: their span is the whole table, their Bloom filters aren't.
    ends = spark.createDataFrame([("000000", 7, "m0"), ("004999", 7, "m4")], "k STRING, v INT, month STRING")
    U.upsert_table(spark, path, ends, ["k"], [F.desc("v")], "month")
    assert read[-1] < 2100 and tables.read_table(spark, path).where("v = 7").count() == 2


def test_append_does_not_shuffle_stored_keys(spark):
    target = spark.range(0, 100_000, 1, 8).select(F.col("id").cast("string").alias("k"))
    batch = spark.createDataFrame([("5",), ("x",)], "k STRING")
    fresh = U.fresh_rows(batch, target, ["k"])
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert [r.k for r in fresh.collect()] == ["x"]
    final = fresh._jdf.queryExecution().executedPlan().toString()
    above = [line for line in final.split("== Initial Plan ==")[0].splitlines() if "Exchange hashpartitioning" in line]
    assert "BroadcastHashJoin" in plan or "BroadcastHashJoin" in final
    assert "Range (0, 100000" in final and len(above) <= 2


def test_refused_pages_do_not_stop_a_stream(spark, tmp_path):
    source, out, rejects = tmp_path / "in", str(tmp_path / "t"), str(tmp_path / "r")
    command = ["load-orders", "--pages", str(source), "--table", out, "--checkpoint", str(tmp_path / "cp"),
               "--rejects", rejects]
    write(
        source,
        page(P.ORDER, [order(1, 10, 1)]),
        page(P.ORDER, [order(2, 10, 1)], errorcode=9),
        page(P.ORDER, [order(3, 10, 1, pay_time="0000-00-00 00:00:00")], page_no=3),
        page(P.ORDER, [order(None, 10, 1), order(4, 10, 2)]),
    )
    assert main(command) == 0
    stored = tables.read_table(spark, out).select("trade_id").collect()
    assert sorted(r.trade_id for r in stored) == ["1", "4"]
    refused = spark.read.parquet(f"{rejects}/load=*/pages").collect()
    assert sorted((r.reason, r.source.rsplit("/", 1)[1]) for r in refused) == [
        ("error code 9", "p1.json"), ("malformed", "p2.json")
    ]
    assert [r.trade_status for r in spark.read.parquet(f"{rejects}/load=*/orders").collect()] == ["10"]
    # Later pages go on loading.
    write(source, page(P.ORDER, [order(5, 10, 1)]))
    main(command)
    assert tables.read_table(spark, out).count() == 3


def test_malformed_lines_are_refused(spark, tmp_path):
    bad = receipt(1, lines=((1, 0),))
    bad["details_list"][0]["goods_count"] = "many"
    pages = [page(P.PURCHASE, [bad]), page(P.PURCHASE, [receipt(2)])]
    read = P.read_pages(spark, land(tmp_path / "p", *pages), P.PURCHASE)
    texts = spark.createDataFrame([(json.dumps(p),) for p in pages], "body STRING")
    for found in (read, P.parse_pages(texts, "body", P.PURCHASE)):
        assert P.valid_pages(found).count() == 1
        assert [r.reason for r in P.rejected_pages(found).select(P.reason().alias("reason")).collect()] == ["malformed"]
        with pytest.raises(Exception, match="malformed"):
            P.valid_pages(found, strict=True).collect()


def lines_of(spark, path):
    return sorted(map(tuple, tables.read_table(spark, path).select("stockin_id", "detail_rec_id", "page_no").collect()), key=str)


def test_receipts_stay_whole(spark, tmp_path):
    """The copy that landed first is stored, with all of its lines and none of the other's."""
    one = page(P.PURCHASE, [receipt(1, lines=((1, 0), (2, 0), (None, 0), (None, 0)))], page_no=0)
    two = page(P.PURCHASE, [receipt(1, lines=((2, 0), (3, 0)))], page_no=1)
    whole = [("1", "1", 0), ("1", "2", 0), ("1", None, 0), ("1", None, 0)]
    for files_per_batch in (1, 1000):
        source, out = tmp_path / f"in{files_per_batch}", str(tmp_path / f"t{files_per_batch}")
        write(source, one)
        first = (source / "p0.json").stat().st_mtime_ns
        write(source, two)
        os.utime(source / "p1.json", ns=(first + 10**9, first + 10**9))
        loads.load_landed(
            spark, str(source), P.PURCHASE, str(tmp_path / f"cp{files_per_batch}"),
            lambda s, p, name, to=out: loads.load_purchases(s, p, to, name), files_per_batch,
        )
        assert lines_of(spark, out) == sorted(whole, key=str)


def test_null_keys_fail_a_strict_load(spark, tmp_path):
    path = land(tmp_path / "p", page(P.PURCHASE, [receipt(None)]))
    with pytest.raises(Exception, match="receipts without"):
        loads.load_purchases(spark, P.read_pages(spark, path, P.PURCHASE), str(tmp_path / "t"), "a")


def test_a_load_name_is_for_one_set_of_pages(spark, tmp_path):
    out = str(tmp_path / "t")
    first = land(tmp_path / "p", page(P.PURCHASE, [receipt(9, lines=((1, 0),))]))
    second = land(tmp_path / "q", page(P.PURCHASE, [receipt(10, lines=((1, 0),))]))
    command = ["load-purchases", "--table", out, "--load", "a", "--pages"]
    main([*command, first])
    main([*command, first])
    with pytest.raises(ValueError, match="other pages"):
        main([*command, second])
    assert {r[0] for r in lines_of(spark, out)} == {"9"}


def test_loads_are_merged(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "t")
    for number in (1, 2, 3):
        folder = land(tmp_path / f"p{number}", page(P.PURCHASE, [receipt(number, lines=((1, 0), (2, 0)))]))
        main(["load-purchases", "--table", out, "--load", f"l{number}", "--pages", folder])
    before = lines_of(spark, out)

    def lose(*_):
        raise OSError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(U, "_write_load", lose)
        with pytest.raises(OSError):
            main(["merge-purchases", "--table", out, "--load", "all"])
    again = land(tmp_path / "p4", page(P.PURCHASE, [receipt(2, lines=((9, 0),)), receipt(4, lines=((1, 0),))]))
    main(["load-purchases", "--table", out, "--load", "l4", "--pages", again])
    assert lines_of(spark, out) == sorted([*before, ("4", "1", 0)], key=str)
    assert {r.load for r in tables.read_table(spark, out).collect()} == {"all", "l4"}
    with pytest.raises(ValueError, match="other pages"):
        main(["load-purchases", "--table", out, "--load", "l1", "--pages", again])


def test_another_process_finishes_a_broken_run(spark, tmp_path, monkeypatch):
    """Nothing but the table's own folder is needed, however its path is written."""
    path = str(tmp_path / "t")

    def upsert(to, *values):
        rows = spark.createDataFrame(values, "k STRING, v INT, month STRING")
        U.upsert_table(spark, to, rows, ["k"], [F.desc("v")], "month")

    def lose(*_):
        shutil.rmtree(tmp_path / "t" / "month=m1")
        raise OSError("driver lost")

    upsert(path, ("a", 1, "m1"), ("b", 1, "m1"))
    with monkeypatch.context() as patched:
        patched.setattr(U, "write_partitions", lose)
        with pytest.raises(OSError):
            upsert(path, ("a", 2, "m1"))
    shutil.move(path, tmp_path / "moved")  # as another machine may see it
    upsert(f"{tmp_path}/moved/", ("c", 3, "m2"))
    stored = tables.read_table(spark, f"{tmp_path}/moved").select("k", "v", "month").collect()
    assert sorted(map(tuple, stored)) == [("a", 2, "m1"), ("b", 1, "m1"), ("c", 3, "m2")]
    assert sorted(p.name for p in (tmp_path / "moved" / "_staging").iterdir()) == ["state"]


def test_odd_partition_names_are_refused(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, "../m")], "k STRING, v INT, month STRING")
    with pytest.raises(ValueError, match="cannot name a folder"):
        U.upsert_table(spark, str(tmp_path / "t"), rows, ["k"], [F.desc("v")], "month")


def test_check_pages(spark, tmp_path):
    docs = [{"trade_id": i} for i in range(110)]
    whole = [page(P.ORDER, docs[:100], total=110, page_no=0), page(P.ORDER, docs[100:], total=110, page_no=1)]
    out = str(tmp_path / "out")

    def check(name, *pages, more=()):
        code = main(["check-pages", "--kind", "orders", "--pages", land(tmp_path / name, *pages), "--out", out, *more])
        return code, spark.read.parquet(out).collect()

    assert check("a", *whole) == (0, [])
    code, found = check("b", whole[0], whole[0], page(P.ORDER, docs[100:], errorcode=9, page_no=1))
    assert code == 1 and [(r.declared, r.landed, r.pages) for r in found] == [(110, 100, 1)]
    code, found = check("c", page(P.ORDER, docs, errorcode=9))
    assert code == 1 and [(r.declared, r.landed, r.complete) for r in found] == [(None, 0, False)]
    code, found = check("d", *whole, more=["--as-of", "20240131"])
    assert code == 1 and {r.sid for r in found} == {None} and len(found) >= 23


def test_json_is_parsed_once(spark, tmp_path, monkeypatch):
    """With a folder for refused pages, what is written comes from staged columns."""
    folder = land(tmp_path / "p", page(P.ORDER, [order(1, 10, 1), order(None, 10, 1)]), page(P.ORDER, [], errorcode=9))
    plans = []

    def watch(name):
        plain = getattr(U, name)

        def watched(session, path, batch, *rest):
            plans.append(batch._jdf.queryExecution().toString())
            return plain(session, path, batch, *rest)

        monkeypatch.setattr(U, name, watched)

    watch("upsert_table")
    watch("append_table")
    base = str(tmp_path / "t")
    loads.load_orders(spark, P.read_pages(spark, folder, P.ORDER), base + "o", base + "ro")
    loads.load_sales(spark, P.read_pages(spark, folder, P.SALES), base + "h", base + "d", rejects=base + "rs")
    loads.load_purchases(spark, P.read_pages(spark, folder, P.PURCHASE), base + "p", "l", rejects=base + "rp")
    assert len(plans) == 4 and all("Format: Parquet" in plan and "Format: JSON" not in plan for plan in plans)
    assert spark.read.parquet(base + "ro/pages").count() == 1 and spark.read.parquet(base + "ro/orders").count() == 1
    assert not (tmp_path / "to" / "_staging" / "pages").exists()
    assert [r.trade_id for r in tables.read_table(spark, base + "o").collect()] == ["1"]


def windows(folder, *days):
    """A page per day, whose window ends then, in the folder of that day."""
    for day in days:
        one = page(P.ORDER, [order(day, 10, day)]) | {
            "start_time": f"2024-01-{day - 1:02} 12:00:00", "end_time": f"2024-01-{day:02} 12:00:00"
        }
        place = folder / f"day=2024-01-{day:02}"
        place.mkdir(parents=True)
        (place / "p.json").write_text(json.dumps(one) + "\n")


def test_look_back_opens_files_of_its_days_only(spark, tmp_path):
    windows(tmp_path / "in", *range(2, 28))
    found = P.chosen_pages(P.read_pages(spark, str(tmp_path / "in"), P.ORDER, True), dt.datetime(2024, 1, 20, 18), 2)
    days = sorted(r.end_time.day for r in found.collect())
    assert days == [19, 20, 21]  # the 18th's window ends before the two days begin
    scan = found._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numFiles").value() == 10  # of 26: the folders from the 18th on
    out = str(tmp_path / "t")
    command = ["load-orders", "--pages", str(tmp_path / "in"), "--as-of", "2024-01-20T18:00:00", "--table"]
    assert main([*command, out, "--checkpoint", str(tmp_path / "cp")]) == 0
    assert main([*command, out + "2", "--tenant", "s1", "--look-back", "1"]) == 0
    assert main([*command, out + "3", "--tenant", "other", "--rejects", str(tmp_path / "r")]) == 0

    def ids(path):
        return sorted(int(r.trade_id) for r in tables.read_table(spark, path).collect())

    assert ids(out) == [19, 20, 21] and ids(out + "2") == [20, 21] and not os.path.exists(out + "3/trade_month=2024-01")


def test_pages_without_day_folders_are_asked(spark, tmp_path):
    folder = land(tmp_path / "p", page(P.ORDER, [order(1, 10, 1)]))
    for by_day in (False, True):
        pages = P.read_pages(spark, folder, P.ORDER, by_day)
        assert P.chosen_pages(pages, dt.datetime(2024, 1, 4)).count() == 1
        assert P.chosen_pages(pages, dt.datetime(2024, 1, 9)).count() == 0
        assert P.chosen_pages(pages, tenants=["s2"]).count() == 0


@pytest.mark.parametrize("few", [False, True])
def test_a_batch_meets_the_table_once(spark, few):
    columns = "k STRING, v INT, month STRING, place INT"
    old = spark.createDataFrame(
        [("a", 1, "m1", 0), ("b", 2, "m1", 1), ("c", 3, "m2", 2), ("e", 2, "m1", 0), ("e", 2, "m1", 0),
         ("f", 1, "m1", 0), ("f", 1, "m1", 0), (None, 4, "m1", 3)], columns)
    latest = spark.createDataFrame(
        [("a", 5, "m1", 0), ("b", 2, "m1", 9), ("c", 2, "m3", 0), ("d", 1, "m3", 0), ("e", 0, "m1", 0),
         (None, 5, "m1", 0)], columns)
    merged = U.contest(old, latest, ["k"], [F.desc("v"), F.asc("place")], ["place"], few)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    # A batch that is not small deals the stored rows once, for winners and actions.
    assert few or plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert sorted(map(tuple, merged.collect()), key=str) == sorted([
        ("a", 5, "m1", 0, "updated"), ("b", 2, "m1", 1, "unchanged"), ("c", 3, "m2", 2, "unchanged"),
        ("d", 1, "m3", 0, "inserted"), ("e", 2, "m1", 0, "unchanged"), ("f", 1, "m1", 0, None),
        ("f", 1, "m1", 0, None), (None, 5, "m1", 0, "updated")], key=str)


def test_changes_are_kept_with_their_load(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")

    def load(name, *rows):
        batch = spark.createDataFrame(rows, "k STRING, v INT, month STRING, place INT")
        U.upsert_table(spark, path, batch, ["k"], [F.desc("v")], "month", load=name, origin=["place"])

    def changes():
        found = U.table_changes(spark, path).select("load", "k", "action").collect()
        return {(r.load, r.k): r.action for r in found}

    load("one", ("a", 1, "m1", 0), ("b", 2, "m1", 1), ("c", 3, "m2", 2))
    expected = {("one", k): "inserted" for k in "abc"}
    assert changes() == expected
    # Newer, same values from another place, older, moved, new.
    load("two", ("a", 5, "m1", 0), ("b", 2, "m1", 9), ("c", 2, "m2", 0), ("d", 1, "m3", 0))
    expected |= {("two", "a"): "updated", ("two", "b"): "unchanged", ("two", "c"): "unchanged", ("two", "d"): "inserted"}
    assert changes() == expected

    def lose(*_):
        raise OSError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(U, "write_partitions", lose)
        with pytest.raises(OSError):
            load("three", ("d", 7, "m1", 0))
    assert changes() == expected
    load(None, ("e", 1, "m1", 0))  # finishes the broken one; keeps no notes of its own
    assert changes() == expected | {("three", "d"): "updated"}
    assert tables.read_table(spark, path).where("k = 'd'").select("v", "month").collect() == [(7, "m1")]


def test_changes_by_a_batch_that_is_not_small(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(U, "FEW_ROWS", 0)
    test_changes_are_kept_with_their_load(spark, tmp_path, monkeypatch)


def test_state_of_landed_windows(spark, tmp_path):
    """After every landing the marks kept give what all pages give."""
    docs = [{"trade_id": i} for i in range(110)]
    later = {"start_time": "2024-01-05 00:00:00", "end_time": "2024-01-06 00:00:00"}
    landings = [
        [page(P.ORDER, docs[:100], total=110, page_no=0)],
        [page(P.ORDER, [], errorcode=9) | later],
        [page(P.ORDER, docs[:100], total=110, page_no=0), page(P.ORDER, docs[90:105], total=110, page_no=1)],
        [page(P.ORDER, docs[100:], total=111, page_no=1)],
        [page(P.ORDER, docs[:1], total=1) | later],
        [page(P.ORDER, [{"trade_id": 500}, {"trade_id": None}], total=111, page_no=1)],
    ]
    source, seen = tmp_path / "in", []
    for pages in landings:
        write(source, *pages)
        stream = P.stream_pages(spark, str(source), P.ORDER, files_per_batch=1)
        jobs.completeness_stream(stream, P.ORDER, str(tmp_path / "m"), str(tmp_path / "cp"), compact_every=3)
        kept = jobs.known_completeness(spark, str(tmp_path / "m"), P.ORDER).collect()
        whole = P.page_completeness(P.read_pages(spark, str(source), P.ORDER), P.ORDER).collect()
        assert sorted(map(tuple, kept)) == sorted(map(tuple, whole))
        seen.append({r.start_time.day: (r.declared, r.landed, r.pages, r.complete) for r in kept})
    assert seen[0] == {1: (110, 100, 1, False)}
    assert seen[1] == {1: (110, 100, 1, False), 5: (None, 0, 0, False)}
    assert seen[3][1] == (111, 110, 2, False) and seen[5] == {1: (111, 111, 2, True), 5: (1, 1, 1, True)}
    assert len([p for p in (tmp_path / "m").iterdir() if p.name.startswith("batch_id")]) <= 4
    out = str(tmp_path / "out")
    command = ["check-pages", "--kind", "orders", "--pages", str(source), "--out", out]
    assert main(command) == main([*command, "--state", str(tmp_path / "state")]) == 0


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (blocks.apply(i).getName() for i in range(blocks.size())) if name.startswith("shuffle_")}


def test_loaded_pages_and_shuffles_go(spark, tmp_path):
    table, landed, before = str(tmp_path / "t"), tmp_path / "in", shuffle_files(spark)
    landed.mkdir()
    for number in (1, 2, 3):
        sent = [[receipt(number, lines=((number, 0),)), receipt(1, lines=((9, 0),))]]
        if number == 2:  # a second batch of the same run
            sent.append([receipt(7, lines=((7, 0),))])
        for at, docs in enumerate(sent):
            (landed / f"p{number}-{at}.json").write_text(json.dumps(page(P.PURCHASE, docs)) + "\n")
        loads.load_landed(
            spark, str(landed), P.PURCHASE, str(tmp_path / "cp"),
            lambda s, p, name: loads.load_purchases(s, p, table, name, None, str(tmp_path / f"r/load={name}")),
            files_per_batch=1, clean=True,
        )
        assert len(list(landed.glob("*.json"))) == 1  # those of the last batch
    stored = tables.read_table(spark, table).select("stockin_id", "detail_rec_id").collect()
    assert sorted(map(tuple, stored)) == [("1", "1"), ("2", "2"), ("3", "3"), ("7", "7")]
    assert shuffle_files(spark) <= before


def test_receipts_land_in_steps(spark, monkeypatch):
    """As many rows as in one step, and only the pages of one step or two at a time."""
    folder, seen = "/root/testdata/sf0.001", []
    pages = D.table(spark, folder, "lineitem").count()
    whole = D.PAGES_PER_LANDING
    run = loads.load_landed

    def counted(session, path, *args, **more):
        seen.append(session.read.text(path).count())
        run(session, path, *args, **more)

    monkeypatch.setattr(loads, "load_landed", counted)
    frames = []
    for most in (whole, pages // 2 + 1):
        monkeypatch.setattr(D, "PAGES_PER_LANDING", most)
        frames.append(QUERIES["load_purchases_pages"](spark, folder))
    assert not frames[0].exceptAll(frames[1]).count() and frames[0].count() == frames[1].count()
    assert len(seen) == 2 + 4 and max(seen[2:]) < 1.5 * pages
    assert sum(D.table(spark, folder, "lineitem").where(part).count() for part in D.landing_steps(spark, folder)) == pages
