"""The submitted jobs from landed pages to a written report."""

import pytest

from orderloom.__main__ import main
from orderloom.sources import pages as P
from tests.test_ingest import land, page, receipt, shipment


def test_landed_pages_load_once(spark, tmp_path):
    out, checkpoint = str(tmp_path / "t"), str(tmp_path / "cp")
    command = ["load-purchases", "--pages", str(tmp_path / "in"), "--table", out,
               "--checkpoint", checkpoint]
    land(tmp_path / "in", page(P.PURCHASE, [receipt(1, lines=((1, 0), (2, 0)))]))
    main(command)
    land(tmp_path / "in", page(P.PURCHASE, [receipt(1, lines=((1, 0),)), receipt(2, lines=((3, 0),))]))
    main(command)
    main(command)
    rows = spark.read.parquet(out).select("stockin_id", "detail_rec_id").collect()
    assert sorted(map(tuple, rows)) == [("1", "1"), ("1", "2"), ("2", "3")]
    # A new checkpoint reads all pages again and changes nothing.
    main([*command[:-1], str(tmp_path / "cp2")])
    assert spark.read.parquet(out).count() == 3
    with pytest.raises(SystemExit):
        main(command[:-2])


def test_loads_then_report(spark, tmp_path):
    at = {n: str(tmp_path / n) for n in ("headers", "detail", "purchases", "orders", "out")}
    fields = {"consign_time": "2024-01-30 10:00:00", "shop_no": "a", "shop_name": "shop a",
              "warehouse_name": "w1", "status": 110}
    land(tmp_path / "sales", page(P.SALES, [shipment(1, lines=(11, 12), **fields)]))
    land(tmp_path / "receipts", page(P.PURCHASE, [
        receipt(1, lines=((1, 0),), stockin_time="2024-01-15 10:00:00")
    ]))
    land(tmp_path / "trades", page(P.ORDER, [{"trade_id": 1}]))
    main(["load-sales", "--pages", str(tmp_path / "sales"), "--table", at["detail"],
          "--header-table", at["headers"], "--warehouse-no", "w1"])
    main(["load-purchases", "--pages", str(tmp_path / "receipts"), "--table", at["purchases"],
          "--load", "first"])
    main(["load-orders", "--pages", str(tmp_path / "trades"), "--table", at["orders"]])
    assert spark.read.parquet(at["orders"]).count() == 1

    for name, rows, columns in (
        ("inventory", [(None, "w1", 1.0, 2.0)],
         "spec_no STRING, warehouse_name STRING, stock_num DOUBLE, cost_price DOUBLE"),
        ("products", [("i", "n", "c")], "spec_no STRING, goods_name STRING, class_name STRING"),
    ):
        spark.createDataFrame(rows, columns).write.parquet(str(tmp_path / name))
    main([
        "report", "--detail", at["detail"], "--headers", at["headers"],
        "--inventory", str(tmp_path / "inventory"), "--products", str(tmp_path / "products"),
        "--purchases", at["purchases"], "--out", at["out"], "--as-of", "20240131",
        "--warehouse", "w1", "--online-shop", "a", "--remark-phrase", "x", "--remark-label", "y",
        "--store-name", "shop a=A", "--form", "csv",
    ])
    folder = f"{at['out']}/start_date=20240124/end_date=20240131"
    online = spark.read.option("header", True).csv(f"{folder}/section=online")
    assert [r["销售类型"] for r in online.collect()] == ["A", "汇总"]
    purchases = spark.read.option("header", True).csv(f"{folder}/section=purchases")
    assert purchases.columns[2:] == ["2024-01-15_采购金额", "2024-01-15_采购件数"]
