"""Jobs to submit: ``spark-submit`` this file or run ``python -m orderloom``."""

from __future__ import annotations

import argparse
import datetime as dt
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom import fixed_values as V
from orderloom import schemas as S
from orderloom.functions.text import parse_day
from orderloom.operators import slots, upsert
from orderloom.plans import bundle, loads
from orderloom.plans.params import ReportParams
from orderloom.session import SETTINGS
from orderloom.sources import pages as P
from orderloom.sources.tables import read_table
from orderloom.streaming import jobs


KINDS = {"sales": P.SALES, "purchases": P.PURCHASE, "orders": P.ORDER}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="orderloom")
    jobs = top.add_subparsers(dest="job", required=True)

    report = jobs.add_parser("report", help="write all report sections of a day")
    for table in ("detail", "headers", "inventory", "products", "purchases"):
        report.add_argument(f"--{table}", required=True, help="path or catalog name")
    report.add_argument("--as-of", required=True, type=parse_day)
    report.add_argument("--out", required=True)
    report.add_argument("--form", choices=("parquet", "csv"), default="parquet")
    report.add_argument("--warehouse", action="append", required=True)
    report.add_argument("--online-shop", action="append", required=True)
    report.add_argument("--remark-phrase", required=True)
    report.add_argument("--remark-label", required=True)
    report.add_argument("--store-name", action="append", default=[], metavar="NAME=SHORT")

    for name in ("sales", "purchases", "orders"):
        load = jobs.add_parser(f"load-{name}", help=f"load landed {name} pages")
        load.add_argument("--pages", required=True)
        load.add_argument("--table", required=True, help="path of the stored table")
        load.add_argument("--checkpoint", help="load only pages landed since the last run")
        load.add_argument("--rejects", help="folder for refused pages and rows without a key")
        load.add_argument("--tenant", action="append", help="load pages of this tenant")
        load.add_argument("--as-of", type=dt.datetime.fromisoformat, help="load request windows of the days before")
        load.add_argument("--look-back", type=int, default=V.LOOKBACK_DAYS, help="how many days before --as-of")
        if name != "orders":
            load.add_argument("--warehouse-no", action="append")
        if name == "sales":
            load.add_argument("--header-table", required=True)
        if name == "purchases":
            load.add_argument("--load", help="name of the load, needed without a checkpoint")
        else:
            load.add_argument("--keys-stay", action="store_true", help="a key never changes its month")
            load.add_argument("--changes", action="store_true", help="keep what the load did with each key")

    merge = jobs.add_parser("merge-purchases", help="put all loads of purchases into one")
    merge.add_argument("--table", required=True)
    merge.add_argument("--load", required=True, help="name of the merged load")

    check = jobs.add_parser("check-pages", help="what has landed of each request window")
    check.add_argument("--kind", choices=sorted(KINDS), required=True)
    check.add_argument("--pages", required=True)
    check.add_argument("--out", required=True, help="folder of the windows that are not complete")
    check.add_argument("--state", help="folder that keeps what has landed: only new pages are parsed")
    check.add_argument("--as-of", type=parse_day, help="also list hours of the back-fill nobody asked for")
    return top


def run_report(spark: SparkSession, args: argparse.Namespace) -> None:
    tables = bundle.Tables(
        *(read_table(spark, source) for source in (
            args.detail, args.headers, args.inventory, args.products, args.purchases
        ))
    )
    params = ReportParams.as_of(
        args.as_of,
        warehouses=tuple(args.warehouse),
        online_shops=tuple(args.online_shop),
        remark_phrase=args.remark_phrase,
        remark_label=args.remark_label,
        store_names=dict(pair.split("=", 1) for pair in args.store_name),
    )
    bundle.write_report(spark, tables, params, args.out, args.form)


def run_load(spark: SparkSession, args: argparse.Namespace) -> None:
    """All pages below the folder or, with a checkpoint, those not loaded yet."""
    kind = KINDS[args.job.removeprefix("load-")]

    def choose(pages: DataFrame) -> DataFrame:
        return P.chosen_pages(pages, args.as_of, args.look_back, args.tenant)

    def load(session: SparkSession, pages: DataFrame, name: str) -> None:
        rejects = args.rejects and f"{args.rejects}/load={name}"
        noted = name if getattr(args, "changes", False) else None
        if kind is P.SALES:
            loads.load_sales(
                session, pages, args.header_table, args.table, args.warehouse_no, rejects, not args.keys_stay, noted
            )
        elif kind is P.PURCHASE:
            run = None if args.checkpoint else loads.run_name(pages)
            loads.load_purchases(session, pages, args.table, name, args.warehouse_no, rejects, run)
        else:
            loads.load_orders(session, pages, args.table, rejects, not args.keys_stay, noted)

    if args.checkpoint:
        loads.load_landed(spark, args.pages, kind, args.checkpoint, load, choose=choose)
    else:
        pages = choose(P.read_pages(spark, args.pages, kind, by_day=True))
        load(spark, pages, getattr(args, "load", None) or loads.run_name(pages))


def run_check(spark: SparkSession, args: argparse.Namespace) -> int:
    """Writes the windows that are not complete; 1 if there are any, else 0."""
    kind = KINDS[args.kind]
    if args.state:
        stream = P.stream_pages(spark, args.pages, kind)
        jobs.completeness_stream(stream, kind, f"{args.state}/marks", f"{args.state}/checkpoint")
        windows = jobs.known_completeness(spark, f"{args.state}/marks", kind)
    else:
        windows = P.page_completeness(P.read_pages(spark, args.pages, kind), kind)
    if args.as_of:
        asked = slots.hourly_slots(spark, args.as_of).withColumnRenamed("slot", "start_time")
        missing = asked.join(windows, "start_time", "left_anti").withColumn("complete", F.lit(False))
        windows = windows.unionByName(missing, allowMissingColumns=True)
    windows.where(~F.col("complete")).write.mode("overwrite").parquet(args.out)
    return int(not spark.read.parquet(args.out).isEmpty())


def main(arguments: Sequence[str] | None = None) -> int:
    top = parser()
    args = top.parse_args(arguments)
    if args.job == "load-purchases" and not (args.checkpoint or args.load):
        top.error("load-purchases needs --checkpoint or --load")
    builder = SparkSession.builder.appName(f"orderloom {args.job}")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if args.job == "check-pages":
        return run_check(spark, args)
    if args.job == "merge-purchases":
        upsert.merge_loads(spark, args.table, args.load, S.STOCKIN_MONTH, S.PURCHASE_KEY)
    elif args.job == "report":
        run_report(spark, args)
    else:
        run_load(spark, args)
    return 0


if __name__ == "__main__":
    sys.exit(main())
