"""Report job for spark-submit: one report over a stored order table, written as Parquet.

    spark-submit --py-files orderlens.zip orderlens/report_job.py --report dashboard \
        --orders hdfs:///profit/orders --output hdfs:///reports/today \
        --filter entity_id=FP_TW --filter region=Asia --filter region= --share 0.001 0.8 --link vendors

A filter names a column and a member it keeps, an empty member being NULL; several add up.
``--opening`` takes the filters the reports open with. The dashboard writes two folders.
"""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from orderlens.operators.lod import VENDOR_MARK, VERTICAL_LEVEL
from orderlens.params import DEFAULT_RUNNING_SHARE_RANGE, DEFAULT_VIEW_FILTERS, ReportParams, ViewFilters
from orderlens.plans import reports
from orderlens.session import temporary, tune
from orderlens.sources.versions import open_table, publish

REPORTS = ("vendors", "verticals", "bins", "scatter", "dashboard")
LINKS = {"vendors": VENDOR_MARK, "verticals": VERTICAL_LEVEL}


def arguments(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--report", required=True, choices=REPORTS)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--orders", help="folder of the order table")
    source.add_argument("--orders-table", help="its name in the catalog")
    parser.add_argument("--output", required=True)
    parser.add_argument("--opening", action="store_true")
    parser.add_argument("--dates", nargs=2, metavar=("FIRST", "LAST"))
    parser.add_argument("--filter", action="append", default=[], metavar="COLUMN=MEMBER")
    parser.add_argument("--order-drop", type=float, default=ReportParams().order_drop)
    parser.add_argument("--bin-size", type=float, default=ReportParams().gmv_bin_size)
    parser.add_argument("--share", nargs=2, type=float, default=DEFAULT_RUNNING_SHARE_RANGE)
    parser.add_argument("--link", choices=LINKS, help="keys by which the vendors select in the vertical report")
    return parser.parse_args(argv)


def view_filters(args: argparse.Namespace) -> ViewFilters:
    members: dict[str, list] = {}
    for text in args.filter:
        column, _, member = text.partition("=")
        members.setdefault(column, []).append(member or None)
    start = DEFAULT_VIEW_FILTERS if args.opening else ViewFilters()
    if args.dates:
        members["created_date_utc"] = args.dates
    return replace(start, **{column: tuple(kept) for column, kept in members.items()})


def build(orders: DataFrame, args: argparse.Namespace) -> dict[str, DataFrame]:
    """Folder name under the output (empty: the output itself) -> report."""
    filters, params = view_filters(args), ReportParams(args.order_drop, args.bin_size)
    if args.report == "dashboard":
        made = reports.dashboard(orders, filters, params, tuple(args.share), LINKS.get(args.link))
        return {"vendors": made.vendors, "verticals": made.verticals}
    return {"": {
        "vendors": lambda: reports.vendor_report(orders, filters, params, tuple(args.share)),
        "verticals": lambda: reports.vertical_report(orders, filters, params),
        "bins": lambda: reports.gmv_bins(orders, filters, params),
        "scatter": lambda: reports.vendor_scatter(orders, filters),
    }[args.report]()}


def main(argv=None) -> None:
    args = arguments(argv)
    spark = tune(SparkSession.builder.appName("orderlens-report").getOrCreate())
    orders = spark.table(args.orders_table) if args.orders_table else open_table(spark, args.orders)
    with temporary(spark):
        for name, report in build(orders, args).items():
            publish(report, f"{args.output}/{name}".rstrip("/"))


if __name__ == "__main__":
    main()
