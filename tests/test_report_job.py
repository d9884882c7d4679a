"""One run of the report job for each report, and the scope of its intermediate tables."""

import os

import pytest
from pyspark.sql import functions as F
from small import PARAMS, SESSION, sources, variant

from orderlens.params import DEFAULT_VIEW_FILTERS
from orderlens.plans import reports
from orderlens.plans.batch import profit_orders
from orderlens.report_job import arguments, main, view_filters
from orderlens.session import pin, temporary
from orderlens.sources.versions import open_table


@pytest.fixture
def orders(spark, tmp_path):
    path = f"{tmp_path}/orders"
    tables = sources(spark, sessions=[SESSION, variant(SESSION, vendor_id="v2", gfv_local=90.0)])
    profit_orders(tables, PARAMS).write.parquet(path)
    return path


@pytest.mark.parametrize("name, plan", [
    ("vendors", lambda o: reports.vendor_report(o)),
    ("verticals", lambda o: reports.vertical_report(o)),
    ("bins", lambda o: reports.gmv_bins(o)),
    ("scatter", lambda o: reports.vendor_scatter(o)),
])
def test_each_report(spark, tmp_path, orders, name, plan):
    out = f"{tmp_path}/out"
    main(["--report", name, "--orders", orders, "--output", out, "--share", "0", "1", "--filter", "region=Asia"])
    stored = open_table(spark, out)
    assert stored.count() > 0
    assert sorted(map(repr, stored.collect())) == sorted(map(repr, plan(open_table(spark, orders)).collect()))


def test_dashboard(spark, tmp_path, orders):
    out = f"{tmp_path}/out"
    main(["--report", "dashboard", "--orders", orders, "--output", out, "--share", "0", "0.9", "--link", "vendors"])
    shown = {r.vendor_id for r in open_table(spark, f"{out}/vendors").collect()}
    totals = open_table(spark, f"{out}/verticals").filter("is_total = 1").first()
    chosen = open_table(spark, orders).filter(F.col("vendor_id").isin(*shown))
    assert totals.gmv_eur == pytest.approx(chosen.agg(F.sum("gmv_eur")).first()[0]) if shown else totals.gmv_eur is None


def test_filters():
    given = ["--report", "bins", "--orders", "o", "--output", "x"]
    filters = view_filters(arguments([*given, "--filter", "region=Asia", "--filter", "region=", "--dates", "2022-07-01", "2022-07-02"]))
    assert filters.region == ("Asia", None) and filters.created_date_utc == ("2022-07-01", "2022-07-02")
    assert view_filters(arguments([*given, "--opening"])) == DEFAULT_VIEW_FILTERS


def test_intermediate_tables_end_with_their_scope(spark):
    with temporary(spark):
        inside = pin(spark.range(3), "scoped").inputFiles()[0]
        assert os.path.exists(inside.removeprefix("file:").replace("//", "/"))
    assert not os.path.exists(inside.removeprefix("file:").replace("//", "/"))
    assert pin(spark.range(3), "kept").count() == 3
