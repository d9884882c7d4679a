"""Physical plans, and results that do not depend on them."""

import re

import pytest
from conftest import CHECK

from orderlens.checks import registry
from orderlens.plans import reports
from orderlens.operators.lod import VENDOR_MARK, marks
from orderlens.operators.order_fact import order_fact
from orderlens.operators.impute import zone_average_fee


def plan_of(frame) -> str:
    """Plan as run, adaptive changes included."""
    frame._jdf.queryExecution().toRdd().count()
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def fact(spark):
    return order_fact(registry.sources(spark, CHECK), registry.zones(spark, CHECK), registry.FIXTURE_PARAMS)


@pytest.mark.parametrize("name", registry.QUERIES)
def test_no_cross_join_and_no_python(spark, name):
    plan = registry.QUERIES[name].spark(spark, CHECK)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|ArrowEval|InPandas|BatchEval", plan)


def test_session_filters_and_columns_reach_the_scan(spark):
    plan = fact(spark).select("gmv_eur")._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "gmv_local" in line)
    assert "created_date" in scan and "PushedFilters: [IsNotNull(created_date)" in scan
    assert "chain_name" not in scan and "voucher_dh_local" not in scan


def test_order_rows_are_shuffled_once(spark, setting):
    """Both order-key joins use one layout, and the per-code reduction after them needs none."""
    setting("spark.sql.autoBroadcastJoinThreshold", "100k")
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", "100k")
    plan = plan_of(zone_average_fee(fact(spark)))
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    columns = [tuple(re.findall(r"([a-z_]+)#", k)) for k in keys]
    assert sorted(c for c in columns if "uuid" not in c) == [
        ("entity_id", "platform_order_code"),  # sessions
        ("entity_id", "platform_order_code"),  # delivery orders
        ("entity_id", "platform_order_code"),  # platform orders with flags
        ("entity_id", "zone_name"),  # one row per zone and task
    ]
    assert "Expand" not in plan


def test_zone_average_is_joined_without_a_shuffle(spark):
    plan = plan_of(registry.order_profit(spark, CHECK).select("gross_profit_eur_cf"))
    assert not re.search(r"hashpartitioning\([^)]*zone_name", plan)


def test_distinct_orders_are_spread_by_order_code(spark):
    """The first shuffle of the marks is on key and order code, after a partial reduction."""
    plan = plan_of(marks(registry.orders(spark, CHECK), VENDOR_MARK))
    first = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line][-1]
    assert "platform_order_code" in first


def test_reports_read_only_their_columns(spark):
    plan = registry.orders(spark, CHECK).transform(reports.gmv_bins)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    schema = re.search(r"FileScan parquet \[([^\]]*)\]", scan).group(1)
    assert len(schema.split(",")) == 5


SAME = ["vendor_agg_metrics", "zone_avg_fee", "vendor_view", "vertical_totals", "gmv_bins"]


@pytest.mark.parametrize("name", SAME)
def test_results_do_not_depend_on_the_layout(spark, setting, name):
    def rows():
        return sorted(map(repr, registry.QUERIES[name].spark(spark, CHECK).collect()))

    expected = rows()
    setting("spark.sql.shuffle.partitions", "3")
    setting("spark.sql.adaptive.enabled", "false")
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    tuned = registry.tune
    registry.tune = lambda session: session
    try:
        assert rows() == expected
    finally:
        registry.tune = tuned


@pytest.mark.parametrize("linked, scans", [
    (False, {"order-sets", "shown-verticals"}), (True, {"vendor-marks", "order-sets"})])
def test_order_table_scans_of_the_vertical_report(spark, monkeypatch, linked, scans):
    """The order table is read once for sums and once, two narrow columns more than the keys, for distinct orders.

    What is written is as small as the marks, not as the orders.
    """
    table = registry.orders(spark, CHECK)
    folder = table.inputFiles()[0].rsplit("/", 1)[0]
    written = {}

    def watched(df, label):
        reads = any(f.startswith(folder) for f in df.inputFiles())
        stored = real(df, label)
        if reads:
            plan = df._jdf.queryExecution().executedPlan().toString()
            columns = [len(c.split(",")) for c in re.findall(r"FileScan parquet \[([^\]]*)\]", plan)]
            written[label] = stored.count(), columns
        return stored

    real = reports.pin
    monkeypatch.setattr(reports, "pin", watched)
    if linked:
        result = reports.dashboard(table, registry.ALL, registry.PARAMS, registry.PARETO_RANGE, VENDOR_MARK).verticals
    else:
        result = reports.vertical_report(table, registry.ALL, registry.PARAMS)
    assert set(written) == scans
    assert max(written["order-sets"][1]) <= 5
    orders = table.select("platform_order_code").distinct().count()
    assert all(rows <= orders for rows, _ in written.values())
    assert not any(f.startswith(folder) for f in result.inputFiles())


@pytest.mark.parametrize("report", [reports.vendor_report, reports.running_difference, reports.gmv_difference])
def test_joins_of_the_vendor_report_run_once(spark, monkeypatch, report):
    """Running sums count and read stored marks, so the joins that attach the totals are in one written plan."""
    joins = []

    def watched(df, label):
        joins.append((label, df._jdf.queryExecution().executedPlan().toString().count("Join ")))
        return real(df, label)

    real = reports.pin
    monkeypatch.setattr(reports, "pin", watched)
    result = report(registry.orders(spark, CHECK))
    assert [label for label, n in joins if n] == ["vendor-rows"]
    assert "Join " not in result._jdf.queryExecution().executedPlan().toString()


def test_entities_of_unknown_size_do_not_shuffle_the_order_rows(spark, setting):
    """An entity table without statistics, past the threshold as far as the optimizer can tell."""
    from dataclasses import replace

    setting("spark.sql.autoBroadcastJoinThreshold", "100k")
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", "100k")
    setting("spark.sql.defaultSizeInBytes", str(1 << 50))
    tables = registry.sources(spark, CHECK)
    unknown = spark.createDataFrame(tables.entities.rdd, tables.entities.schema)
    fact = order_fact(replace(tables, entities=unknown), registry.zones(spark, CHECK), registry.FIXTURE_PARAMS)
    plan = plan_of(fact.select("region", "gmv_eur"))
    assert not re.search(r"hashpartitioning\(entity_id#\d+, \d+\)", plan)
    expected = registry.facts(spark, CHECK).groupBy("region").count()
    assert sorted(map(repr, fact.groupBy("region").count().collect())) == sorted(map(repr, expected.collect()))
