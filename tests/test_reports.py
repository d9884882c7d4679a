"""Report rules on a small order table, and invariants on the given tables."""

import random
from collections import defaultdict
from datetime import date

import pytest
from conftest import CHECK
from pyspark.sql import functions as F

from orderlens.checks import registry
from orderlens.operators.filters import apply_context, filter_domains, keep_selected, member_filter
from orderlens.operators.lod import VENDOR_MARK, VERTICAL_LEVEL, mark_id, order_sets, orders_in_any, orders_per_mark
from orderlens.params import ReportParams, ViewFilters
from orderlens.plans import reports
from orderlens.sources.schemas import ORDER_TABLE

FIELDS = ("region", "entity_id", "vertical_type", "vendor_id", "platform_order_code", "gmv_eur", "gross_profit_eur")


def table(spark, rows, **constant):
    """Order table from the fields above; counterfactual profit is twice the profit."""
    named = [dict(zip(FIELDS, r)) for r in rows]
    for r in named:
        r["gross_profit_eur_cf"] = None if r["gross_profit_eur"] is None else 2 * r["gross_profit_eur"]
        r.update(constant)
    values = [tuple(r.get(f) for f in ORDER_TABLE.fieldNames()) for r in named]
    return spark.createDataFrame(values, ORDER_TABLE).coalesce(1)


# Vendor b is last in food alone but leads over both verticals; c has no profit; o5 is shared.
ROWS = [
    ("Asia", "E", "food", "a", "o1", 50.0, 5.0),
    ("Asia", "E", "food", "a", "o1", 10.0, 1.0),
    ("Asia", "E", "food", "b", "o2", 20.0, 2.0),
    ("Asia", "E", "shop", "b", "o3", 70.0, None),
    ("Asia", "E", "shop", "b", "o4", 30.0, 3.0),
    ("Asia", "E", "food", "c", "o5", 20.0, None),
    ("Asia", "E", "shop", "d", "o5", 20.0, 2.0),
    (None, "E", "food", "a", "o6", 40.0, None),
]


def test_vendor_report(spark):
    rows = reports.vendor_report_sorted(reports.vendor_report(table(spark, ROWS))).collect()
    assert [(r.vertical_type, r.vendor_id, r.pane_position) for r in rows] == [
        ("food", "b", 1), ("food", "a", 2), ("shop", "b", 1), ("shop", "d", 2)]
    food_b, food_a = rows[0], rows[1]
    # the fixed total counts vendor c, which is not shown
    assert food_b.share_of_vertical_gmv == 0.2 and food_a.share_of_vertical_gmv == 0.6
    assert food_a.running_gmv_eur == 80 and food_a.running_share_of_vertical_gmv == pytest.approx(0.8)
    assert food_a.order_count == 1 and food_a.order_count_cf_scenario == pytest.approx(0.98)
    assert food_a.gmv_eur_cf_scenario == pytest.approx(60 * 0.98)
    assert food_a.gp_diff_eur == pytest.approx(12 * 0.98 - 6)


def test_full_pane_ends_at_exactly_one(spark):
    """Shares of a tenth and the like; their rounded values would add up to just over or under 1."""
    rows = [("Asia", "E", v, f"{v}{i}", f"{v}{i}", 10.0 * (i + 1) / 3, 1.0)
            for v, n in (("food", 7), ("shop", 10), ("other", 49)) for i in range(n)]
    report = reports.vendor_report(table(spark, rows), share=(0.0, 1.0)).collect()
    assert len(report) == len(rows)
    assert sum(r.running_share_of_vertical_gmv == 1.0 for r in report) == 3


def test_share_cut_keeps_running_values(spark):
    cut = reports.vendor_report(table(spark, ROWS), share=(0.5, 0.9)).collect()
    assert {(r.vertical_type, r.vendor_id): r.running_gmv_eur for r in cut} == {
        ("food", "a"): 80.0, ("shop", "b"): 100.0}


def test_vertical_report_and_total(spark):
    rows = reports.vertical_report(table(spark, ROWS)).collect()
    lines = {r.vertical_type: r for r in rows if not r.is_total}
    total = next(r for r in rows if r.is_total)
    assert set(lines) == {"food", "shop"} and lines["shop"].pane_position == 1
    assert lines["food"].running_gmv_eur == 220 and lines["food"].running_share_of_vertical_gmv == 2.0
    # o5 is in both verticals and counts once in the total; NULL-region rows are not shown
    assert (lines["food"].order_count, lines["shop"].order_count, total.order_count) == (3, 3, 5)
    assert total.gmv_eur == 220 and total.running_gmv_eur == 220 and total.share_of_vertical_gmv is None
    assert (total.region, total.entity_id, total.vertical_type) == (None, None, None)


def test_selection_keeps_full_vertical_totals(spark):
    orders = table(spark, ROWS)
    chosen = reports.vendor_report(orders).filter("vendor_id = 'b'")
    rows = reports.vertical_report(orders, selected=chosen).collect()
    lines = {r.vertical_type: r for r in rows if not r.is_total}
    assert lines["food"].gmv_eur == 20 and lines["food"].share_of_vertical_gmv == 0.2
    assert lines["shop"].gmv_eur == 100 and lines["shop"].vertical_gmv_eur == 120
    whole = reports.vertical_report(orders, selected=chosen, selected_keys=VERTICAL_LEVEL).collect()
    assert {r.vertical_type: r.gmv_eur for r in whole if not r.is_total} == {"food": 100, "shop": 120}


def test_selection_matches_null_keys(spark):
    orders = table(spark, ROWS)
    chosen = orders.filter("region IS NULL").select(*VENDOR_MARK)
    assert [r.platform_order_code for r in keep_selected(orders, chosen, VENDOR_MARK).collect()] == ["o6"]


def test_empty_report(spark):
    none = ViewFilters(entity_id=("nobody",))
    assert reports.vendor_report(table(spark, ROWS), none).count() == 0
    rows = reports.vertical_report(table(spark, ROWS), none).collect()
    assert [(r.is_total, r.order_count, r.gmv_eur) for r in rows] == [(1, 0, None)]


def test_no_orders_gives_null_scenario(spark):
    row = reports.scenario_report(table(spark, [("Asia", "E", "food", "a", None, 5.0, 1.0)])).first()
    assert row.gmv_per_order_eur is None and row.gmv_eur_cf_scenario is None
    assert row.gp_diff_eur is None and row.order_count_cf_scenario == 0


def test_bins(spark):
    rows = [("Asia", "E", "food", v, v, g, 1.0) for v, g in
            (("a", 4999.99), ("b", 5000.0), ("c", -0.01), ("d", 0.0), ("e", 9999.0))]
    got = reports.gmv_bins(table(spark, rows + [("Asia", "E", "food", "f", "f", None, 1.0)])).collect()
    assert {r.gmv_bin: (r.gross_profit_eur, r.gross_profit_eur_cf) for r in got} == {
        -5000: (1.0, 2.0), 0: (2.0, 4.0), 5000: (2.0, 4.0)}
    wide = reports.gmv_bins(table(spark, rows), params=ReportParams(gmv_bin_size=10000)).collect()
    assert {r.gmv_bin for r in wide} == {-10000, 0}


def test_differences(spark):
    rows = {(r.vertical_type, r.vendor_id): r for r in reports.gmv_difference(table(spark, ROWS)).collect()}
    assert rows["food", "b"].pane_difference is None and rows["food", "a"].pane_difference == 40
    assert rows["shop", "b"].pane_difference is None and rows["shop", "b"].table_difference == 40
    across = {(r.vertical_type, r.vendor_id): r for r in reports.running_difference(table(spark, ROWS)).collect()}
    assert across["food", "b"].running_difference is None
    assert across["shop", "b"].running_difference == 100 - 20


def test_measure_rows_are_in_shown_order(spark):
    report = reports.vendor_report(table(spark, ROWS))
    rows = reports.measure_rows(report, VENDOR_MARK).collect()
    assert len(rows) == 4 * 10
    assert [m for _, m in sorted({(r.measure_index, r.measure) for r in rows})] == list(reports.REPORT_MEASURES)


def test_visual_totals(spark):
    row = reports.visual_totals(table(spark, ROWS)).first()
    assert row.order_count_of_marks == 6 and row.order_count_recomputed == 5
    assert row.gmv_eur_of_marks == row.gmv_eur_recomputed == 220
    assert row.gross_profit_eur_cf_of_marks == row.gross_profit_eur_cf_recomputed == 26


def test_dashboard_cut_reaches_verticals_only_by_selection(spark):
    orders, cut = table(spark, ROWS), (0.5, 0.9)
    plain = reports.dashboard(orders, share=cut)
    linked = reports.dashboard(orders, share=cut, selected_keys=VENDOR_MARK)
    assert plain.vendors.count() == linked.vendors.count() == 2
    assert {r.gmv_eur for r in plain.verticals.collect() if not r.is_total} == {100, 120}
    assert {r.gmv_eur for r in linked.verticals.collect() if not r.is_total} == {60, 100}


def test_drill_levels(spark):
    orders = table(spark, ROWS[:2], country_code="tw", city_name=None)
    rows = reports.drill_down(orders).collect()
    assert sorted((r.level, r.country_code, r.gmv_eur) for r in rows[:2] + rows[2:] if r.level < 3) == [
        (0, "tw", 60.0), (1, "tw", 60.0)]
    assert [r.gmv_eur for r in rows if r.level == 3] == [60.0]


def test_members_and_dates(spark):
    frame = spark.createDataFrame([("a",), ("b",), (None,)], "x string")

    def kept(members):
        return {r.x for r in frame.filter(member_filter(F.col("x"), members)).collect()}

    assert kept(["a"]) == {"a"} and kept([None]) == {None} and kept(["b", None]) == {"b", None} and kept([]) == set()
    assert frame.filter(~member_filter(F.col("x"), ["a"])).count() == 2
    dated = table(spark, ROWS[:1], created_date_utc=date(2022, 8, 31))
    assert apply_context(dated, ViewFilters(created_date_utc=("2022-06-01", "2022-08-31"))).count() == 1
    assert apply_context(dated, ViewFilters(created_date_utc=("2022-06-01", "2022-08-30"))).count() == 0


def test_domains_ignore_their_own_filter(spark):
    filters = ViewFilters(vertical_type=("shop",), entity_id=("E",), region=("Asia",))
    rows = filter_domains(table(spark, ROWS), filters, ["vertical_type", "entity_id"]).collect()
    assert {tuple(r) for r in rows} == {("vertical_type", "food"), ("vertical_type", "shop"), ("entity_id", "E")}


# ------------------------------------------------------------------ invariants on the given tables


@pytest.fixture(scope="module")
def orders(spark):
    return registry.orders(spark, CHECK)


def test_last_running_value_is_the_pane_total(orders):
    rows = reports.vendor_report(orders, ViewFilters(region=("Asia", "Europe"))).collect()
    panes = defaultdict(list)
    for r in rows:
        panes[r.region, r.entity_id, r.vertical_type].append(r)
    for pane in panes.values():
        last = max(pane, key=lambda r: r.pane_position)
        assert last.running_gmv_eur == pytest.approx(sum(r.gmv_eur for r in pane))
        assert last.running_share_of_vertical_gmv <= 1 + 1e-9
        assert [r.pane_position for r in sorted(pane, key=lambda r: r.pane_position)] == list(range(1, len(pane) + 1))


def test_no_drop_keeps_gmv(orders):
    for r in reports.vendor_report(orders, params=ReportParams(order_drop=0.0)).collect():
        assert r.gmv_eur_cf_scenario == pytest.approx(r.gmv_eur)


def test_bins_add_up(orders):
    binned = sum(r.gross_profit_eur for r in reports.gmv_bins(orders).collect())
    assert binned == pytest.approx(orders.agg(F.sum("gross_profit_eur")).first()[0])


def test_plain_orders_have_equal_counterfactual(orders):
    assert orders.filter("is_fd_subscription = 'N' AND NOT gross_profit_eur_cf <=> gross_profit_eur").count() == 0
    assert orders.filter("is_fd_subscription = 'Y' AND gross_profit_eur_cf <> gross_profit_eur").count() > 0


def test_total_orders_do_not_exceed_their_parts(orders):
    rows = reports.vertical_report(orders).collect()
    parts = sum(r.order_count for r in rows if not r.is_total)
    assert next(r.order_count for r in rows if r.is_total) <= parts


def test_order_sets_count_any_choice_of_marks(spark):
    """Distinct orders of marks and of unions of marks, with NULL keys, repeated codes and NULL codes."""
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), rng.choice(["x", "y", None]), rng.choice([None, *map(str, range(60))])) for _ in range(400)]
    frame = spark.createDataFrame(rows, "k string, l string, platform_order_code string").repartition(5)
    keys = ["k", "l"]
    sets = order_sets(frame, keys)
    marks_ = frame.select(*keys).distinct().withColumn("mark_id", mark_id(keys))
    counts = {(r.k, r.l): r.order_count for r in marks_.join(orders_per_mark(sets), "mark_id", "left").collect()}
    codes = {m: {c for k, l, c in rows if (k, l) == m and c} for m in counts}
    assert counts == {m: len(c) for m, c in codes.items()} and len(counts) == 9
    for n in (0, 1, 4, 9):
        chosen = rng.sample(sorted(codes, key=str), n)
        shown = marks_.filter(F.concat_ws("|", F.coalesce("k", F.lit("-")), F.coalesce("l", F.lit("-"))).isin(
            [f"{k or '-'}|{l or '-'}" for k, l in chosen] or ["?"]))
        assert orders_in_any(sets, shown).first()[0] == len(set().union(*(codes[c] for c in chosen)))
    # States over disjoint codes add up.
    parts = [order_sets(frame.filter(F.col("platform_order_code") % 2 == i), keys) for i in (0, 1)]
    assert sorted(map(repr, parts[0].unionAll(parts[1]).groupBy("marks").sum("orders").collect())) == sorted(
        repr(r).replace("orders=", "sum(orders)=") for r in sets.collect())
