"""Reports over the published order table."""

from __future__ import annotations

from typing import Mapping, NamedTuple, Optional, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.money import MONEY, as_double, exact_total, ratio
from orderlens.operators.filters import (
    apply_context,
    keep_known_measures,
    keep_selected,
    share_range,
)
from orderlens.operators.lod import (
    MEASURES,
    VENDOR_LEVEL,
    VENDOR_MARK,
    VERTICAL_LEVEL,
    attach,
    counted,
    marks,
    order_sets,
    orders_in_any,
    roll_up,
    roll_up_sums,
    sums,
)
from orderlens.operators.running import ROWS_PER_TASK, previous, running
from orderlens.params import DEFAULT_RUNNING_SHARE_RANGE, ReportParams, ViewFilters
from orderlens.session import pin

# The ten measures of the vendor and vertical reports, in shown order.
REPORT_MEASURES = (
    "gmv_eur",
    "running_gmv_eur",
    "share_of_vertical_gmv",
    "running_share_of_vertical_gmv",
    "gmv_eur_cf_scenario",
    "gross_profit_eur",
    "gross_profit_eur_cf_scenario",
    "gp_diff_eur",
    "order_count",
    "order_count_cf_scenario",
)

ALL_ROWS = ViewFilters()
VERTICAL_GMV = "vertical_gmv_eur"
VENDOR_TOTAL = "vendor_total_gmv_eur"


def scenario_columns(params: ReportParams) -> Mapping[str, Column]:
    """What-if measures of one mark. Per-order values come first, so no orders gives NULL."""
    orders, kept = F.col("order_count"), F.lit(1.0) - F.lit(params.order_drop)
    gmv_per_order = ratio(as_double(F.col("gmv_eur")), orders)
    profit_per_order = ratio(as_double(F.col("gross_profit_eur_cf")), orders)
    profit_scenario = profit_per_order * orders * kept
    return {
        "gmv_per_order_eur": gmv_per_order,
        "gpo_cf_eur": profit_per_order,
        "gmv_eur_cf_scenario": gmv_per_order * orders * kept,
        "gross_profit_eur_cf_scenario": profit_scenario,
        "order_count_cf_scenario": orders * kept,
        "gp_diff_eur": profit_scenario - as_double(F.col("gross_profit_eur")),
    }


def _doubles(marked: DataFrame) -> DataFrame:
    return marked.withColumns({
        f.name: as_double(F.col(f.name))
        for f in marked.schema if f.dataType.typeName() == "decimal"
    })


def scenario_report(
    orders: DataFrame, filters: ViewFilters = ALL_ROWS, params: ReportParams = ReportParams(),
    keys: Sequence[str] = VENDOR_MARK,
) -> DataFrame:
    """Per-order values and what-if measures per mark."""
    marked = keep_known_measures(marks(apply_context(orders, filters), keys))
    return marked.select(*keys, *[v.alias(n) for n, v in scenario_columns(params).items()])


def fixed_totals(
    orders: DataFrame, level: Sequence[str], name: str, filters: ViewFilters = ALL_ROWS,
) -> DataFrame:
    """GMV fixed at ``level`` over the context rows, with the number of orders rows it covers."""
    totals = apply_context(orders, filters).groupBy(*level).agg(
        exact_total(F.col("gmv_eur")).alias(name),
        F.count(F.lit(1)).alias("order_rows"),
    )
    return totals


def vendor_order() -> Sequence[Column]:
    """Vendors by their GMV over the whole report, not just the pane; ties by id."""
    return (F.col(VENDOR_TOTAL).desc_nulls_last(), F.col("vendor_id").asc_nulls_first())


def context_marks(orders: DataFrame, filters: ViewFilters) -> DataFrame:
    """All vendor marks of the context rows, stored, as several totals come from them."""
    return pin(marks(apply_context(orders, filters), VENDOR_MARK), "vendor-marks")


def vendor_marks(
    orders: DataFrame, filters: ViewFilters = ALL_ROWS, stored: Optional[DataFrame] = None,
) -> DataFrame:
    """Marks of the vendor report, with the fixed vertical total and the vendor's sort total.

    The order rows are read once, or not at all if their marks are ``stored`` already; totals come
    from the marks. The vertical total counts marks the non-null filter drops, the sort total only
    those shown.
    """
    all_marks = context_marks(orders, filters) if stored is None else stored
    shown = keep_known_measures(all_marks)
    with_vertical = attach(shown, roll_up(all_marks, VERTICAL_LEVEL, VERTICAL_GMV), VERTICAL_LEVEL, VERTICAL_GMV)
    return attach(with_vertical, roll_up(shown, ["vendor_id"], VENDOR_TOTAL), ["vendor_id"], VENDOR_TOTAL)


def _share(gmv: str) -> Column:
    return ratio(as_double(F.col(gmv)), as_double(F.col(VERTICAL_GMV)))


def vendor_report(
    orders: DataFrame, filters: ViewFilters = ALL_ROWS, params: ReportParams = ReportParams(),
    share: Optional[tuple] = None, stored: Optional[DataFrame] = None,
) -> DataFrame:
    """Vendor rows: keys, position in the pane, ten measures.

    All shares of a pane have one denominator, so their running sum is the running GMV over it;
    that way a full pane ends at exactly 1. ``share`` cuts on the running share once computed.
    """
    marked = pin(
        vendor_marks(orders, filters, stored).withColumn("share_of_vertical_gmv", _share("gmv_eur")), "vendor-rows")
    summed = running(
        marked, VERTICAL_LEVEL, vendor_order(), {"running_gmv_eur": F.col("gmv_eur")}, position="pane_position",
    ).withColumn("running_share_of_vertical_gmv", _share("running_gmv_eur"))
    measured = _doubles(summed.withColumns(dict(scenario_columns(params))))
    if share is not None:
        measured = share_range(measured, "running_share_of_vertical_gmv", *share)
    return measured.select(*VENDOR_MARK, "pane_position", *REPORT_MEASURES)


def vendor_report_sorted(report: DataFrame) -> DataFrame:
    """Display order of the vendor report."""
    return report.orderBy(*[F.col(k).asc_nulls_first() for k in VERTICAL_LEVEL], "pane_position")


def pareto_report(
    orders: DataFrame, filters: ViewFilters = ALL_ROWS, params: ReportParams = ReportParams(),
    share: tuple = DEFAULT_RUNNING_SHARE_RANGE,
) -> DataFrame:
    return vendor_report(orders, filters, params, share)


def measure_rows(report: DataFrame, keys: Sequence[str], measures: Sequence[str] = REPORT_MEASURES) -> DataFrame:
    """One row per mark and measure, numbered in shown order."""
    entries = F.array(*[
        F.struct(
            F.lit(i).alias("measure_index"),
            F.lit(m).alias("measure"),
            F.col(m).cast("double").alias("value"),
        )
        for i, m in enumerate(measures, start=1)
    ])
    return report.select(*keys, F.inline(entries))


def _vertical_rows(
    orders: DataFrame, filters: ViewFilters, params: ReportParams,
    selected: Optional[DataFrame] = None, selected_keys: Sequence[str] = VENDOR_MARK,
    rows_per_task: int = ROWS_PER_TASK, stored: Optional[DataFrame] = None,
) -> DataFrame:
    """Vertical marks and their total with every measure, sums still decimal.

    Distinct orders come from the order sets of the verticals, read from two narrow columns; sums are rolled up
    from vendor marks where a selection needs these, or added up as they are read. Nothing as fine as
    an order is stored.

    The selection applies after the fixed vertical totals, so shares stay shares of the full
    vertical; without one the marks are those totals. The total counts the orders of the sets that
    have any shown vertical.
    """
    context = apply_context(orders, filters)
    if selected is None:
        rows, summed = context, sums(context, VERTICAL_LEVEL).withColumn(VERTICAL_GMV, F.col("gmv_eur"))
    else:
        vendors = context_marks(orders, filters) if stored is None else stored
        rows = keep_selected(context, selected, selected_keys)
        chosen = roll_up_sums(keep_selected(vendors, selected, selected_keys), VERTICAL_LEVEL)
        summed = attach(chosen, roll_up(vendors, VERTICAL_LEVEL, VERTICAL_GMV), VERTICAL_LEVEL, VERTICAL_GMV)
    sets = pin(order_sets(rows, VERTICAL_LEVEL), "order-sets")
    with_totals = counted(summed, sets, VERTICAL_LEVEL)
    shown = pin(keep_known_measures(with_totals), "shown-verticals")

    lines = running(
        shown.withColumn("share_of_vertical_gmv", _share("gmv_eur")),
        ["region", "entity_id"],
        [F.col("gmv_eur").desc_nulls_last(), F.col("vertical_type").asc_nulls_first()],
        {
            "running_gmv_eur": F.col("gmv_eur"),
            "running_share_of_vertical_gmv": F.col("share_of_vertical_gmv").cast("decimal(30,15)"),
        },
        position="pane_position", rows_per_task=rows_per_task,
    ).withColumn("is_total", F.lit(0))

    total_orders = orders_in_any(sets, shown)
    total_sums = shown.agg(
        *[F.sum(m).alias(m) for m in (*MEASURES, VERTICAL_GMV)],
        F.sum("gmv_eur").alias("running_gmv_eur"),
    )
    both = total_sums.unionByName(total_orders, allowMissingColumns=True)
    total = both.agg(*[F.max(c).alias(c) for c in both.columns]).withColumn("is_total", F.lit(1))
    combined = lines.unionByName(total, allowMissingColumns=True)
    return combined.withColumns(dict(scenario_columns(params)))


def vertical_report(
    orders: DataFrame, filters: ViewFilters = ALL_ROWS, params: ReportParams = ReportParams(),
    selected: Optional[DataFrame] = None, selected_keys: Sequence[str] = VENDOR_MARK,
    rows_per_task: int = ROWS_PER_TASK, stored: Optional[DataFrame] = None,
) -> DataFrame:
    """Vertical rows and a grand total, optionally for rows selected in the vendor report.

    ``is_total`` tells the total row from a row with NULL keys.
    """
    measured = _doubles(_vertical_rows(orders, filters, params, selected, selected_keys, rows_per_task, stored))
    return measured.select(*VERTICAL_LEVEL, "is_total", "pane_position", VERTICAL_GMV, *REPORT_MEASURES)


class Dashboard(NamedTuple):
    vendors: DataFrame
    verticals: DataFrame


def dashboard(
    orders: DataFrame, filters: ViewFilters = ALL_ROWS, params: ReportParams = ReportParams(),
    share: tuple = DEFAULT_RUNNING_SHARE_RANGE, selected_keys: Optional[Sequence[str]] = None,
) -> Dashboard:
    """Vendor report over vertical report, under the same filters.

    The running-share cut of the vendor report reaches the vertical one only by selecting the
    vendors it leaves, that is, when ``selected_keys`` is given.
    """
    stored = context_marks(orders, filters)
    vendors = pin(vendor_report(orders, filters, params, share, stored), "vendor-report")
    selected = None if selected_keys is None else vendors
    verticals = vertical_report(orders, filters, params, selected, selected_keys or VENDOR_MARK, stored=stored)
    return Dashboard(vendors, verticals)


# The measures that also have a total adding up what is shown.
VISUAL_TOTAL_MEASURES = ("order_count", "gmv_eur", "gross_profit_eur", "gross_profit_eur_cf", "gp_diff_eur")


def visual_totals(orders: DataFrame, filters: ViewFilters = ALL_ROWS, params: ReportParams = ReportParams()) -> DataFrame:
    """Totals as the sum of the shown vertical marks, next to the totals recomputed from rows."""
    rows = _vertical_rows(orders, filters, params)
    rows = rows.withColumn("gp_diff_eur", F.col("gp_diff_eur").cast(MONEY))
    mark, total = F.col("is_total") == 0, F.col("is_total") == 1
    return _doubles(rows.agg(*[
        column
        for m in VISUAL_TOTAL_MEASURES for column in (
            F.sum(F.when(mark, F.col(m))).alias(f"{m}_of_marks"),
            F.max(F.when(total, F.col(m))).alias(f"{m}_recomputed"),
        )
    ]))


def average_profit_cf(orders: DataFrame, keys: Sequence[str], filters: ViewFilters = ALL_ROWS) -> DataFrame:
    """Plain average of counterfactual profit over order rows."""
    profit = F.col("gross_profit_eur_cf")
    return apply_context(orders, filters).groupBy(*keys).agg(
        ratio(exact_total(profit), F.count(profit)).alias("avg_gross_profit_eur_cf"))


def gmv_bins(orders: DataFrame, filters: ViewFilters = ALL_ROWS, params: ReportParams = ReportParams()) -> DataFrame:
    """Profit per bin of the vendor's fixed GMV.

    All rows of a vendor fall in its one bin, so vendor sums replace a join back to the rows.
    """
    vendors = sums(apply_context(orders, filters), VENDOR_LEVEL)
    size = F.lit(params.gmv_bin_size)
    bin_start = (F.floor(as_double(F.col("gmv_eur")) / size) * size).cast("bigint")
    binned = vendors.groupBy(bin_start.alias("gmv_bin")).agg(*[F.sum(m).alias(m) for m in MEASURES])
    return _doubles(keep_known_measures(binned)).select("gmv_bin", "gross_profit_eur", "gross_profit_eur_cf")


def vendor_scatter(orders: DataFrame, filters: ViewFilters = ALL_ROWS) -> DataFrame:
    marked = keep_known_measures(marks(apply_context(orders, filters), VENDOR_MARK))
    return _doubles(marked).select(*VENDOR_MARK, "order_count", *MEASURES)


def drill_down(orders: DataFrame, filters: ViewFilters = ALL_ROWS) -> DataFrame:
    """GMV at every level of country -> city; rows are summed per city before they are copied
    to the upper levels."""
    cities = sums(apply_context(orders, filters), ["country_code", "city_name"], ["gmv_eur"])
    levels = cities.rollup("country_code", "city_name").agg(
        F.grouping_id().cast("int").alias("level"), F.sum("gmv_eur").alias("gmv_eur"))
    return _doubles(levels)


def _report_order() -> Sequence[Column]:
    return (*[F.col(k).asc_nulls_first() for k in VERTICAL_LEVEL], *vendor_order())


def gmv_difference(
    orders: DataFrame, filters: ViewFilters = ALL_ROWS, rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """GMV minus that of the row above, within the pane and down the whole table."""
    marked = pin(vendor_marks(orders, filters), "vendor-rows")
    in_pane = previous(marked, VERTICAL_LEVEL, vendor_order(), {"pane_previous": "gmv_eur"}, rows_per_task)
    in_table = previous(in_pane, [], _report_order(), {"table_previous": "gmv_eur"}, rows_per_task)
    return _doubles(in_table.select(
        *VENDOR_MARK,
        "gmv_eur",
        (F.col("gmv_eur") - F.col("pane_previous")).alias("pane_difference"),
        (F.col("gmv_eur") - F.col("table_previous")).alias("table_difference"),
    ))


def running_difference(orders: DataFrame, filters: ViewFilters = ALL_ROWS) -> DataFrame:
    """Two passes: GMV running down the vendors of a vertical, then the difference of that
    running value across the verticals of the vendor, verticals standing side by side."""
    marked = pin(vendor_marks(orders, filters), "vendor-rows")
    summed = pin(
        running(marked, VERTICAL_LEVEL, vendor_order(), {"running_gmv_eur": F.col("gmv_eur")}, "pane_position"),
        "running-rows",
    )
    compared = previous(
        summed, ["region", "entity_id", "vendor_id"], [F.col("vertical_type").asc_nulls_first()],
        {"previous_vertical": "running_gmv_eur"},
    )
    return _doubles(compared.select(
        *VENDOR_MARK,
        "gmv_eur",
        "running_gmv_eur",
        (F.col("running_gmv_eur") - F.col("previous_vertical")).alias("running_difference"),
    ))
