"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from orderlens.checks import registry
from orderlens.session import tune

HEADLINE = (
    "zone_flatten",
    "entity_filter",
    "order_fact",
    "zone_avg_fee",
    "impute_update",
    "order_profit",
    "vendor_agg_metrics",
    "publish_roundtrip",
    "view_context_filters",
    "filter_domain",
    "fixed_lod_vendor",
    "fixed_lod_vertical",
    "scenario_metrics",
    "vendor_view",
    "vendor_view_subscribers",
    "vendor_view_long",
    "pareto_filter",
    "vertical_totals",
    "action_filter_totals",
    "drill_country_city",
    "gmv_bins",
    "vendor_scatter",
    "gmv_diff_prev",
    "gmv_cum_then_diff",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("orderlens-bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)

    times: dict[str, float] = {}

    def timed(name, run):
        start = time.perf_counter()
        run()
        times[name] = round(time.perf_counter() - start, 3)

    timed("source_tables", lambda: registry.sources(spark, sf_dir))
    timed("order_table", lambda: registry.orders(spark, sf_dir))
    for name in HEADLINE:
        query = registry.QUERIES[name]
        timed(name, lambda: query.frame(spark, sf_dir).write.format("noop").mode("overwrite").save())

    # The source tables stand in for stored ones, so deriving them is listed but not counted.
    total = sum(seconds for name, seconds in times.items() if name != "source_tables")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(total, 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
