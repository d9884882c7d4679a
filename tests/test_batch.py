"""Batch steps on hand-written sources."""

from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from small import (
    DAY,
    DELIVERY_ORDER,
    PARAMS,
    PLATFORM_ORDER,
    SESSION,
    SUBSCRIPTION,
    sources,
    variant,
)

from orderlens.job import arguments, main
from orderlens.operators.dimensions import entity_dimension, flatten_zones
from orderlens.operators.impute import zone_average_fee
from orderlens.operators.order_fact import order_fact
from orderlens.operators.profit import PLACE_COLUMNS, vendor_aggregate
from orderlens.plans.batch import profit_orders, run_batch
from orderlens.sources.schemas import ORDER_TABLE, SOURCE_SCHEMAS
from orderlens.sources.tables import read_catalog_sources
from orderlens.sources.versions import open_table


def orders_by_code(spark, **tables):
    rows = profit_orders(sources(spark, **tables), PARAMS).collect()
    return {r.platform_order_code: r for r in rows}


def test_zones_keep_active_members_of_listed_entities(spark):
    rows = flatten_zones(sources(spark).countries, PARAMS).collect()
    assert [(r.entity_id, r.city_name, r.zone_id, r.zone_shape) for r in rows] == [
        ("FP_TW", "Taipei", 11, "POINT (1 1)")]


def test_entity_patterns(spark):
    names = ["FP_TW", "ODR_1", "ODRX", "DN_A", "DNXA", "DN", "DN1", "FP_DE", "FP_JP", "TB_SA", "HS_BH", "XX_DN_1"]
    entities = [{"region": "Asia", "platforms": [{"entity_id": n} for n in names]}]
    tables = sources(spark, entities=entities, sessions=[
        variant(SESSION, entity_id=n) for n in names if n != "XX_DN_1"])
    assert {r.entity_id for r in entity_dimension(tables.entities).collect()} == {"FP_TW", "DN", "XX_DN_1"}
    known = entity_dimension(tables.entities, tables.sessions)
    assert {r.entity_id for r in known.collect()} == {"FP_TW", "DN"}


def test_published_columns(spark):
    frame = profit_orders(sources(spark), PARAMS)
    assert [(f.name, f.dataType) for f in frame.schema] [:88] == [(f.name, f.dataType) for f in ORDER_TABLE]
    assert frame.columns[88:] == ["zone_shape", "customer_location", "is_free_delivery_subscription_order"]


def test_subscription_order(spark):
    row = orders_by_code(spark)["o1"]
    assert row.is_fd_subscription == "Y" and row.days_since_first_order == 14
    assert row.delivery_fee_vat_rate_pd == 0.2
    assert row.dps_delivery_fee_local_before_vat == 12 / 1.2
    assert row.actual_df_paid_by_customer_local == 6.0 and row.sof_local == 5.0
    assert row.revenue_local == pytest.approx(6 / 1.2 + 20 + 2 + 1 + 5)
    assert row.revenue_local_cf == pytest.approx(12 / 1.2 + 20 + 2 + 1 + 5)
    assert row.gross_profit_local == pytest.approx(18)
    assert row.gross_profit_eur_cf == pytest.approx(23 / 4)
    assert row.gmv_eur == 22.5


def test_plain_order_has_equal_counterfactual(spark):
    row = orders_by_code(spark, subs_apac=[])["o1"]
    assert row.is_fd_subscription == "N"
    assert row.revenue_local_cf == row.revenue_local and row.gross_profit_eur_cf == row.gross_profit_eur


def test_recorded_fee_counts_even_above_the_minimum(spark):
    row = orders_by_code(spark, sessions=[variant(SESSION, gfv_local=120.0)])["o1"]
    assert row.sof_local == 0.0 and row.sof_local_cdwh == 5.0
    assert row.revenue_local == pytest.approx(5 + 20 + 2 + 1 + 5)


@pytest.mark.parametrize("missing", ["commission_local", "joker_vendor_fee_local", "delivery_costs_local"])
def test_missing_part_nulls_the_profit(spark, missing):
    row = orders_by_code(spark, sessions=[variant(SESSION, **{missing: None})])["o1"]
    assert row.gross_profit_local is None and row.gross_profit_eur_cf is None


def test_missing_service_fee_is_zero(spark):
    row = orders_by_code(spark, sessions=[variant(SESSION, service_fee_local=None)])["o1"]
    assert row.service_fee_local == 0 and row.service_fee_eur == 0 and row.gross_profit_local is not None


def test_no_platform_order_means_no_profit(spark):
    row = orders_by_code(spark, platform_orders=[])["o1"]
    assert row.actual_df_paid_by_customer_local == 10.0
    assert row.is_fd_subscription == "N" and row.gross_profit_eur is None


def test_unknown_region_and_excluded_entity(spark):
    rows = orders_by_code(spark, sessions=[
        variant(SESSION, entity_id="FP_XX", platform_order_code="x"),
        variant(SESSION, entity_id="DN_YY", platform_order_code="y"),
        variant(SESSION, entity_id="FP_ZZ", platform_order_code="z"),
    ])
    assert set(rows) == {"x"}
    assert rows["x"].region is None and rows["x"].actual_df_paid_by_customer_local is None


def test_date_window_is_inclusive_and_dates_must_match(spark):
    days = [date(2022, 5, 31), date(2022, 6, 1), date(2022, 8, 31), date(2022, 9, 1)]
    rows = orders_by_code(
        spark,
        sessions=[variant(SESSION, created_date=d, platform_order_code=str(d)) for d in days],
        platform_orders=[variant(PLATFORM_ORDER, code=str(days[1])),
                         variant(PLATFORM_ORDER, code=str(days[2]), created_date_utc=days[2])],
    )
    assert set(rows) == {"2022-06-01", "2022-08-31"}
    assert rows["2022-06-01"].delivery_fee_vat_rate_pd is None
    assert rows["2022-08-31"].delivery_fee_vat_rate_pd == 0.2


def test_second_subscription_table_fills_in(spark):
    eu = variant(SUBSCRIPTION, is_free_delivery_subscription_order=True)
    assert orders_by_code(spark, subs_apac=[], subs_eu=[eu])["o1"].is_fd_subscription == "Y"
    first = variant(SUBSCRIPTION, is_free_delivery_subscription_order=False)
    assert orders_by_code(spark, subs_apac=[first], subs_eu=[eu])["o1"].is_fd_subscription == "N"


def test_null_keys_match_nothing(spark):
    rows = profit_orders(sources(
        spark,
        sessions=[variant(SESSION, platform_order_code=None), variant(SESSION, platform_order_code="other")],
        delivery_orders=[variant(DELIVERY_ORDER, order_id=None)],
        platform_orders=[variant(PLATFORM_ORDER, code=None), variant(PLATFORM_ORDER, uuid=None)],
        subs_apac=[variant(SUBSCRIPTION, uuid=None)],
    ), PARAMS).collect()
    assert len(rows) == 2
    assert all(r.sof_local_cdwh is None and r.delivery_fee_vat_rate_pd is None for r in rows)


def test_zone_with_fees_but_no_order_code_is_an_error(spark):
    with pytest.raises(PySparkException):
        orders_by_code(spark, sessions=[variant(SESSION, platform_order_code=None)])


def test_repeated_keys_repeat_the_order(spark):
    tables = sources(
        spark,
        delivery_orders=[DELIVERY_ORDER, variant(DELIVERY_ORDER, value={"mov_customer_fee_local": 7.0})],
        platform_orders=[PLATFORM_ORDER, variant(PLATFORM_ORDER, uuid="u2")],
        entities=[{"region": "Asia", "platforms": [{"entity_id": "FP_TW"}]}] * 2,
    )
    frame = profit_orders(tables, PARAMS)
    assert frame.count() == 8
    aggregate = vendor_aggregate(frame).collect()
    assert sum(r.gmv_eur for r in aggregate) == 8 * 22.5 and {r.order_count for r in aggregate} == {1}


def average_sources(spark):
    """Zone Z: three plain rows of two codes; NULL zone; a subscription row that must not count."""
    def session(code, **changes):
        return variant(SESSION, platform_order_code=code, **changes)

    codes = ["a", "b", "n", "s", "m"]
    return sources(
        spark,
        sessions=[session("a"), session("a"), session("b"), session("s"),
                  session("n", zone_name=None, zone_id=None),
                  session("m", zone_name=None, dps_delivery_fee_local=None),
                  session("q", dps_delivery_fee_local=None),
                  session(None, zone_name="only nulls", is_delivery_fee_covered_by_voucher=None,
                          delivery_fee_local=None)],
        platform_orders=[variant(PLATFORM_ORDER, code=c, uuid=c, delivery_fee_local=float(i + 1))
                         for i, c in enumerate(codes)],
        subs_apac=[variant(SUBSCRIPTION, uuid=u) for u in ("s", "m")],
    )


def test_zone_average_per_distinct_order(spark):
    tables = average_sources(spark)
    averages = zone_average_fee(order_fact(tables, flatten_zones(tables.countries, PARAMS), PARAMS)).collect()
    by_zone = {r.zone_name: (r.avg_actual_df_paid_local_impute, r.avg_actual_df_paid_eur_impute) for r in averages}
    # Z: codes a (1.0 twice), b (2.0), q (no platform order, charged 10.0) -> 14 over three orders
    assert by_zone["Z"] == pytest.approx((14 / 3, 14 / 3 / 4), abs=1e-12)
    assert by_zone[None] == (3.0, 0.75)
    assert by_zone["only nulls"] == (None, None)


def test_impute_takes_the_average_only_without_a_quoted_fee(spark):
    rows = {r.platform_order_code: r for r in profit_orders(average_sources(spark), PARAMS).collect()}
    assert rows["m"].dps_delivery_fee_local_before_vat == 3.0
    assert rows["q"].dps_delivery_fee_local_before_vat == pytest.approx(14 / 3, abs=1e-12)
    assert rows["a"].dps_delivery_fee_local_before_vat == 10.0
    assert rows["m"].revenue_local_cf == pytest.approx(3 + 20 + 2 + 1 + 20)


def test_fee_without_vat_rate_stays_null(spark):
    row = orders_by_code(spark, platform_orders=[variant(PLATFORM_ORDER, delivery_fee_vat_rate=None)])["o1"]
    assert row.dps_delivery_fee_local == 12.0 and row.dps_delivery_fee_local_before_vat is None


def test_zero_exchange_rate_is_an_error(spark):
    with pytest.raises(PySparkException):
        orders_by_code(spark, sessions=[variant(SESSION, exchange_rate=0.0)])


def test_aggregate_drops_rows_without_profit_and_keeps_null_keys(spark):
    tables = sources(spark, sessions=[
        SESSION, variant(SESSION, vendor_id=None), variant(SESSION, commission_local=None)])
    rows = vendor_aggregate(profit_orders(tables, PARAMS)).collect()
    assert {(r.vendor_id, r.order_count, r.gmv_eur) for r in rows} == {("v1", 1, 22.5), (None, 1, 22.5)}


def test_run_batch_replaces_whole_tables(spark, tmp_path):
    two = sources(spark, sessions=[SESSION, variant(SESSION, created_date=date(2022, 7, 1))])
    run_batch(two, PARAMS, str(tmp_path))
    tables = run_batch(sources(spark), PARAMS, str(tmp_path))
    assert tables.orders.count() == 1 and tables.zones.count() == 1 and tables.vendors.count() == 1
    assert tables.orders.columns == [*ORDER_TABLE.fieldNames(), *PLACE_COLUMNS]
    stored = open_table(spark, f"{tmp_path}/orders")
    assert [str(r[0]) for r in stored.select("created_date_utc").collect()] == [str(DAY)]


def test_job_arguments():
    args = arguments(["--sources", "in", "--output", "out", "--start", "2022-07-01"])
    assert args.end == "2022-08-31" and len(args.entities) == 8


def test_job(spark, tmp_path):
    tables = sources(spark)
    for name in SOURCE_SCHEMAS:
        getattr(tables, name).write.parquet(f"{tmp_path}/in/{name}")
    main(["--sources", f"{tmp_path}/in", "--output", f"{tmp_path}/out", "--entities", "FP_TW"])
    row = open_table(spark, f"{tmp_path}/out/vendors").first()
    assert (row.region, row.vendor_id, row.is_fd_subscription, row.order_count) == ("Asia", "v1", "Y", 1)
    assert row.gross_profit_eur == pytest.approx(18 / 4)


def test_job_over_catalog_tables(spark, tmp_path):
    """Sources and results by name; dates and entities are typed parameters of the SQL."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS orderlens_raw LOCATION '{tmp_path}/raw'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS orderlens_out LOCATION '{tmp_path}/db'")
    try:
        tables = sources(spark, sessions=[SESSION, variant(SESSION, created_date=date(2022, 9, 30)), variant(SESSION, entity_id="FP'; --")])
        for name in SOURCE_SCHEMAS:
            getattr(tables, name).write.saveAsTable(f"orderlens_raw.{name}")
        names = [part for name in SOURCE_SCHEMAS for part in ("--table", f"{name}=orderlens_raw.{name}")]
        for _ in range(2):
            main([*names, "--output", f"{tmp_path}/out", "--database", "orderlens_out", "--entities", "FP_TW", "FP'; --"])
            row = spark.table("orderlens_out.vendors").first()
            assert (row.region, row.vendor_id, row.order_count) == ("Asia", "v1", 1)
            assert spark.table("orderlens_out.orders").count() == 1 == open_table(spark, f"{tmp_path}/out/orders").count()
            assert spark.table("orderlens_out.orders").schema == open_table(spark, f"{tmp_path}/out/orders").schema
        read = read_catalog_sources(spark, {n: f"orderlens_raw.{n}" for n in SOURCE_SCHEMAS}, PARAMS)
        assert [str(r.created_date) for r in read.sessions.collect()] == [str(DAY)]
        plan = read.sessions._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThanOrEqual(created_date,2022-06-01)" in plan
        with pytest.raises(ValueError):
            read_catalog_sources(spark, {"sessions": "orderlens_raw.sessions"})
    finally:
        spark.sql("DROP DATABASE orderlens_raw CASCADE")
        spark.sql("DROP DATABASE orderlens_out CASCADE")


def test_one_special_amount_does_not_stop_the_job(spark):
    """NaN and infinite amounts stay in their own rows and totals."""
    rows = [SESSION, variant(SESSION, vendor_id="v2", gmv_local=float("nan")), variant(SESSION, vendor_id="v3", gmv_local=float("inf")),
            variant(SESSION, vendor_id="v4", dps_delivery_fee_local=None, delivery_fee_local=float("inf"))]
    orders = profit_orders(sources(spark, sessions=rows), PARAMS)
    got = {r.vendor_id: r for r in vendor_aggregate(orders).collect()}
    assert got["v1"].gmv_eur == 22.5 and got["v2"].gmv_eur != got["v2"].gmv_eur and got["v3"].gmv_eur == float("inf")
    assert zone_average_fee(orders).count() == 1


def test_one_hot_key_is_split(spark, setting):
    """A third of the sessions share one order key; the join splits it and keeps every row."""
    from conftest import CHECK
    from dataclasses import replace
    from orderlens.checks import registry
    from orderlens.session import pin

    setting("spark.sql.autoBroadcastJoinThreshold", "1k")
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", "1k")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "200k")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100k")
    tables = registry.sources(spark, CHECK)
    hot = F.pmod(F.xxhash64("dps_sessionid"), F.lit(3)) == 0
    sessions = pin(tables.sessions.withColumns({
        "platform_order_code": F.when(hot, "HOT").otherwise(F.col("platform_order_code")),
        "entity_id": F.when(hot, "FP_NATION_2").otherwise(F.col("entity_id")),
    }), "hot")
    frame = order_fact(replace(tables, sessions=sessions), registry.zones(spark, CHECK), registry.FIXTURE_PARAMS)
    expected = sessions.join(entity_dimension(tables.entities), "entity_id").count()
    assert frame.count() == expected
    run = frame.select("region", "sof_local_cdwh", "delivery_fee_vat_rate_pd", "platform_order_code")
    run._jdf.queryExecution().toRdd().count()
    assert "skew=true" in run._jdf.queryExecution().executedPlan().toString()
