"""Order fact: sessions enriched with delivery, platform, subscription, zone and region data."""

from __future__ import annotations

from typing import Optional

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.money import eur_name, to_eur
from orderlens.functions.orders import (
    before_vat,
    days_between,
    geo_point,
    normal_vertical_parent,
    paid_delivery_fee,
    small_order_fee,
    subscription_label,
    voucher_label,
)
from orderlens.operators.dimensions import entity_dimension
from orderlens.operators.fan_out import RowCounts
from orderlens.operators.salted import ROWS_PER_TASK, attach_lookup
from orderlens.params import BatchParams
from orderlens.session import pin
from orderlens.sources.schemas import ORDER_TABLE, Sources

# Local amounts that are only divided by the exchange rate.
PLAIN_AMOUNTS = (
    "dps_surge_fee_local",
    "dps_travel_time_fee_local",
    "dps_delivery_fee_local",
    "delivery_fee_local",
    "dps_last_non_zero_df_local",
    "dps_standard_fee_local",
    "gfv_local",
    "gmv_local",
    "customer_paid_local",
    "commission_local",
    "joker_vendor_fee_local",
    "delivery_costs_local",
    "joker_customer_discount_local",
    "discount_dh_local",
    "discount_other_local",
    "voucher_dh_local",
    "voucher_other_local",
)

GEO_COLUMNS = ("zone_shape", "customer_location")
FREE_FLAG = "is_free_delivery_subscription_order"


def filter_sessions(sessions: DataFrame, params: BatchParams) -> DataFrame:
    """Chosen entities inside the inclusive date window; both predicates reach the scan."""
    return sessions.filter(
        F.col("entity_id").isin(*params.entity_ids)
        & F.col("created_date").between(F.lit(params.start_date), F.lit(params.end_date))
    )


def platform_orders_with_subscription(sources: Sources, params: BatchParams) -> DataFrame:
    """Platform orders with the free-delivery flag of either subscription table.

    The subscription keys come from the platform order, so both joins run here on narrow rows.
    Joined to the sessions instead, every session without a platform order would carry a NULL
    key into one and the same partition.
    """
    keys = ["uuid", "created_date_utc"]
    orders = sources.platform_orders.filter(
        F.col("global_entity_id").isin(*params.entity_ids)
        & F.col("created_date_utc").between(F.lit(params.start_date), F.lit(params.end_date))
    )
    apac = sources.subs_apac.select(*keys, F.col(FREE_FLAG).alias("apac_flag"))
    eu = sources.subs_eu.select(*keys, F.col(FREE_FLAG).alias("eu_flag"))
    return (
        orders
        .join(apac, keys, "left")
        .join(eu, keys, "left")
        .select(
            F.col("global_entity_id").alias("entity_id"),
            F.col("code").alias("platform_order_code"),
            F.col("created_date_utc").alias("created_date"),
            F.col("delivery_fee_local").alias("platform_fee"),
            (F.col("delivery_fee_vat_rate") / 100).alias("delivery_fee_vat_rate_pd"),
            F.coalesce("apac_flag", "eu_flag").alias(FREE_FLAG),
        )
    )


def delivery_order_details(sources: Sources, params: BatchParams) -> DataFrame:
    """Delivery-side struct fields under flat names, one projection away from the scan."""
    return (
        sources.delivery_orders
        .filter(F.col("global_entity_id").isin(*params.entity_ids))
        .select(
            F.col("global_entity_id").alias("entity_id"),
            F.col("order_id").alias("platform_order_code"),
            F.col("delivery_location.longitude").alias("longitude"),
            F.col("delivery_location.latitude").alias("latitude"),
            F.col("value.mov_customer_fee_local").alias("sof_local_cdwh"),
        )
    )


ZONE_KEY = ["entity_id", "country_code", "zone_id"]


def join_sources(
    sources: Sources, zones: DataFrame, params: BatchParams, counts: Optional[RowCounts] = None,
    zone_rows_per_task: int = ROWS_PER_TASK, platform: Optional[DataFrame] = None,
) -> DataFrame:
    """Sessions with every looked-up column; a repeated key on the right repeats the session.

    ``platform`` holds the platform orders with their subscription, if a caller has them stored. ``counts`` counts the rows after each join. ``zones`` is a stored table; its polygons may make it too large to
    broadcast, and then hot zones are salted by their number of sessions.

    The join on two order keys comes before the one on those keys plus the date, so both can
    use one layout of the session rows. Entities need no scan of the sessions here: joining
    them to sessions already drops those without any. They are cut to the chosen ones and stored
    first: a table of a few known rows is broadcast, where an estimate could have the order rows
    shuffled on the entity alone, one task for each.
    """
    regions = pin(
        entity_dimension(sources.entities).filter(F.col("entity_id").isin(*params.entity_ids))
        .select("entity_id", "region"),
        "regions")
    shapes = zones.select(*ZONE_KEY, "zone_shape")
    sessions = filter_sessions(sources.sessions, params)

    def passed(place: str, frame: DataFrame) -> DataFrame:
        return frame if counts is None else counts.at(place, frame)

    rows = passed("sessions", sessions)
    rows = passed("delivery_orders", rows.join(
        delivery_order_details(sources, params), ["entity_id", "platform_order_code"], "left"))
    flagged = platform_orders_with_subscription(sources, params) if platform is None else platform
    rows = passed("platform_orders", rows.join(
        flagged, ["entity_id", "platform_order_code", "created_date"], "left"))
    rows = passed("zones", attach_lookup(
        rows, shapes, ZONE_KEY, sessions, ["dps_sessionid", "platform_order_code", "order_placed_at"], zone_rows_per_task))
    return passed("entities", rows.join(regions, "entity_id", "inner"))


def order_fact(
    sources: Sources, zones: DataFrame, params: BatchParams, counts: Optional[RowCounts] = None,
    platform: Optional[DataFrame] = None,
) -> DataFrame:
    """All order columns that need no other order, subscription label included."""
    c = F.col
    rate = c("exchange_rate")
    covered = (c("is_delivery_fee_covered_by_discount"), c("is_delivery_fee_covered_by_voucher"))
    vat = c("delivery_fee_vat_rate_pd")

    computed = {
        "created_date_utc": c("created_date"),
        "test_id": c("experiment_id"),
        "days_since_first_order": days_between(c("order_placed_at"), c("customer_first_order_date")),
        "vendor_vertical_parent": normal_vertical_parent(c("vendor_vertical_parent")),
        "df_voucher_flag": voucher_label(*covered),
        "is_fd_subscription": subscription_label(c(FREE_FLAG)),
        "dps_delivery_fee_local_before_vat": before_vat(c("dps_delivery_fee_local"), vat),
        "dps_delivery_fee_eur_before_vat": before_vat(to_eur(c("dps_delivery_fee_local"), rate), vat),
        "actual_df_paid_by_customer_local": paid_delivery_fee(
            c("region"), c("platform_fee"), c("delivery_fee_local"), *covered),
        "actual_df_paid_by_customer_eur": paid_delivery_fee(
            c("region"), to_eur(c("platform_fee"), rate), to_eur(c("delivery_fee_local"), rate), *covered),
        "service_fee_local": F.coalesce("service_fee_local", F.lit(0.0)),
        "service_fee_eur": F.coalesce(to_eur(c("service_fee_local"), rate), F.lit(0.0)),
        "sof_local": small_order_fee(
            c("gfv_local"), c("dps_minimum_order_value_local"), c("sof_local_cdwh")),
        "sof_eur_cdwh": to_eur(c("sof_local_cdwh"), rate),
        "sof_eur": small_order_fee(
            to_eur(c("gfv_local"), rate),
            to_eur(c("dps_minimum_order_value_local"), rate),
            to_eur(c("sof_local_cdwh"), rate),
        ),
        "zone_shape": c("zone_shape"),
        "customer_location": geo_point(c("longitude"), c("latitude")),
        FREE_FLAG: c(FREE_FLAG),
    }
    for name in PLAIN_AMOUNTS:
        computed[eur_name(name)] = to_eur(c(name), rate)

    joined = join_sources(sources, zones, params, counts, platform=platform)
    available = set(joined.columns) | set(computed)
    names = [n for n in ORDER_TABLE.fieldNames() if n in available]
    return joined.select(*[
        computed.get(n, c(n)).alias(n) for n in [*names, FREE_FLAG, *GEO_COLUMNS]
    ])
