"""Revenue and gross profit per order, actual and counterfactual."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.money import exact_total, to_eur, total_of_parts
from orderlens.functions.orders import before_vat
from orderlens.operators.lod import MEASURES, ORDER, marks
from orderlens.sources.schemas import ORDER_TABLE

AGGREGATE_KEYS = ("region", "entity_id", "vertical_type", "vendor_id", "is_fd_subscription")


def add_profit(orders: DataFrame) -> DataFrame:
    """Eight revenue and profit columns; any missing part makes the result NULL.

    Counterfactual: a free-delivery subscription order is priced with the quoted fee before VAT.
    """
    c = F.col

    def revenue(fee):
        extras = (
            c("commission_local"),
            c("joker_vendor_fee_local"),
            c("service_fee_local"),
            F.coalesce("sof_local_cdwh", "sof_local"),
        )
        return sum(extras, fee)

    paid = before_vat(c("actual_df_paid_by_customer_local"), c("delivery_fee_vat_rate_pd"))
    priced = orders.withColumn("revenue_local", revenue(paid))
    priced = priced.withColumn(
        "revenue_local_cf",
        F.when(c("is_fd_subscription") == "N", c("revenue_local"))
        .otherwise(revenue(c("dps_delivery_fee_local_before_vat"))),
    )
    priced = priced.withColumns({
        f"gross_profit_local{cf}": c(f"revenue_local{cf}") - c("delivery_costs_local") for cf in ("", "_cf")
    })
    return priced.withColumns({
        f"{measure}_eur{cf}": to_eur(c(f"{measure}_local{cf}"), c("exchange_rate"))
        for measure in ("revenue", "gross_profit") for cf in ("", "_cf")
    })


# Published besides the columns the reports read.
PLACE_COLUMNS = ("zone_shape", "customer_location", "is_free_delivery_subscription_order")


def order_table(priced: DataFrame) -> DataFrame:
    """The published columns: those the reports read, in published order, then three more."""
    return priced.select(*ORDER_TABLE.fieldNames(), *PLACE_COLUMNS)


def vendor_aggregate(orders: DataFrame, stored: bool = False) -> DataFrame:
    """Orders, GMV and profit per vendor and subscription flag, over orders with a known profit.

    ``stored`` orders are read twice, so that the shuffle of the order codes carries no amounts; a plan is run once.
    """
    known = orders.filter(F.col("gross_profit_eur").isNotNull())
    if stored:
        return marks(known, AGGREGATE_KEYS, total_of_parts)
    return known.groupBy(*AGGREGATE_KEYS).agg(
        F.count_distinct(ORDER).alias("order_count"), *[exact_total(F.col(m)).alias(m) for m in MEASURES])
