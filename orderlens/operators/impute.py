"""Zone averages of the paid delivery fee, and the fees they stand in for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.money import PARTS, added, money_parts, total_of_parts

ZONE_KEYS = ("entity_id", "zone_name")
UNITS = ("local", "eur")


def zone_average_fee(orders: DataFrame) -> DataFrame:
    """Fee paid per distinct order, over non-subscription orders with a known fee, by zone.

    Rows are first reduced to one per order code, which spreads a busy zone over all tasks and
    turns the two conditional distinct counts into plain counts. Rows already laid out by order
    code need no shuffle for that. A NULL zone is a zone.
    """
    def known(unit: str) -> Column:
        paid = F.col(f"actual_df_paid_by_customer_{unit}")
        return (F.col("is_fd_subscription") == "N") & paid.isNotNull()

    first = []
    for unit in UNITS:
        fee = F.when(known(unit), F.col(f"actual_df_paid_by_customer_{unit}"))
        first += [part.alias(f"{name}_{unit}") for name, part in zip(PARTS, added(money_parts(fee)))]
        first.append(F.max(known(unit)).alias(f"known_{unit}"))
    per_code = orders.groupBy(*ZONE_KEYS, "platform_order_code").agg(*first)

    has_code = F.col("platform_order_code").isNotNull()
    per_zone = per_code.groupBy(*ZONE_KEYS).agg(
        *[total_of_parts(*added([F.col(f"{name}_{u}") for name in PARTS])).alias(f"fees_{u}") for u in UNITS],
        *[F.count_if(has_code & F.col(f"known_{u}")).alias(f"orders_{u}") for u in UNITS],
    )
    return per_zone.select(*ZONE_KEYS, *[
        (F.col(f"fees_{u}") / F.col(f"orders_{u}")).alias(f"avg_actual_df_paid_{u}_impute")
        for u in UNITS
    ])


def attach_zone_average(orders: DataFrame, averages: DataFrame) -> DataFrame:
    """Join the averages back to the order rows, NULL zones included."""
    keyed = averages.select(
        F.col("entity_id").alias("avg_entity_id"),
        F.col("zone_name").alias("avg_zone_name"),
        *[f"avg_actual_df_paid_{u}_impute" for u in UNITS],
    )
    return orders.join(
        keyed,
        (F.col("entity_id") == F.col("avg_entity_id"))
        & F.col("zone_name").eqNullSafe(F.col("avg_zone_name")),
        "left",
    ).drop("avg_entity_id", "avg_zone_name")


def missing_fee_update() -> tuple[Column, dict[str, Column]]:
    """Condition and assignments by which the zone average takes the place of a missing quoted fee.

    The test is on the quoted fee itself: a row with a fee but no VAT rate keeps its NULL.
    """
    return F.col("dps_delivery_fee_local").isNull(), {
        f"dps_delivery_fee_{u}_before_vat": F.col(f"avg_actual_df_paid_{u}_impute") for u in UNITS}


def impute_fees(orders: DataFrame) -> DataFrame:
    """Take the zone average where the quoted fee is missing, in rows on their way into a table."""
    missing, assignments = missing_fee_update()
    return orders.withColumns({n: F.when(missing, v).otherwise(F.col(n)) for n, v in assignments.items()})
