"""The batch job: sources to order table to vendor aggregate."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Optional, Sequence

from pyspark.sql import DataFrame

from orderlens.operators.dimensions import flatten_zones
from orderlens.operators.fan_out import RowCounts, join_key_report
from orderlens.operators.impute import attach_zone_average, impute_fees, zone_average_fee
from orderlens.operators.order_fact import order_fact, platform_orders_with_subscription
from orderlens.operators.profit import add_profit, order_table, vendor_aggregate
from orderlens.params import BatchParams
from orderlens.session import pin
from orderlens.sources.schemas import Sources
from orderlens.sources.tables import publish_table
from orderlens.sources.versions import publish as publish_folder


def imputed_orders(
    sources: Sources, params: BatchParams, zones: Optional[DataFrame] = None, counts: Optional[RowCounts] = None,
) -> DataFrame:
    """Order fact with zone averages and filled-in fees.

    The averages are pinned first. Their pass reads only the columns it needs, and the wide
    rows then meet a table of known size: broadcast while that is small, with no shuffle of the
    order rows on a zone key that may be hot, and a sort-merge join beyond the threshold.

    Both passes look up the platform orders with their subscription, which are joined and stored once.
    """
    zones = pin(flatten_zones(sources.countries, params), "zones") if zones is None else zones
    platform = pin(platform_orders_with_subscription(sources, params), "platform-orders")
    averages = pin(zone_average_fee(order_fact(sources, zones, params, platform=platform)), "zone-fees")
    # Rows are counted in the wide pass; the narrow one stays free to drop columns.
    fact = order_fact(sources, zones, params, counts, platform)
    return impute_fees(attach_zone_average(fact, averages))


def profit_orders(
    sources: Sources, params: BatchParams, zones: Optional[DataFrame] = None, counts: Optional[RowCounts] = None,
) -> DataFrame:
    """One lazy plan from the sources to the 91 published columns."""
    return order_table(add_profit(imputed_orders(sources, params, zones, counts)))


@dataclass(frozen=True)
class BatchTables:
    zones: DataFrame
    orders: DataFrame
    vendors: DataFrame
    #: Order rows after each join, and the repeated keys of the right sides if a join made more of them.
    join_rows: dict[str, int]
    repeated_keys: Optional[DataFrame]


def run_batch(
    sources: Sources, params: BatchParams, folder: str,
    partition_orders_by: Sequence[str] = ("created_date_utc",), database: Optional[str] = None,
) -> BatchTables:
    """Write the zone, order and vendor tables under ``folder``, each replaced as a whole.

    If a join made more rows of the sessions, the repeated keys are reported under ``repeated_keys``. With a
    ``database`` the catalog there names the tables too.
    """
    def publish(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
        name = path.rsplit("/", 1)[1]
        return publish_table(df, f"{database}.{name}", path, partition_by) if database else publish_folder(df, path, partition_by)

    zones = publish(flatten_zones(sources.countries, params), f"{folder}/zones")
    counts = RowCounts()
    orders = publish(profit_orders(sources, params, zones, counts), f"{folder}/orders", partition_orders_by)
    vendors = publish(vendor_aggregate(orders, stored=True), f"{folder}/vendors")
    repeated = publish(join_key_report(sources, zones), f"{folder}/repeated_keys") if counts.multiplied() else None
    return BatchTables(zones, orders, vendors, counts.rows(), repeated)
