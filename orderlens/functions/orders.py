"""Column rules of the order table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Regions whose orders are recorded by the ordering platform.
PLATFORM_REGIONS = ("Europe", "Asia")


def normal_vertical_parent(raw: Column) -> Column:
    """Lower-case vertical; unknown spellings become NULL."""
    name = F.lower(raw)
    return (
        F.when(name.isin("restaurant", "restaurants"), "restaurant")
        .when(name.isin("shop", "darkstores"), name)
    )


def days_between(later: Column, earlier: Column) -> Column:
    """Day boundaries crossed, so 23:59 to 00:01 counts as one day."""
    return F.datediff(later.cast("date"), earlier.cast("date")).cast("bigint")


def geo_point(longitude: Column, latitude: Column) -> Column:
    """Point struct; NULL if a coordinate is missing, an error beyond the poles, longitude wraps."""
    wrapped = (
        F.when(longitude.between(-180, 180), longitude)
        .otherwise(F.pmod(longitude + F.lit(180.0), F.lit(360.0)) - F.lit(180.0))
    )
    point = F.struct(wrapped.alias("longitude"), latitude.alias("latitude"))
    return (
        F.when(longitude.isNull() | latitude.isNull(), None)
        .when(latitude.between(-90, 90), point)
        .otherwise(F.raise_error(F.lit("latitude out of range")).cast(
            "struct<longitude:double,latitude:double>"))
    )


def before_vat(fee: Column, vat_rate: Column) -> Column:
    return fee / (F.lit(1) + vat_rate)


def paid_delivery_fee(
    region: Column, platform_fee: Column, fee: Column, discounted: Column, vouchered: Column,
) -> Column:
    """Fee the customer paid: the platform's record where there is one, else the charged fee
    unless a discount or voucher covered it. A NULL region gives NULL."""
    charged = F.when((discounted == True) | (vouchered == True), 0.0).otherwise(fee)  # noqa: E712
    in_platform = region.isin(*PLATFORM_REGIONS)
    return F.when(in_platform, F.coalesce(platform_fee, charged)).when(~in_platform, charged)


def small_order_fee(basket: Column, minimum: Column, recorded: Column) -> Column:
    """Nothing once the basket reaches the minimum, else the recorded fee, else the shortfall."""
    return F.when(basket - minimum >= 0, 0.0).otherwise(F.coalesce(recorded, minimum - basket))


def voucher_label(discounted: Column, vouchered: Column) -> Column:
    """Unvouchered only when both flags are known to be false."""
    return (
        F.when((discounted == False) & (vouchered == False), "No DF Voucher")  # noqa: E712
        .otherwise("DF Voucher")
    )


def subscription_label(free_delivery: Column) -> Column:
    return F.when(free_delivery == True, "Y").otherwise("N")  # noqa: E712
