"""Column names and types of the source tables and of the published order table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
}


def _struct(text: str) -> T.StructType:
    """'type: name name ...' lines to a nullable schema."""
    fields = []
    for line in text.strip().splitlines():
        kind, names = line.split(":")
        fields += [T.StructField(n, _TYPES[kind.strip()]) for n in names.split()]
    return T.StructType(fields)


_PLATFORMS = T.ArrayType(T.StructType([T.StructField("entity_id", T.StringType())]))
_ZONE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("shape", T.StringType()),
    T.StructField("is_active", T.BooleanType()),
])
_CITY = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("is_active", T.BooleanType()),
    T.StructField("zones", T.ArrayType(_ZONE)),
])

COUNTRIES = T.StructType([
    T.StructField("country_code", T.StringType()),
    T.StructField("platforms", _PLATFORMS),
    T.StructField("cities", T.ArrayType(_CITY)),
])

ENTITIES = T.StructType([
    T.StructField("region", T.StringType()),
    T.StructField("country_iso", T.StringType()),
    T.StructField("country_name", T.StringType()),
    T.StructField("platforms", _PLATFORMS),
])

DELIVERY_ORDERS = T.StructType([
    T.StructField("global_entity_id", T.StringType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("delivery_location", T.StructType([
        T.StructField("longitude", T.DoubleType()),
        T.StructField("latitude", T.DoubleType()),
    ])),
    T.StructField("value", T.StructType([
        T.StructField("mov_customer_fee_local", T.DoubleType()),
    ])),
])

PLATFORM_ORDERS = _struct("""
string: global_entity_id code
date: created_date_utc
string: uuid
double: delivery_fee_local delivery_fee_vat_rate
""")

SUBSCRIPTIONS = _struct("""
string: uuid
date: created_date_utc
boolean: is_free_delivery_subscription_order
""")

SESSIONS = _struct("""
date: created_date
timestamp: order_placed_at customer_first_order_date
string: entity_id country_code city_name
bigint: city_id
string: zone_name
bigint: zone_id order_id
string: platform_order_code variant
double: experiment_id
string: perseus_client_id ga_session_id dps_sessionid dps_customer_tag
double: customer_total_orders scheme_id
string: vendor_price_scheme_type vendor_id chain_id chain_name vertical_type vendor_vertical_parent delivery_status
boolean: is_own_delivery is_delivery_fee_covered_by_discount is_delivery_fee_covered_by_voucher
double: exchange_rate
double: dps_surge_fee_local dps_travel_time_fee_local dps_delivery_fee_local delivery_fee_local
double: dps_last_non_zero_df_local dps_standard_fee_local dps_minimum_order_value_local
double: gfv_local gmv_local customer_paid_local commission_local joker_vendor_fee_local
double: service_fee_local delivery_costs_local joker_customer_discount_local
double: discount_dh_local discount_other_local voucher_dh_local voucher_other_local
""")

# The 88 columns of the published order table, in published order.
ORDER_TABLE = _struct("""
date: created_date_utc
string: region entity_id country_code city_name
bigint: city_id
string: zone_name
bigint: zone_id
string: variant
double: test_id
string: perseus_client_id ga_session_id dps_sessionid dps_customer_tag
double: customer_total_orders
timestamp: customer_first_order_date
bigint: days_since_first_order order_id
string: platform_order_code
double: scheme_id
string: vendor_price_scheme_type vendor_id chain_id chain_name vertical_type vendor_vertical_parent delivery_status
boolean: is_own_delivery
double: exchange_rate
double: dps_surge_fee_local dps_travel_time_fee_local dps_delivery_fee_local delivery_fee_local
double: delivery_fee_vat_rate_pd dps_delivery_fee_local_before_vat
double: dps_last_non_zero_df_local dps_standard_fee_local actual_df_paid_by_customer_local
double: gfv_local gmv_local customer_paid_local commission_local joker_vendor_fee_local
double: service_fee_local sof_local_cdwh sof_local delivery_costs_local
boolean: is_delivery_fee_covered_by_discount is_delivery_fee_covered_by_voucher
string: df_voucher_flag is_fd_subscription
double: joker_customer_discount_local discount_dh_local discount_other_local voucher_dh_local voucher_other_local
double: dps_surge_fee_eur dps_travel_time_fee_eur dps_delivery_fee_eur delivery_fee_eur
double: dps_delivery_fee_eur_before_vat dps_last_non_zero_df_eur dps_standard_fee_eur actual_df_paid_by_customer_eur
double: gfv_eur gmv_eur customer_paid_eur commission_eur joker_vendor_fee_eur
double: service_fee_eur sof_eur_cdwh sof_eur delivery_costs_eur
double: joker_customer_discount_eur discount_dh_eur discount_other_eur voucher_dh_eur voucher_other_eur
double: avg_actual_df_paid_local_impute avg_actual_df_paid_eur_impute
double: revenue_local revenue_local_cf gross_profit_local gross_profit_local_cf
double: revenue_eur revenue_eur_cf gross_profit_eur gross_profit_eur_cf
""")

SOURCE_SCHEMAS = {
    "countries": COUNTRIES,
    "entities": ENTITIES,
    "sessions": SESSIONS,
    "delivery_orders": DELIVERY_ORDERS,
    "platform_orders": PLATFORM_ORDERS,
    "subs_apac": SUBSCRIPTIONS,
    "subs_eu": SUBSCRIPTIONS,
}


@dataclass(frozen=True)
class Sources:
    """The seven source tables of the batch job."""

    countries: DataFrame
    entities: DataFrame
    sessions: DataFrame
    delivery_orders: DataFrame
    platform_orders: DataFrame
    subs_apac: DataFrame
    subs_eu: DataFrame
