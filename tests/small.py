"""Hand-written source tables: a base row per table, changed field by field."""

from datetime import date, datetime

from pyspark.sql import Row

from orderlens.params import BatchParams
from orderlens.sources.schemas import SOURCE_SCHEMAS, Sources

DAY = date(2022, 6, 15)
PARAMS = BatchParams(entity_ids=["FP_TW", "FP_XX", "DN_YY"], start_date="2022-06-01", end_date="2022-08-31")

AMOUNTS = {
    "dps_surge_fee_local": 1.0, "dps_travel_time_fee_local": 2.0, "dps_delivery_fee_local": 12.0,
    "delivery_fee_local": 10.0, "dps_last_non_zero_df_local": 3.0, "dps_standard_fee_local": 4.0,
    "dps_minimum_order_value_local": 100.0, "gfv_local": 80.0, "gmv_local": 90.0,
    "customer_paid_local": 85.0, "commission_local": 20.0, "joker_vendor_fee_local": 2.0,
    "service_fee_local": 1.0, "delivery_costs_local": 15.0, "joker_customer_discount_local": 0.5,
    "discount_dh_local": 0.25, "discount_other_local": 0.25, "voucher_dh_local": 0.5, "voucher_other_local": 0.5,
}

SESSION = {
    "created_date": DAY, "order_placed_at": datetime(2022, 6, 15, 12), "exchange_rate": 4.0,
    "customer_first_order_date": datetime(2022, 6, 1, 13), "entity_id": "FP_TW", "country_code": "tw",
    "city_name": "Taipei", "city_id": 1, "zone_name": "Z", "zone_id": 11, "order_id": 1,
    "platform_order_code": "o1", "vendor_id": "v1", "vertical_type": "restaurants",
    "vendor_vertical_parent": "Restaurants", "is_own_delivery": True,
    "is_delivery_fee_covered_by_discount": False, "is_delivery_fee_covered_by_voucher": False, **AMOUNTS,
}
PLATFORM_ORDER = {
    "global_entity_id": "FP_TW", "code": "o1", "created_date_utc": DAY, "uuid": "u1",
    "delivery_fee_local": 6.0, "delivery_fee_vat_rate": 20.0,
}
SUBSCRIPTION = {"uuid": "u1", "created_date_utc": DAY, "is_free_delivery_subscription_order": True}
DELIVERY_ORDER = {
    "global_entity_id": "FP_TW", "order_id": "o1",
    "delivery_location": {"longitude": 121.5, "latitude": 25.0}, "value": {"mov_customer_fee_local": 5.0},
}
ENTITIES = [
    {"region": "Asia", "country_iso": "TW", "country_name": "Taiwan", "platforms": [{"entity_id": "FP_TW"}]},
    {"region": None, "country_iso": "XX", "country_name": "Nowhere", "platforms": [{"entity_id": "FP_XX"}]},
    {"region": "Asia", "country_iso": "YY", "country_name": "Other", "platforms": [{"entity_id": "DN_YY"}]},
    {"region": "Asia", "country_iso": "ZZ", "country_name": "Bare", "platforms": None},
]
COUNTRIES = [{
    "country_code": "tw",
    "platforms": [{"entity_id": "FP_TW"}, {"entity_id": "OTHER"}],
    "cities": [
        {"id": 1, "name": "Taipei", "is_active": True, "zones": [
            {"id": 11, "name": "Z", "shape": "POINT (1 1)", "is_active": True},
            {"id": 12, "name": "Y", "shape": None, "is_active": False},
            {"id": 13, "name": "X", "shape": None, "is_active": None},
        ]},
        {"id": 2, "name": "Closed", "is_active": False, "zones": [
            {"id": 21, "name": "W", "shape": None, "is_active": True}]},
        {"id": 3, "name": "Empty", "is_active": True, "zones": None},
    ],
}]


def variant(base, **changes):
    return {**base, **changes}


def sources(spark, **tables) -> Sources:
    """Given rows per table; tables left out hold the base row (no row for ``subs_eu``)."""
    rows = {
        "countries": COUNTRIES, "entities": ENTITIES, "sessions": [SESSION],
        "delivery_orders": [DELIVERY_ORDER], "platform_orders": [PLATFORM_ORDER],
        "subs_apac": [SUBSCRIPTION], "subs_eu": [], **tables,
    }
    return Sources(**{
        name: spark.createDataFrame(
            [Row(**{f: r.get(f) for f in schema.fieldNames()}) for r in rows[name]], schema).coalesce(1)
        for name, schema in SOURCE_SCHEMAS.items()
    })
