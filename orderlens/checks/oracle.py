"""The same results as plain SQL over the given tables, for the checking engine.

Every query is built from named steps; a query carries only the steps it needs.
"""

from __future__ import annotations

import re

from orderlens.operators.order_fact import PLAIN_AMOUNTS
from orderlens.operators.profit import AGGREGATE_KEYS
from orderlens.functions.money import eur_name
from orderlens.sources.fixtures import FIXTURE_PARAMS, FIXTURE_SQL
from orderlens.sources.schemas import ORDER_TABLE, SOURCE_SCHEMAS

SQL_SPELLING = {
    "<one_platform>": "[struct_pack(entity_id := entity_id)]",
    "<zone_list>": """list(struct_pack(
        id := CAST(city_id * 10 + z AS BIGINT), name := segment || '-' || CAST(z AS STRING),
        shape := 'POINT (' || CAST(city_id AS STRING) || ' ' || CAST(z AS STRING) || ')',
        is_active := (n_nationkey + z) % 5 <> 0))""",
    "<city_list>": """list(struct_pack(
        id := CAST(city_id AS BIGINT), name := segment, is_active := is_active, zones := zones))""",
    "<first_order>": "o.o_orderdate - to_days(CAST(o.o_custkey % 400 AS INTEGER))",
    "<location>": """struct_pack(
        longitude := CASE WHEN code % 13 <> 0 THEN CAST(code % 360 - 180 AS DOUBLE) END,
        latitude := CAST(code % 180 - 90 AS DOUBLE))""",
    "<fees>": "struct_pack(mov_customer_fee_local := CASE WHEN code % 3 = 0 THEN 1.5e0 END)",
}


def _fixture_steps() -> dict[str, str]:
    steps = {}
    for name, text in FIXTURE_SQL.items():
        for token, spelling in SQL_SPELLING.items():
            text = text.replace(token, spelling)
        steps[name] = re.sub(r"\{(\w+)\}", r"\1", text)
    return steps


def text_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def total(column: str) -> str:
    """Plain sum of doubles."""
    return f"SUM({column})"


def _eur_columns(prefix: str = "") -> str:
    return ",\n       ".join(f"{prefix}{n} / exchange_rate AS {eur_name(n)}" for n in PLAIN_AMOUNTS)


ENTITY_LIST = text_list(FIXTURE_PARAMS.entity_ids)
DATE_RANGE = f"DATE '{FIXTURE_PARAMS.start_date}' AND DATE '{FIXTURE_PARAMS.end_date}'"
ORDER_COLUMNS = ", ".join([*ORDER_TABLE.fieldNames(), "zone_shape", "longitude", "latitude", "free_flag"])

STEPS = {
    **_fixture_steps(),

    "zones": f"""
SELECT entity_id, country_code, city.name AS city_name, city.id AS city_id,
       zone.shape AS zone_shape, zone.name AS zone_name, zone.id AS zone_id
FROM (SELECT entity_id, country_code, city, unnest(city.zones) AS zone
      FROM (SELECT platform.entity_id AS entity_id, country_code, unnest(cities) AS city
            FROM (SELECT country_code, cities, unnest(platforms) AS platform FROM countries))
      WHERE city.is_active AND entity_id IN ({ENTITY_LIST}))
WHERE zone.is_active""",

    "entity_dim": """
SELECT region, entity_id, country_iso, country_name
FROM (SELECT region, platform.entity_id AS entity_id, country_iso, country_name
      FROM (SELECT region, country_iso, country_name, unnest(platforms) AS platform FROM entities))
WHERE entity_id IN (SELECT entity_id FROM sessions)
  AND NOT starts_with(entity_id, 'ODR')
  AND NOT (starts_with(entity_id, 'DN') AND length(entity_id) > 2)
  AND entity_id NOT IN ('FP_DE', 'FP_JP', 'TB_SA', 'HS_BH')""",

    "looked_up": f"""
SELECT s.*, e.region, z.zone_shape,
       d.delivery_location.longitude AS longitude, d.delivery_location.latitude AS latitude,
       d.value.mov_customer_fee_local AS sof_local_cdwh,
       p.delivery_fee_local AS platform_fee,
       p.delivery_fee_vat_rate / 100 AS vat,
       COALESCE(ap.is_free_delivery_subscription_order, eu.is_free_delivery_subscription_order) AS free_flag,
       CASE WHEN s.is_delivery_fee_covered_by_discount OR s.is_delivery_fee_covered_by_voucher
            THEN 0 ELSE s.delivery_fee_local END AS charged_fee
FROM sessions s
JOIN entity_dim e ON e.entity_id = s.entity_id
LEFT JOIN delivery_orders d
       ON d.global_entity_id = s.entity_id AND d.order_id = s.platform_order_code
LEFT JOIN platform_orders p
       ON p.global_entity_id = s.entity_id AND p.code = s.platform_order_code
      AND p.created_date_utc = s.created_date
LEFT JOIN subs_apac ap ON ap.uuid = p.uuid AND ap.created_date_utc = p.created_date_utc
LEFT JOIN subs_eu eu ON eu.uuid = p.uuid AND eu.created_date_utc = p.created_date_utc
LEFT JOIN zones z
       ON z.entity_id = s.entity_id AND z.country_code = s.country_code AND z.zone_id = s.zone_id
WHERE s.entity_id IN ({ENTITY_LIST}) AND s.created_date BETWEEN {DATE_RANGE}""",

    "order_fact": f"""
SELECT * REPLACE (
         CASE lower(vendor_vertical_parent)
              WHEN 'restaurants' THEN 'restaurant' WHEN 'restaurant' THEN 'restaurant'
              WHEN 'shop' THEN 'shop' WHEN 'darkstores' THEN 'darkstores' END AS vendor_vertical_parent,
         COALESCE(service_fee_local, 0) AS service_fee_local),
       created_date AS created_date_utc, experiment_id AS test_id,
       date_diff('day', customer_first_order_date, order_placed_at) AS days_since_first_order,
       vat AS delivery_fee_vat_rate_pd,
       dps_delivery_fee_local / (1 + vat) AS dps_delivery_fee_local_before_vat,
       dps_delivery_fee_local / exchange_rate / (1 + vat) AS dps_delivery_fee_eur_before_vat,
       CASE WHEN region IN ('Europe', 'Asia') THEN COALESCE(platform_fee, charged_fee)
            WHEN region IS NOT NULL THEN charged_fee END AS actual_df_paid_by_customer_local,
       CASE WHEN region IN ('Europe', 'Asia')
            THEN COALESCE(platform_fee / exchange_rate, charged_fee / exchange_rate)
            WHEN region IS NOT NULL THEN charged_fee / exchange_rate END AS actual_df_paid_by_customer_eur,
       CASE WHEN gfv_local >= dps_minimum_order_value_local THEN 0
            WHEN sof_local_cdwh IS NOT NULL THEN sof_local_cdwh
            ELSE dps_minimum_order_value_local - gfv_local END AS sof_local,
       CASE WHEN gfv_local / exchange_rate - dps_minimum_order_value_local / exchange_rate >= 0 THEN 0
            ELSE COALESCE(sof_local_cdwh / exchange_rate,
                          dps_minimum_order_value_local / exchange_rate - gfv_local / exchange_rate)
       END AS sof_eur,
       sof_local_cdwh / exchange_rate AS sof_eur_cdwh,
       COALESCE(service_fee_local / exchange_rate, 0) AS service_fee_eur,
       CASE WHEN is_delivery_fee_covered_by_discount IS FALSE AND is_delivery_fee_covered_by_voucher IS FALSE
            THEN 'No DF Voucher' ELSE 'DF Voucher' END AS df_voucher_flag,
       CASE WHEN free_flag THEN 'Y' ELSE 'N' END AS is_fd_subscription,
       {_eur_columns()}
FROM looked_up""",

    "zone_avg": """
SELECT entity_id, zone_name,
       SUM(actual_df_paid_by_customer_local) FILTER (WHERE is_fd_subscription = 'N')
         / NULLIF(COUNT(DISTINCT platform_order_code) FILTER (
             WHERE is_fd_subscription = 'N' AND actual_df_paid_by_customer_local IS NOT NULL), 0)
         AS avg_actual_df_paid_local_impute,
       SUM(actual_df_paid_by_customer_eur) FILTER (WHERE is_fd_subscription = 'N')
         / NULLIF(COUNT(DISTINCT platform_order_code) FILTER (
             WHERE is_fd_subscription = 'N' AND actual_df_paid_by_customer_eur IS NOT NULL), 0)
         AS avg_actual_df_paid_eur_impute
FROM order_fact GROUP BY entity_id, zone_name""",

    "imputed": """
SELECT f.* REPLACE (
         CASE WHEN f.dps_delivery_fee_local IS NULL THEN a.avg_actual_df_paid_local_impute
              ELSE f.dps_delivery_fee_local_before_vat END AS dps_delivery_fee_local_before_vat,
         CASE WHEN f.dps_delivery_fee_local IS NULL THEN a.avg_actual_df_paid_eur_impute
              ELSE f.dps_delivery_fee_eur_before_vat END AS dps_delivery_fee_eur_before_vat),
       f.dps_delivery_fee_local_before_vat AS fee_local_before_impute,
       f.dps_delivery_fee_eur_before_vat AS fee_eur_before_impute,
       a.avg_actual_df_paid_local_impute, a.avg_actual_df_paid_eur_impute
FROM order_fact f
LEFT JOIN zone_avg a ON a.entity_id = f.entity_id AND a.zone_name IS NOT DISTINCT FROM f.zone_name""",

    "revenue": """
SELECT *, actual_df_paid_by_customer_local / (1 + delivery_fee_vat_rate_pd) + commission_local
          + joker_vendor_fee_local + service_fee_local + COALESCE(sof_local_cdwh, sof_local) AS revenue_local,
       dps_delivery_fee_local_before_vat + commission_local
          + joker_vendor_fee_local + service_fee_local + COALESCE(sof_local_cdwh, sof_local) AS quoted_revenue
FROM imputed""",

    "revenue_cf": """
SELECT *, CASE is_fd_subscription WHEN 'N' THEN revenue_local ELSE quoted_revenue END AS revenue_local_cf
FROM revenue""",

    "order_table": f"""
SELECT {ORDER_COLUMNS}
FROM (SELECT *, revenue_local - delivery_costs_local AS gross_profit_local,
             revenue_local_cf - delivery_costs_local AS gross_profit_local_cf,
             revenue_local / exchange_rate AS revenue_eur,
             revenue_local_cf / exchange_rate AS revenue_eur_cf,
             (revenue_local - delivery_costs_local) / exchange_rate AS gross_profit_eur,
             (revenue_local_cf - delivery_costs_local) / exchange_rate AS gross_profit_eur_cf
      FROM revenue_cf)""",

    "vendor_agg": f"""
SELECT {", ".join(AGGREGATE_KEYS)}, COUNT(DISTINCT platform_order_code) AS order_count,
       {total("gmv_eur")} AS gmv_eur, {total("gross_profit_eur")} AS gross_profit_eur,
       {total("gross_profit_eur_cf")} AS gross_profit_eur_cf
FROM order_table WHERE gross_profit_eur IS NOT NULL GROUP BY ALL""",
}


def with_steps(query: str, extra: dict[str, str] | None = None) -> str:
    """``query`` preceded by the steps it refers to, directly or through others."""
    steps = {**STEPS, **(extra or {})}
    words = {name: set(re.findall(r"\w+", text)) for name, text in steps.items()}
    needed, pending = set(), [set(re.findall(r"\w+", query))]
    while pending:
        for name in pending.pop() & set(steps):
            if name not in needed:
                needed.add(name)
                pending.append(words[name])
    ordered = [n for n in steps if n in needed]
    head = ",\n".join(f"{n} AS ({steps[n].strip()}\n)" for n in ordered)
    return f"WITH {head}\n{query.strip()}" if head else query.strip()


SOURCE_NAMES = tuple(SOURCE_SCHEMAS)
