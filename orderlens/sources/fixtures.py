"""Source tables derived from the given star-schema tables (see FIXTURES.md).

The mapping is SQL that Spark and the checking engine both read, so both see the same rows.
``{table}`` stands for a table, ``<name>`` for the few spellings that differ per engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.params import BatchParams
from orderlens.session import pin
from orderlens.sources.schemas import SOURCE_SCHEMAS, Sources
from orderlens.sources.tables import conform

# Nation keys that carry an excluded entity id.
SPECIAL_ENTITIES = {20: "TB_SA", 21: "FP_DE", 22: "DN_22", 23: "ODR_23"}
NATION_COUNT = 25


def entity_of_nation(key: int) -> str:
    return SPECIAL_ENTITIES.get(key, f"FP_NATION_{key}")


# The whole of the given tables: every entity and every order date.
FIXTURE_PARAMS = BatchParams(
    entity_ids=[entity_of_nation(k) for k in range(NATION_COUNT)],
    start_date="1995-01-01",
    end_date="2001-12-31",
)

FIXTURE_SQL = {
    "dim_entity": """
SELECT n.n_nationkey,
       CASE r.r_name WHEN 'ASIA' THEN 'Asia' WHEN 'EUROPE' THEN 'Europe'
                     WHEN 'AFRICA' THEN 'Africa' WHEN 'AMERICA' THEN 'Americas' END AS region,
       CASE n.n_nationkey WHEN 20 THEN 'TB_SA' WHEN 21 THEN 'FP_DE' WHEN 22 THEN 'DN_22'
                          WHEN 23 THEN 'ODR_23' ELSE 'FP_' || n.n_name END AS entity_id,
       n.n_name AS country_code,
       n.n_name AS country_name
FROM {nation} n JOIN {region} r ON n.n_regionkey = r.r_regionkey""",

    "entities": """
SELECT region, country_code AS country_iso, country_name,
       CASE WHEN n_nationkey <> 19 THEN <one_platform> END AS platforms
FROM {dim_entity}""",

    "zone_items": """
SELECT DISTINCT n.n_nationkey, n.n_name AS country_code, c.c_mktsegment AS segment,
       n.n_nationkey * 100 + ascii(c.c_mktsegment) AS city_id,
       c.c_custkey % 4 AS z
FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey""",

    "city_items": """
SELECT n_nationkey, country_code, segment, city_id,
       (n_nationkey + length(segment)) % 4 <> 0 AS is_active,
       CASE WHEN n_nationkey % 6 <> 5 THEN <zone_list> END AS zones
FROM {zone_items}
GROUP BY n_nationkey, country_code, segment, city_id""",

    "countries": """
SELECT k.country_code,
       CASE WHEN e.n_nationkey <> 19 THEN <one_platform> END AS platforms,
       k.cities
FROM (SELECT n_nationkey, country_code, <city_list> AS cities
      FROM {city_items} GROUP BY n_nationkey, country_code) k
JOIN {dim_entity} e ON e.n_nationkey = k.n_nationkey""",

    "sessions": """
SELECT CAST(o.o_orderdate AS DATE) AS created_date,
       o.o_orderdate AS order_placed_at,
       <first_order> AS customer_first_order_date,
       e.entity_id,
       e.country_code,
       c.c_mktsegment AS city_name,
       CAST(s.s_nationkey * 100 + ascii(c.c_mktsegment) AS BIGINT) AS city_id,
       CASE WHEN c.c_custkey % 50 <> 0
            THEN c.c_mktsegment || '-' || CAST(c.c_custkey % 4 AS STRING) END AS zone_name,
       CAST((s.s_nationkey * 100 + ascii(c.c_mktsegment)) * 10 + c.c_custkey % 4 AS BIGINT) AS zone_id,
       l.l_orderkey AS order_id,
       CAST(l.l_orderkey AS STRING) AS platform_order_code,
       o.o_orderpriority AS variant,
       CAST(p.p_size AS DOUBLE) AS experiment_id,
       'client-' || CAST(c.c_custkey AS STRING) AS perseus_client_id,
       'ga-' || CAST(l.l_orderkey AS STRING) AS ga_session_id,
       'dps-' || CAST(l.l_orderkey AS STRING) || '-' || CAST(l.l_linenumber AS STRING) AS dps_sessionid,
       CASE WHEN c.c_acctbal < 0 THEN 'New' ELSE 'Existing' END AS dps_customer_tag,
       CAST(c.c_custkey % 30 AS DOUBLE) AS customer_total_orders,
       CAST(l.l_linenumber AS DOUBLE) AS scheme_id,
       CASE l.l_linenumber WHEN 1 THEN 'Automatic' WHEN 2 THEN 'Manual' WHEN 3 THEN 'Campaign'
                           ELSE 'Country Fallback' END AS vendor_price_scheme_type,
       CAST(l.l_suppkey AS STRING) AS vendor_id,
       p.p_brand AS chain_id,
       p.p_brand AS chain_name,
       lower(p.p_type) AS vertical_type,
       CASE p.p_type WHEN 'ECONOMY' THEN 'Restaurants' WHEN 'LARGE' THEN 'restaurant'
                     WHEN 'MEDIUM' THEN 'Shop' WHEN 'PROMO' THEN 'darkstores'
                     WHEN 'SMALL' THEN 'Other' END AS vendor_vertical_parent,
       CASE o.o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'on the way'
                            ELSE 'pending' END AS delivery_status,
       l.l_linestatus = 'F' AS is_own_delivery,
       CASE l.l_returnflag WHEN 'R' THEN TRUE WHEN 'A' THEN FALSE END AS is_delivery_fee_covered_by_discount,
       l.l_linestatus = 'O' AS is_delivery_fee_covered_by_voucher,
       1e0 + s.s_nationkey * 0.25e0 AS exchange_rate,
       l.l_quantity * 0.02e0 AS dps_surge_fee_local,
       l.l_quantity * 0.03e0 AS dps_travel_time_fee_local,
       CASE WHEN l.l_linenumber <> 7 THEN l.l_quantity * 0.1e0 END AS dps_delivery_fee_local,
       l.l_quantity * 0.08e0 AS delivery_fee_local,
       l.l_quantity * 0.09e0 AS dps_last_non_zero_df_local,
       l.l_quantity * 0.07e0 AS dps_standard_fee_local,
       CAST(2000 * (l.l_orderkey % 10) AS DOUBLE) AS dps_minimum_order_value_local,
       l.l_extendedprice AS gfv_local,
       l.l_extendedprice * (1e0 + l.l_tax) AS gmv_local,
       l.l_extendedprice * (1e0 - l.l_discount) AS customer_paid_local,
       l.l_extendedprice * l.l_discount AS commission_local,
       CASE WHEN l.l_linenumber <> 6 THEN CAST(l.l_partkey % 3 AS DOUBLE) END AS joker_vendor_fee_local,
       CASE WHEN l.l_linenumber <> 5 THEN 0.5e0 END AS service_fee_local,
       l.l_quantity * l.l_tax * 10e0 AS delivery_costs_local,
       l.l_quantity * 0.01e0 AS joker_customer_discount_local,
       l.l_quantity * l.l_discount AS discount_dh_local,
       l.l_quantity * 0.04e0 AS discount_other_local,
       l.l_quantity * 0.05e0 AS voucher_dh_local,
       l.l_quantity * 0.06e0 AS voucher_other_local
FROM {lineitem} l
JOIN {orders} o ON l.l_orderkey = o.o_orderkey
JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
JOIN {part} p ON l.l_partkey = p.p_partkey
JOIN {dim_entity} e ON s.s_nationkey = e.n_nationkey""",

    "delivery_orders": """
SELECT global_entity_id, CAST(code AS STRING) AS order_id,
       <location> AS delivery_location, <fees> AS value
FROM (SELECT DISTINCT entity_id AS global_entity_id, order_id AS code
      FROM {sessions} WHERE delivery_status <> 'pending') k""",

    "platform_keys": """
SELECT DISTINCT s.entity_id, s.order_id, s.platform_order_code AS code, s.created_date,
       s.entity_id || '-' || s.platform_order_code AS uuid, s.variant, e.region
FROM {sessions} s JOIN {dim_entity} e ON s.entity_id = e.entity_id
WHERE e.region IN ('Asia', 'Europe')""",

    "platform_orders": """
SELECT entity_id AS global_entity_id, code, created_date AS created_date_utc, uuid,
       CASE WHEN order_id % 7 <> 0 THEN CAST(2 + order_id % 4 AS DOUBLE) END AS delivery_fee_local,
       CASE WHEN order_id % 50 <> 1 THEN CAST(5 * (order_id % 5) AS DOUBLE) END AS delivery_fee_vat_rate
FROM {platform_keys}""",

    "subs_apac": """
SELECT uuid, created_date AS created_date_utc,
       order_id % 2 = 0 AS is_free_delivery_subscription_order
FROM {platform_keys} WHERE region = 'Asia' AND variant <> '5-LOW'""",

    "subs_eu": """
SELECT uuid, created_date AS created_date_utc,
       order_id % 5 = 0 AS is_free_delivery_subscription_order
FROM {platform_keys} WHERE region = 'Europe'""",
}

SPARK_SPELLING = {
    "<one_platform>": "array(named_struct('entity_id', entity_id))",
    "<zone_list>": """collect_list(named_struct(
        'id', CAST(city_id * 10 + z AS BIGINT), 'name', segment || '-' || CAST(z AS STRING),
        'shape', 'POINT (' || CAST(city_id AS STRING) || ' ' || CAST(z AS STRING) || ')',
        'is_active', (n_nationkey + z) % 5 <> 0))""",
    "<city_list>": """collect_list(named_struct(
        'id', CAST(city_id AS BIGINT), 'name', segment, 'is_active', is_active, 'zones', zones))""",
    "<first_order>": "timestampadd(DAY, -CAST(o.o_custkey % 400 AS INT), o.o_orderdate)",
    "<location>": """named_struct(
        'longitude', CASE WHEN code % 13 <> 0 THEN CAST(code % 360 - 180 AS DOUBLE) END,
        'latitude', CAST(code % 180 - 90 AS DOUBLE))""",
    "<fees>": "named_struct('mov_customer_fee_local', CASE WHEN code % 3 = 0 THEN 1.5e0 END)",
}

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# The same joins in the order that shuffles fewest bytes: customers meet the orders, parts and suppliers the bare
# lines. The order key comes last and as the text that the sessions call ``platform_order_code``, so their rows
# come out laid out by it and the lookups by order code need no shuffle of them.
_SESSION_JOINS = FIXTURE_SQL["sessions"][FIXTURE_SQL["sessions"].index("FROM {lineitem}"):]
_SESSION_JOINS_BY_CODE = """FROM {lineitem} l
JOIN {part} p ON l.l_partkey = p.p_partkey
JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
JOIN ({orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey)
  ON CAST(l.l_orderkey AS STRING) = CAST(o.o_orderkey AS STRING)
JOIN {dim_entity} e ON s.s_nationkey = e.n_nationkey"""

# The order tables are distinct over keys that all hold the entity and the order. The sessions come out laid out by
# order code, so their distinct rows per order need no shuffle, and the order tables are plain reads of those rows:
# neither shuffled for a distinct of their own nor stored. The code is a function of the order.
_ORDER_KEYS = ("entity_id", "order_id", "platform_order_code")
_BY_ORDER = {
    """SELECT DISTINCT entity_id AS global_entity_id, order_id AS code
      FROM {sessions} WHERE delivery_status <> 'pending'""":
    "SELECT entity_id AS global_entity_id, order_id AS code FROM {order_keys} WHERE stands_for_delivery",

    "SELECT DISTINCT s.entity_id, s.order_id": "SELECT s.entity_id, s.order_id",
    "FROM {sessions} s JOIN {dim_entity} e": "FROM {order_keys} s JOIN {entity_regions} e",
}
# Steps that are read more than once and are far narrower than the sessions; the others are left as plans, so that
# a query reads only the columns it needs. The few entities are stored so that their size is known, not estimated.
_STORED_STEPS = {"dim_entity", "entity_regions", "order_keys"}


def _tables_in(text: str) -> list[str]:
    return [n for n in (*BASE_TABLES, *FIXTURE_SQL, *_STORED_STEPS) if "{%s}" % n in text]


def _order_keys(sessions: DataFrame) -> DataFrame:
    """Distinct orders with date and variant; one row of each that has a delivered session stands for its delivery."""
    delivered = F.coalesce(F.col("delivery_status") != "pending", F.lit(False))
    rows = sessions.groupBy(*_ORDER_KEYS, "created_date", "variant").agg(F.max(delivered).alias("delivered"))
    place = F.row_number().over(Window.partitionBy(*_ORDER_KEYS).orderBy(F.col("delivered").desc()))
    return rows.withColumn("stands_for_delivery", F.col("delivered") & (place == 1)).drop("delivered")


class FixtureTables:
    """The steps of the mapping by name, each made when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf_dir = spark, sf_dir
        self._frames: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._made(name)
        return self._frames[name]

    def _made(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            frame = self._spark.read.parquet(f"{self._sf_dir}/{name}.parquet")
            return _spread(frame) if name == "lineitem" else frame
        if name == "order_keys":
            return pin(_order_keys(self["sessions"]), name)
        if name == "entity_regions":
            return pin(self["dim_entity"].select("entity_id", "region").distinct(), name)
        text = FIXTURE_SQL[name].replace(_SESSION_JOINS, _SESSION_JOINS_BY_CODE)
        for token, spelling in (*_BY_ORDER.items(), *SPARK_SPELLING.items()):
            text = text.replace(token, spelling)
        frame = self._spark.sql(text, **{t: self[t] for t in dict.fromkeys(_tables_in(text))})
        if name in SOURCE_SCHEMAS:
            frame = conform(frame, SOURCE_SCHEMAS[name])
        return pin(frame, name) if name in _STORED_STEPS else frame

    def sources(self) -> Sources:
        return Sources(**{name: self[name] for name in SOURCE_SCHEMAS})


def fixture_sources(spark: SparkSession, sf_dir: str) -> Sources:
    """The source tables, as views of the given ones and of the stored rows per order."""
    return FixtureTables(spark, sf_dir).sources()


def _spread(frame: DataFrame) -> DataFrame:
    """Rows over all cores where the table is too small to be read by as many tasks."""
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame.repartition(cores) if frame.rdd.getNumPartitions() < cores else frame
