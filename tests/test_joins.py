"""The zone join beyond the broadcast threshold, and row counts around the joins."""

import re

import pytest
from conftest import CHECK
from pyspark.sql import functions as F
from small import DELIVERY_ORDER, PARAMS, sources

from orderlens.checks import registry
from orderlens.operators.fan_out import RowCounts, join_key_report
from orderlens.operators.order_fact import ZONE_KEY, join_sources
from orderlens.operators.salted import attach_lookup, fits_broadcast, hot_keys
from orderlens.plans.batch import run_batch
from orderlens.session import pin


def small_broadcasts(setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "20k")
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", "20k")


def run(frame) -> str:
    frame._jdf.queryExecution().toRdd().count()
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def big_zones(spark):
    """The zones with polygons of ten kilobytes, which no broadcast holds here."""
    zones = registry.zones(spark, CHECK)
    noise = F.concat_ws("", F.transform(F.sequence(F.lit(1), F.lit(640)), lambda i: F.md5(F.concat(F.col("zone_id").cast("string"), i.cast("string")))))
    return pin(zones.withColumn("zone_shape", noise), "big-zones")


def test_hot_zone_is_salted(spark, setting):
    """A third of the sessions lie in one zone and the polygons are past the threshold."""
    from dataclasses import replace

    small_broadcasts(setting)
    tables, zones = registry.sources(spark, CHECK), big_zones(spark)
    one = zones.orderBy("zone_id").first()
    hit = F.pmod(F.xxhash64("dps_sessionid"), F.lit(3)) == 0
    sessions = pin(tables.sessions.withColumns({
        k: F.when(hit, F.lit(one[k])).otherwise(F.col(k)) for k in ZONE_KEY}), "hot-zone")
    tables = replace(tables, sessions=sessions)
    assert not fits_broadcast(zones.select(*ZONE_KEY, "zone_shape"))
    frame = join_sources(tables, zones, registry.FIXTURE_PARAMS, zone_rows_per_task=2_000)
    plan = run(frame.select("gmv_local", "zone_shape"))
    assert "salt_" in "".join(re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan))
    # The hot zone's rows are spread over tasks of about the size asked for.
    hot = hot_keys(sessions, ZONE_KEY, 2_000).collect()
    assert len(hot) >= 1 and max(r.salts_ for r in hot) >= 5
    shapes = zones.select(*ZONE_KEY, "zone_shape")
    narrow = sessions.select(*ZONE_KEY, "dps_sessionid", "platform_order_code", "order_placed_at")
    salted = attach_lookup(narrow, shapes, ZONE_KEY, sessions, ["dps_sessionid", "platform_order_code", "order_placed_at"], 2_000)
    text = salted._jdf.queryExecution().analyzed().toString()
    assert "salt_" in text
    expected = narrow.join(shapes, ZONE_KEY, "left")
    digest = lambda f: f.select(F.sum(F.xxhash64(*narrow.columns, "zone_shape").cast("decimal(20,0)")), F.count("*"), F.count("zone_shape")).first()
    assert digest(salted) == digest(expected) and digest(salted)[2] > 0


def test_salts_are_even(spark, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "1")
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"), "id")
    lookup = pin(spark.createDataFrame([("hot", "a"), ("hot", "b"), ("1", "c"), (None, "d")], "k string, v string"), "lookup")
    made = attach_lookup(rows, lookup, ["k"], rows, ["id"], 1_000)
    assert made.columns == ["k", "id", "v"]
    assert sorted(map(repr, made.collect())) == sorted(map(repr, rows.join(lookup, ["k"], "left").collect()))
    assert made.filter("k = 'hot'").count() == 2 * 6667
    before = made._jdf.queryExecution().analyzed().toString()
    assert "salts_" in before and [r.salts_ for r in hot_keys(rows, ["k"], 1_000).collect()] == [7]
    assert hot_keys(rows, ["k"], 10_000).count() == 0


def test_small_lookup_is_broadcast(spark):
    lookup = pin(spark.createDataFrame([("a", 1)], "k string, v int"), "lookup")
    plan = run(attach_lookup(spark.createDataFrame([("a",), (None,)], "k string"), lookup, ["k"], spark.createDataFrame([], "k string"), ["k"]))
    assert "BroadcastHashJoin" in plan and "salt" not in plan


def test_counts_around_the_joins(spark, tmp_path):
    tables = run_batch(sources(spark), PARAMS, f"{tmp_path}/once")
    assert list(tables.join_rows) == ["sessions", "delivery_orders", "platform_orders", "zones", "entities"]
    assert set(tables.join_rows.values()) == {1} and tables.repeated_keys is None
    twice = run_batch(sources(spark, delivery_orders=[DELIVERY_ORDER, DELIVERY_ORDER]), PARAMS, f"{tmp_path}/twice")
    assert twice.join_rows == {"sessions": 1, "delivery_orders": 2, "platform_orders": 2, "zones": 2, "entities": 2}
    found = {r.join_key: (r.repeated_keys, r.most_rows) for r in twice.repeated_keys.collect()}
    assert found.pop("delivery_orders") == (1, 2) and set(found.values()) == {(0, None)}
    assert twice.orders.count() == 2


def test_counting_reads_no_more(spark):
    """Counts ride along: the plan has the same scans and shuffles, and pushed filters."""
    tables, zones = registry.sources(spark, CHECK), registry.zones(spark, CHECK)
    counts = RowCounts()
    plain, watched = (join_sources(tables, zones, registry.FIXTURE_PARAMS, c).select("gmv_local", "region") for c in (None, counts))
    watched.write.format("noop").mode("overwrite").save()
    plain, watched = run(plain), run(watched)
    for part in ("FileScan", "Exchange", "Sort "):
        assert plain.count(part) >= watched.count(part) > 0 or plain.count(part) == watched.count(part)
    assert re.search(r"PushedFilters: \[IsNotNull\(created_date\)", watched)
    with_counts = counts.rows()
    assert with_counts["sessions"] == tables.sessions.count() and counts.multiplied() == {}
    assert join_key_report(tables, zones).agg(F.sum("repeated_keys")).first()[0] == 0
