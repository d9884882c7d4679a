from pyspark.sql import functions as F
from small import PARAMS, sources

from orderlens.plans.batch import profit_orders
from orderlens.session import pin, shared_dir
from orderlens.sources.schemas import SOURCE_SCHEMAS
from orderlens.sources.tables import duplicate_keys, publish_table, read_sources


def test_catalog_table(spark, tmp_path):
    """The name always shows one whole version, in the declared types."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS orderlens_test LOCATION '{tmp_path}/db'")
    name, path = "orderlens_test.t", f"{tmp_path}/t"
    spark.range(1).write.saveAsTable(name)
    frame = spark.createDataFrame([("01", 1, "a b"), ("2", 2, None), (None, 3, "c")], "part string, n int, `more text` string")
    for rows in (frame, frame.filter("n < 3"), frame.limit(0), frame):
        made = publish_table(rows, name, path, ["part"])
        assert made.schema == frame.schema and sorted(map(repr, made.collect())) == sorted(map(repr, rows.collect()))
    names = [t.name for t in spark.catalog.listTables("orderlens_test") if not t.isTemporary]
    assert len(names) == 2 and "t" in names
    other = publish_table(spark.range(3), "orderlens_test.u", f"{tmp_path}/u")
    assert other.count() == 3 and spark.table(name).count() == 3
    spark.sql("DROP DATABASE orderlens_test CASCADE")


def test_sources_with_other_types_and_more_fields(spark, tmp_path):
    given = sources(spark)
    stored = {
        "sessions": given.sessions.withColumns({
            "order_placed_at": F.col("order_placed_at").cast("timestamp"), "zone_id": F.col("zone_id").cast("int"),
            "more": F.lit(1)}),
        "delivery_orders": given.delivery_orders.withColumn(
            "value", F.col("value").withField("more", F.lit(1)))}
    for name in SOURCE_SCHEMAS:
        stored.get(name, getattr(given, name)).write.parquet(f"{tmp_path}/{name}")
    read = read_sources(spark, {name: f"{tmp_path}/{name}" for name in SOURCE_SCHEMAS})
    assert read.sessions.schema == SOURCE_SCHEMAS["sessions"]
    assert read.sessions.collect() == given.sessions.collect()
    assert profit_orders(read, PARAMS).first().sof_local_cdwh == 5.0


def test_pin_is_a_stored_copy(spark):
    stored = pin(spark.range(3).withColumn("r", F.rand()), "pinned")
    assert sorted(stored.collect()) == sorted(stored.collect())
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir", shared_dir(spark))


def test_duplicate_keys_are_reported(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 1), (None, 1)], "k string, n int")
    assert [tuple(r) for r in duplicate_keys(frame, ["k", "n"]).collect()] == [("a", 1, 2)]
