"""Partial aggregates per day against the order rows, over updates and filters."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from orderlens.operators.filters import apply_context
from orderlens.operators.lod import VENDOR_MARK, VERTICAL_LEVEL
from orderlens.operators.lod import marks as marks_of_rows
from orderlens.params import ViewFilters
from orderlens.plans import day_marks
from orderlens.sources.schemas import ORDER_TABLE
from orderlens.sources.versions import Folder

FILTERS = [
    ViewFilters(), ViewFilters(created_date_utc=(date(2022, 2, 10), date(2022, 4, 3))), ViewFilters(region=(None, "Asia"), is_fd_subscription=("Y",)),
    ViewFilters(zone_name=("z1", None), city_name=("c0",), vertical_type=("food",)), ViewFilters(entity_id=())]


def order_rows(spark, seed, months, codes=80, n=400):
    """Orders whose codes repeat within cells, over cells, over months, or are NULL."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        day = rng.choice([None, *[date(2022, m, rng.choice([1, 10, 28])) for m in months]])
        known = dict(
            region=rng.choice(["Asia", None]), entity_id=rng.choice(["E1", "E2"]), vertical_type=rng.choice(["food", "shop", None]),
            vendor_id=rng.choice(["v1", "v2", "v3"]), platform_order_code=rng.choice([None, *map(str, range(codes))]), created_date_utc=day,
            is_fd_subscription=rng.choice("YN"), city_name=rng.choice(["c0", "c1"]), zone_name=rng.choice(["z1", "z2", None]),
            gmv_eur=rng.choice([None, 0.1, 7.25]), gross_profit_eur=rng.choice([1.5, 2.0, None]), gross_profit_eur_cf=rng.choice([3.0, float("inf")]))
        rows.append(tuple(known.get(f) for f in ORDER_TABLE.fieldNames()))
    return spark.createDataFrame(rows, ORDER_TABLE)


def rows(frame):
    return sorted(map(repr, frame.collect()))


def agrees(spark, folder, orders, filters=FILTERS):
    state = day_marks.read(spark, folder)
    for f in filters:
        for keys in (VENDOR_MARK, VERTICAL_LEVEL):
            assert rows(day_marks.marks(state, f, keys)) == rows(marks_of_rows(apply_context(orders, f), keys)), (f, keys)


@pytest.fixture
def pinned(spark, tmp_path):
    def keep(frame, name):
        frame.write.parquet(f"{tmp_path}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{tmp_path}/{name}")
    return keep


def test_state_gives_the_marks_of_the_rows(spark, tmp_path, pinned):
    folder = f"{tmp_path}/state"
    first = pinned(order_rows(spark, 1, (1, 2, 3, 4)), "first")
    assert day_marks.update(first, folder) == ["2022-01", "2022-02", "2022-03", "2022-04", "none"]
    agrees(spark, folder, first)
    # A month is replaced and one comes; codes that now repeat, or no longer do, take other months along.
    kept = first.filter(~F.month("created_date_utc").eqNullSafe(2))
    second = pinned(kept.union(order_rows(spark, 2, (2, 5), codes=120).dropna(subset=["created_date_utc"])), "second")
    day_marks.update(second, folder, ["2022-02", "2022-05"])
    agrees(spark, folder, second, FILTERS[:3])
    # Without months all are compared, and months without rows go.
    third = pinned(second.filter(F.month("created_date_utc") >= 3), "third")
    day_marks.update(third, folder)
    agrees(spark, folder, third, FILTERS[:2])


def test_only_touched_months_are_written(spark, tmp_path, pinned):
    folder = f"{tmp_path}/state"
    alone = order_rows(spark, 3, (1, 2, 3, 6, 7), n=150).dropna(subset=["created_date_utc"]).withColumn(
        "platform_order_code", F.concat_ws("-", F.month("created_date_utc"), "platform_order_code"))
    code = alone.filter(F.month("created_date_utc") == 1).first().platform_order_code
    tied = alone.filter(F.month("created_date_utc") == 3).limit(1).withColumn("platform_order_code", F.lit(code))
    day_marks.update(pinned(alone, "alone"), folder)
    before = {t: set(Folder(spark, f"{folder}/{t}").current().folders) for t in ("cells", "orders")}
    table = pinned(alone.union(tied.withColumn("created_date_utc", F.lit(date(2022, 3, 1)))), "tied")
    assert day_marks.update(table, folder, ["2022-03"]) == ["2022-01", "2022-03"]
    for t in ("cells", "orders"):
        now = set(Folder(spark, f"{folder}/{t}").current().folders)
        assert {f.split("/")[0] for f in before[t] - now} == {"month=2022-01", "month=2022-03"} and len(before[t] & now) == 3
    agrees(spark, folder, table, FILTERS[:2])
    state = day_marks.read(spark, folder)
    days = ViewFilters(created_date_utc=(date(2022, 6, 1), date(2022, 7, 31)))
    plan = day_marks.marks(state, days)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def captured(monkeypatch):
    """What an update writes, by table, and whether the rows are written where they lie."""
    written, real = {}, day_marks.replace_partitions

    def keep(df, path, *rest, **how):
        written[path.rsplit("/", 1)[1]] = df, how.get("laid_out", False)
        return real(df, path, *rest, **how)
    monkeypatch.setattr(day_marks, "replace_partitions", keep)
    return written


def test_rows_are_shuffled_once_to_their_cells(spark, tmp_path, pinned, monkeypatch, setting):
    """cells were shuffled when added up and again when written, and sets of cells collected as objects."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    written = captured(monkeypatch)
    day_marks.update(pinned(order_rows(spark, 5, (1, 2)), "rows"), f"{tmp_path}/state")
    plans = {t: df._jdf.queryExecution().executedPlan().toString() for t, (df, _) in written.items()}
    assert written["cells"][1] and plans["cells"].count("Exchange hashpartitioning") == 1
    assert "bucket" in plans["cells"].split("Exchange hashpartitioning")[1].splitlines()[0]
    assert "ObjectHashAggregate" not in plans["orders"] and "collect_set" not in plans["orders"]


def test_codes_of_one_cell_are_numbers_and_others_names(spark, tmp_path, pinned):
    """every order with lines of its own in several cells had a set of its own, grouped by its whole list."""
    first = order_rows(spark, 6, (1,), n=1).withColumns({"created_date_utc": F.lit(date(2022, 1, 1)), "vendor_id": F.lit("v1")})
    rows_of = [("a", "v1", 1), ("a", "v1", 1), ("b", "v1", 1), ("c", "v1", 1), ("c", "v2", 1), ("d", "v1", 1), ("d", "v1", 2), (None, "v1", 1)]
    table = first.drop("platform_order_code", "vendor_id", "created_date_utc").crossJoin(spark.createDataFrame(
        [(c, v, date(2022, m, 1)) for c, v, m in rows_of], "platform_order_code string, vendor_id string, created_date_utc date"))
    folder = f"{tmp_path}/state"
    day_marks.update(pinned(table.select(ORDER_TABLE.fieldNames()), "rows"), folder)
    state = day_marks.read(spark, folder)
    found = state.orders.join(state.cells.select("cell", "vendor_id"), "cell").select("month", "vendor_id", "code", "orders")
    assert rows(found) == sorted(map(repr, spark.createDataFrame(
        [("2022-01", "v1", None, 2), ("2022-01", "v1", "c", 1), ("2022-01", "v2", "c", 1),
         ("2022-01", "v1", "d", 1), ("2022-02", "v1", "d", 1)], found.schema).collect()))


def test_a_large_month_lies_in_several_files(spark, tmp_path, pinned, monkeypatch, setting):
    """Tasks and files follow the rows of a month; the marks do not depend on it."""
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    monkeypatch.setattr(day_marks, "ROWS_PER_FILE", 40)
    folder = f"{tmp_path}/state"
    table = pinned(order_rows(spark, 7, (1, 1, 1, 1, 2)).unionByName(order_rows(spark, 8, (1,)).withColumn(
        "platform_order_code", F.lit("hot"))), "rows")
    day_marks.update(table, folder)
    files = {r.month: r.n for r in day_marks.read(spark, folder).cells.select(
        "month", F.input_file_name()).distinct().groupBy("month").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert files["2022-01"] > files["2022-02"]
    agrees(spark, folder, table, FILTERS[:3])


def test_a_hot_cell_is_spread(spark, tmp_path, pinned, monkeypatch):
    """Most rows of a month in one cell do not go to one task; its rows add up."""
    monkeypatch.setattr(day_marks, "ROWS_PER_FILE", 40)
    folder = f"{tmp_path}/state"
    hot = order_rows(spark, 9, (1,), n=1).drop("platform_order_code").crossJoin(
        spark.range(300).select((F.col("id") % 200).cast("string").alias("platform_order_code"))).select(ORDER_TABLE.fieldNames())
    table = pinned(order_rows(spark, 10, (1, 2), n=100).unionByName(hot), "rows")
    day_marks.update(table, folder)
    assert day_marks.read(spark, folder).cells.groupBy("cell").count().agg(F.max("count")).first()[0] > 2
    agrees(spark, folder, table, FILTERS[:3])


def test_names_are_shuffled_once_to_where_they_are_written(spark, tmp_path, pinned, monkeypatch, setting):
    """codes and cells were shuffled to find those of one cell, to list the others, and to write them, and the
    id of a cell was stored beside the columns that it is made from."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    written = captured(monkeypatch)
    day_marks.update(pinned(order_rows(spark, 5, (1, 2)), "rows"), f"{tmp_path}/state")
    orders, laid_out = written["orders"]
    plan = orders._jdf.queryExecution().executedPlan().toString()
    names = plan[plan.index("Union"):].split("REBALANCE")[0]
    assert laid_out and "REBALANCE" in plan and "Exchange hashpartitioning(month" in names and "least_a" not in plan
    assert "cell" not in written["cells"][0].columns


def test_a_hot_code_is_spread(spark, tmp_path, pinned, monkeypatch):
    """most rows of a month with one code do not go to one task; it is named, unless all are in one cell."""
    monkeypatch.setattr(day_marks, "ROWS_PER_FILE", 40)
    vendors = spark.range(400).select((F.col("id") % 100).cast("string").alias("vendor_id"))
    base = order_rows(spark, 11, (1,), n=1).drop("platform_order_code", "vendor_id", "created_date_utc")

    def of(code, rows):
        return base.crossJoin(rows).withColumns({
            "platform_order_code": F.lit(code), "created_date_utc": F.lit(date(2022, 1, 1))}).select(ORDER_TABLE.fieldNames())
    wide, alone = of("wide", vendors), of("alone", spark.range(400).select(F.lit("v0").alias("vendor_id")))
    table = pinned(order_rows(spark, 12, (1, 2), n=100).unionByName(wide).unionByName(alone), "rows")
    folder = f"{tmp_path}/state"
    rows_of = table.withColumn("month", F.date_format("created_date_utc", "yyyy-MM")).dropna(subset=["month", "platform_order_code"])
    assert len(day_marks._hot_slots(day_marks._sizes(rows_of, ["platform_order_code"]))) == 2
    day_marks.update(table, folder)
    named = {r.code: r.n for r in day_marks.read(spark, folder).orders.filter("code IS NOT NULL").groupBy("code").agg(
        F.sum("orders").alias("n")).collect()}
    assert named["wide"] == 100 and "alone" not in named
    agrees(spark, folder, table, FILTERS[:3])
