"""Running sums and previous rows cut into chunks agree with brute force."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderlens.operators.running import previous, running

SCHEMA = "pane string, total decimal(30,6), name string, gmv decimal(30,6)"


def make_rows():
    """One pane holds most rows, many of them tied; one pane is NULL, one has a single row."""
    rng = random.Random(5)
    rows = []
    for pane, size in (("hot", 60), ("b", 17), (None, 9), ("one", 1)):
        for i in range(size):
            gmv = None if rng.random() < 0.1 else Decimal(rng.randrange(-500, 900)) / 100
            rows.append((pane, Decimal(rng.randrange(3)), f"v{i:03d}", gmv))
    rng.shuffle(rows)
    return rows


def brute(rows, by_pane=True):
    """(pane, name) -> (position, running sum, previous value)."""
    def rank(row):
        return (row[0] is not None, row[0] or "", -row[1], row[2])

    result, seen = {}, {}
    for pane, _, name, gmv in sorted(rows, key=rank):
        group = pane if by_pane else "all"
        position, total, last = seen.get(group, (0, None, None))
        total = total if gmv is None else (total or 0) + gmv
        result[pane, name] = (position + 1, total, last)
        seen[group] = (position + 1, total, gmv)
    return result


def order():
    return (F.col("total").desc(), F.col("name").asc())


@pytest.mark.parametrize("rows_per_task", [1000, 20, 3])
def test_running_in_panes(spark, rows_per_task):
    rows = make_rows()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = running(frame, ["pane"], order(), {"sum": F.col("gmv")}, "position", rows_per_task)
    want = brute(rows)
    assert {(r.pane, r.name): (r.position, r.sum) for r in got.collect()} == {
        k: v[:2] for k, v in want.items()}


@pytest.mark.parametrize("rows_per_task", [1000, 20, 3])
def test_previous_in_panes(spark, rows_per_task):
    rows = make_rows()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = previous(frame, ["pane"], order(), {"before": "gmv"}, rows_per_task)
    assert {(r.pane, r.name): r.before for r in got.collect()} == {
        k: v[2] for k, v in brute(rows).items()}


@pytest.mark.parametrize("rows_per_task", [1000, 20, 3])
def test_whole_table(spark, rows_per_task):
    rows = make_rows()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    by = (F.col("pane").asc_nulls_first(), *order())
    want = brute(rows, by_pane=False)
    summed = running(frame, [], by, {"sum": F.col("gmv")}, "position", rows_per_task)
    assert {(r.pane, r.name): (r.position, r.sum) for r in summed.collect()} == {
        k: v[:2] for k, v in want.items()}
    shifted = previous(frame, [], by, {"before": "gmv"}, rows_per_task)
    assert {(r.pane, r.name): r.before for r in shifted.collect()} == {k: v[2] for k, v in want.items()}


def test_chunks_stay_small(spark):
    """The hot pane is spread over tasks, none of which gets much more than its share."""
    frame = spark.createDataFrame(make_rows(), SCHEMA)
    chunks = (
        frame.repartitionByRange(9, F.col("pane").asc_nulls_first(), *order())
        .groupBy(F.spark_partition_id().alias("chunk")).count().collect()
    )
    assert len(chunks) >= 8 and max(c["count"] for c in chunks) <= 30


def test_chunks_give_the_type_and_digits_of_a_window(spark):
    """Shares of 15 decimals are where a sum of two full decimals would lose one."""
    rows = spark.range(200).select(
        (F.col("id") % 3).alias("pane"), F.col("id"), (F.col("id") / 7.0).cast("decimal(30,15)").alias("share"),
        (F.col("id") / 3.0).cast("decimal(34,12)").alias("gmv"))
    whole, chunked = (
        running(rows, ["pane"], [F.col("id")], {"s": F.col("share"), "g": F.col("gmv")}, "at", n) for n in (1000, 10))
    assert whole.schema["s"].dataType == chunked.schema["s"].dataType
    assert whole.schema["g"].dataType == chunked.schema["g"].dataType
    assert sorted(whole.collect()) == sorted(chunked.collect())
