"""Column rules on hand-written rows, NULLs included."""

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orderlens.functions.geo import as_geography, has_geography, point_wkb
from orderlens.functions.money import exact_sum, exact_total, ratio
from orderlens.functions.orders import (
    days_between,
    geo_point,
    normal_vertical_parent,
    paid_delivery_fee,
    small_order_fee,
    subscription_label,
    voucher_label,
)


def evaluate(spark, schema, rows, expression):
    """Expression per row, in the given order."""
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r[0] for r in frame.orderBy("i").select(expression).collect()]


def test_vertical_parent(spark):
    raw = [("Restaurant",), ("RESTAURANTS",), ("Shop",), ("darkStores",), ("Other",), (None,)]
    assert evaluate(spark, "v string", raw, normal_vertical_parent(F.col("v"))) == [
        "restaurant", "restaurant", "shop", "darkstores", None, None]


def test_days_count_midnights(spark):
    rows = [
        (datetime(2022, 6, 2, 0, 1), datetime(2022, 6, 1, 23, 59)),
        (datetime(2022, 6, 2, 23, 0), datetime(2022, 6, 2, 1, 0)),
        (datetime(2022, 6, 1), datetime(2022, 6, 3)),
        (None, datetime(2022, 6, 3)),
    ]
    got = evaluate(spark, "a timestamp_ntz, b timestamp_ntz", rows, days_between(F.col("a"), F.col("b")))
    assert got == [1, 0, -2, None]


def test_point(spark):
    rows = [(10.0, 20.0), (None, 20.0), (10.0, None), (190.0, -90.0), (-540.0, 0.0)]
    got = evaluate(spark, "x double, y double", rows, geo_point(F.col("x"), F.col("y")))
    assert [tuple(p) if p else None for p in got] == [(10.0, 20.0), None, None, (-170.0, -90.0), (-180.0, 0.0)]


def test_point_beyond_pole_is_an_error(spark):
    with pytest.raises(PySparkException):
        evaluate(spark, "x double, y double", [(0.0, 90.5)], geo_point(F.col("x"), F.col("y")))


def test_paid_fee(spark):
    rows = [
        # region, platform fee, charged fee, discounted, vouchered -> paid
        (("Asia", 3.0, 9.0, True, True), 3.0),
        (("Europe", None, 9.0, False, False), 9.0),
        (("Asia", None, 9.0, True, None), 0.0),
        (("Asia", None, 9.0, None, True), 0.0),
        (("Asia", None, 9.0, None, False), 9.0),
        (("Asia", None, 9.0, None, None), 9.0),
        (("Asia", None, None, False, False), None),
        (("Africa", 3.0, 9.0, False, False), 9.0),
        (("Africa", 3.0, 9.0, True, False), 0.0),
        ((None, 3.0, 9.0, False, False), None),
    ]
    got = evaluate(
        spark, "r string, p double, f double, d boolean, v boolean", [r for r, _ in rows],
        paid_delivery_fee(*[F.col(c) for c in "rpfdv"]))
    assert got == [want for _, want in rows]


def test_small_order_fee(spark):
    rows = [
        ((20.0, 10.0, 1.5), 0.0),
        ((10.0, 10.0, 1.5), 0.0),
        ((7.0, 10.0, 1.5), 1.5),
        ((7.0, 10.0, None), 3.0),
        ((None, 10.0, 1.5), 1.5),
        ((None, 10.0, None), None),
        ((7.0, None, None), None),
    ]
    got = evaluate(spark, "b double, m double, r double", [r for r, _ in rows],
                   small_order_fee(F.col("b"), F.col("m"), F.col("r")))
    assert got == [want for _, want in rows]


def test_labels(spark):
    flags = [(a, b) for a in (True, False, None) for b in (True, False, None)]
    got = evaluate(spark, "a boolean, b boolean", flags, voucher_label(F.col("a"), F.col("b")))
    assert [f for f, label in zip(flags, got) if label == "No DF Voucher"] == [(False, False)]
    got = evaluate(spark, "a boolean", [(True,), (False,), (None,)], subscription_label(F.col("a")))
    assert got == ["Y", "N", "N"]


def test_exact_sum(spark):
    def total(values):
        frame = spark.createDataFrame([(v,) for v in values], "x double")
        result = frame.agg(exact_sum(F.col("x"))).first()[0]
        return None if result is None else str(result)

    assert total([0.1] * 10) == "1.000000000000"
    assert total([-1.25, 0.1, None, 0.2]) == "-0.950000000000"
    assert total([None, None]) is None
    assert total([8e12] * 2_000) == "16000000000000000.000000000000"
    # A decimal holds no special amount; ``exact_total`` does.
    assert total([1.0, float("inf")]) is None and total([float("nan")]) is None


def test_exact_sum_keeps_small_digits(spark):
    for amount, expected in ((1 / 3, 1e6 / 3), (4e-7, 0.4)):
        rows = spark.range(1_000_000).select(F.lit(amount).alias("x"))
        assert float(rows.agg(exact_sum(F.col("x"))).first()[0]) == pytest.approx(expected, rel=1e-10)


def test_report_ratio_has_no_division_error(spark):
    assert evaluate(spark, "a double, b bigint", [(4.0, 2), (4.0, 0), (None, 2)],
                    ratio(F.col("a"), F.col("b"))) == [2.0, None, None]


def test_totals_with_special_amounts_are_those_of_doubles(spark):
    inf, nan = float("inf"), float("nan")
    groups = {
        "finite": [1.5, -2.25, None, 1e9], "none": [None, None], "nan": [nan, 1.0, inf], "up": [inf, 5.0, None, inf],
        "down": [-inf, 5.0], "both": [inf, -inf, 1.0], "zero": [0.0, -0.0]}
    frame = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs], "k string, v double").repartition(4)
    got = {r.k: (r.total, r.plain, r.exact) for r in frame.groupBy("k").agg(
        exact_total(F.col("v")).alias("total"), F.sum("v").alias("plain"), exact_sum(F.col("v")).alias("exact")).collect()}
    for k, (total, plain, exact) in got.items():
        assert total == plain or total != total and plain != plain
        assert (exact is None) == (k not in ("finite", "zero"))


def test_point_as_well_known_binary(spark, setting):
    import struct

    rows = [(10.0, 20.0), (None, 20.0), (190.0, -90.0), (-0.0, 5e-324), (1 / 3, -89.99999999999999)]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, x double, y double").withColumn(
        "point", geo_point(F.col("x"), F.col("y")))
    wanted = [(r.point.longitude, r.point.latitude) if r.point else None for r in frame.orderBy("i").collect()]

    def read(wkb):
        assert wkb is None or wkb[:5] == b"\0\0\0\0\1" and len(wkb) == 21
        return None if wkb is None else struct.unpack(">dd", wkb[5:])

    got = [read(r[0] and bytes(r[0])) for r in frame.orderBy("i").select(point_wkb(F.col("point"))).collect()]
    assert list(map(repr, got)) == list(map(repr, wanted)) and wanted[2] == (-170.0, -90.0)
    # Without the type the binary stands for the geography; with it the point reads back through it.
    assert not has_geography(spark)
    assert frame.select(as_geography(spark, F.col("point")).alias("g")).schema["g"].dataType.typeName() == "binary"
    setting("spark.sql.geospatial.enabled", "true")
    shown = frame.orderBy("i").select("i", as_geography(spark, F.col("point")).alias("g"))
    assert shown.schema["g"].dataType.typeName().startswith("geography")
    back = [read(r[0] and bytes(r[0])) for r in shown.select(F.call_function("st_asbinary", "g")).collect()]
    assert list(map(repr, back)) == list(map(repr, wanted))
