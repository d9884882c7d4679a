"""Points as well-known binary, and as geographies where the session has that type."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def _bits(number: Column) -> Column:
    """Sixteen hex digits of a double, highest first."""
    raw = F.reflect(F.lit("java.lang.Double"), F.lit("doubleToRawLongBits"), number).cast("bigint")
    return F.lpad(F.hex(raw), 16, "0")


def point_wkb(point: Column) -> Column:
    """Well-known binary, big-endian, of a struct of longitude and latitude; NULL for a NULL point."""
    text = F.concat(F.lit("0000000001"), _bits(point["longitude"]), _bits(point["latitude"]))
    return F.when(point.isNotNull(), F.unhex(text))


def has_geography(spark: SparkSession) -> bool:
    return spark.catalog.functionExists("st_geogfromwkb") and spark.conf.get("spark.sql.geospatial.enabled") == "true"


def as_geography(spark: SparkSession, point: Column) -> Column:
    """The point as a geography, or as well-known binary in a session without that type.

    Parquet files hold no geography in this release, so stored tables keep the struct.
    """
    wkb = point_wkb(point)
    return F.call_function("st_geogfromwkb", wkb) if has_geography(spark) else wkb
