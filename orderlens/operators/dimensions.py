"""Zone table and entity dimension."""

from __future__ import annotations

from typing import Optional

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.params import BatchParams

# Entities that take no part in the analysis.
EXCLUDED_PATTERNS = ("ODR%", "DN_%")  # "_" is the one-character wildcard
EXCLUDED_ENTITIES = ("FP_DE", "FP_JP", "TB_SA", "HS_BH")


def flatten_zones(countries: DataFrame, params: BatchParams) -> DataFrame:
    """Country -> platform x city -> zone, one row per platform and active zone.

    Each level is filtered as soon as it is unnested, so inactive cities are gone before their
    zones are expanded. The filters reject what an outer unnest would add, so inner ones do.
    """
    platforms = (
        countries
        .select("country_code", "cities", F.explode("platforms").alias("platform"))
        .select("country_code", "cities", "platform.entity_id")
        .filter(F.col("entity_id").isin(*params.entity_ids))
    )
    cities = (
        platforms
        .select("entity_id", "country_code", F.explode("cities").alias("city"))
        .filter("city.is_active")
    )
    return (
        cities
        .select("entity_id", "country_code", "city.name", "city.id", F.explode("city.zones").alias("zone"))
        .filter("zone.is_active")
        .select(
            "entity_id",
            "country_code",
            F.col("name").alias("city_name"),
            F.col("id").alias("city_id"),
            F.col("zone.shape").alias("zone_shape"),
            F.col("zone.name").alias("zone_name"),
            F.col("zone.id").alias("zone_id"),
        )
    )


def entity_dimension(entities: DataFrame, sessions: Optional[DataFrame] = None) -> DataFrame:
    """One row per platform entity that takes part, with its region.

    With ``sessions``, only entities that have sessions are kept. Their distinct ids are reduced
    before the shuffle, so the scan of one column sends a handful of rows per task.
    """
    entity = F.col("entity_id")
    kept = (
        entities
        .select("region", "country_iso", "country_name", F.explode_outer("platforms").alias("platform"))
        .select("region", F.col("platform.entity_id").alias("entity_id"), "country_iso", "country_name")
        .filter(~entity.isin(*EXCLUDED_ENTITIES))
    )
    for pattern in EXCLUDED_PATTERNS:
        kept = kept.filter(~entity.like(pattern))
    if sessions is None:
        return kept
    return kept.join(sessions.select("entity_id").distinct(), "entity_id", "left_semi").select(kept.columns)
