"""Row counts around joins, taken while the rows pass, and a report of the keys that multiply them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from orderlens.operators.dimensions import entity_dimension
from orderlens.sources.schemas import Sources
from orderlens.sources.tables import duplicate_keys


class RowCounts:
    """Counts rows at named places of one plan, without a pass of their own; known after its action."""

    def __init__(self):
        self._seen: dict[str, Observation] = {}

    def at(self, place: str, frame: DataFrame) -> DataFrame:
        self._seen[place] = Observation(place)
        return frame.observe(self._seen[place], F.count(F.lit(1)).alias("rows"))

    def rows(self) -> dict[str, int]:
        """Rows by place, in the order of the plan."""
        return {place: seen.get["rows"] for place, seen in self._seen.items()}

    def multiplied(self) -> dict[str, int]:
        """Places that have more rows than the place before, and how many more."""
        counts = list(self.rows().items())
        return {place: n - before for (_, before), (place, n) in zip(counts, counts[1:]) if n > before}


def join_key_report(sources: Sources, zones: DataFrame) -> DataFrame:
    """How many join keys of each right side occur more than once, and the rows of the most frequent one."""
    subscription_key = ["uuid", "created_date_utc"]
    checked = {
        "subs_apac": (sources.subs_apac, subscription_key),
        "subs_eu": (sources.subs_eu, subscription_key),
        "entities": (entity_dimension(sources.entities).join(
            sources.sessions.select("entity_id"), "entity_id", "left_semi"), ["entity_id"]),
        "delivery_orders": (sources.delivery_orders, ["global_entity_id", "order_id"]),
        "platform_orders": (sources.platform_orders, ["global_entity_id", "code", "created_date_utc"]),
        "zones": (zones, ["entity_id", "country_code", "zone_id"]),
    }
    return reduce(DataFrame.unionByName, [
        duplicate_keys(frame, keys).agg(F.count(F.lit(1)).alias("repeated_keys"), F.max("count").alias("most_rows"))
        .withColumn("join_key", F.lit(name))
        for name, (frame, keys) in checked.items()
    ])
