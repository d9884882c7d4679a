"""Left joins to a lookup table that may be too large to broadcast, on keys of which few may be hot."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.session import pin

#: Rows of one key that one task should join.
ROWS_PER_TASK = 1_000_000
_SALT, _SALTS = "salt_", "salts_"


def fits_broadcast(stored: DataFrame) -> bool:
    """Whether a stored table is below the session's broadcast threshold, by the size of its files."""
    spark = stored.sparkSession
    size = int(str(stored._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size <= spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def hot_keys(rows: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys of more than ``rows_per_task`` rows, with the number of parts that each is cut into.

    One pass over the key columns alone. At most rows / rows_per_task keys come out.
    """
    counts = rows.select(*keys).dropna().groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") > rows_per_task).select(*keys, F.ceil(F.col("n") / rows_per_task).cast("int").alias(_SALTS))


def _matched(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k] == right[f"r_{k}"] for k in keys])


def _renamed(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    return frame.withColumnsRenamed({k: f"r_{k}" for k in keys})


def attach_lookup(
    rows: DataFrame, lookup: DataFrame, keys: Sequence[str], counted: DataFrame, spread_by: Sequence[str],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``rows`` with the other columns of ``lookup``, as a left join on ``keys`` gives them.

    ``lookup`` is a stored table. While it fits a broadcast, that is all. Beyond it the rows are shuffled on the
    keys, and keys that are hot in ``counted`` (rows of the same keys, cheap to read) are salted: their rows are
    dealt to several parts by a hash of ``spread_by``, and their lookup rows are copied to each part. Rows
    without a key match nothing and are dealt to all tasks.
    """
    if fits_broadcast(lookup):
        return rows.join(lookup, list(keys), "left")
    hot = _renamed(pin(hot_keys(counted, keys, rows_per_task), "hot-keys"), keys)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lost = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    dealt = F.pmod(F.xxhash64(*spread_by), F.when(lost, parts).otherwise(F.coalesce(_SALTS, F.lit(1)))).cast("int")
    salted = rows.join(hot, _matched(rows, hot, keys), "left").withColumn(_SALT, dealt).select(*rows.columns, _SALT)
    copies = lookup.join(hot, _matched(lookup, hot, keys), "left").select(
        *lookup.columns, F.explode(F.sequence(F.lit(0), F.coalesce(_SALTS, F.lit(1)) - 1)).alias(_SALT))
    return salted.join(copies, [*keys, _SALT], "left").drop(_SALT)
