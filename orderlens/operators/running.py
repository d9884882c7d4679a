"""Running sums and previous-row values over ordered marks, without a one-task window."""

from __future__ import annotations

from functools import reduce
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.session import pin

ROWS_PER_TASK = 1_000_000
_CHUNK, _POSITION = "chunk_", "position_"


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"r_{k}"]) for k in keys])


def chunk_count(rows: int, rows_per_task: int, partitions: int) -> int:
    """Chunks of ``rows_per_task``, but not more than ``partitions`` unless those would be over ``ROWS_PER_TASK``."""
    return min(-(-rows // rows_per_task), max(partitions, -(-rows // ROWS_PER_TASK)))


def running(
    marked: DataFrame, pane: Sequence[str], order: Sequence[Column],
    sums: Mapping[str, Column], position: str, rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Running sums down each pane, and the row's position in it.

    ``order`` must be total within a pane. Up to ``rows_per_task`` marks an ordinary window
    does. Beyond that the marks are range-partitioned on pane and order, so even a pane holding
    most of them is cut into chunks; each chunk is summed alone and shifted by the totals of the
    chunks before it. There are at most as many chunk totals as range partitions and panes.

    Small chunks are merged until there are no more than the session's shuffle partitions, as a task for each
    few marks would have the number of tasks, files and shuffle blocks grow with the marks.
    """
    outputs = {position: F.lit(1).cast("bigint"), **sums}
    # The types an ordinary window gives, whichever way the sums are made.
    types = {f.name: f.dataType for f in marked.select(*[F.sum(v).alias(n) for n, v in outputs.items()]).schema}
    tasks = chunk_count(marked.count(), rows_per_task, int(marked.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    upto = (Window.unboundedPreceding, Window.currentRow)
    if tasks <= 1:
        window = Window.partitionBy(*(pane or [F.lit(0)])).orderBy(*order).rowsBetween(*upto)
        return marked.withColumns({n: F.sum(v).over(window) for n, v in outputs.items()})

    chunked = pin(
        marked.repartitionByRange(tasks, *[F.col(k).asc_nulls_first() for k in pane], *order)
        .withColumn(_CHUNK, F.spark_partition_id()),
        "chunks",
    )
    totals = chunked.groupBy(*pane, _CHUNK).agg(*[F.sum(v).alias(f"r_{n}") for n, v in outputs.items()])
    before = Window.partitionBy(*(pane or [F.lit(0)])).orderBy(_CHUNK).rowsBetween(
        Window.unboundedPreceding, -1)
    keys = [*pane, _CHUNK]
    shifts = totals.select(
        *[F.col(k).alias(f"r_{k}") for k in keys],
        *[F.sum(f"r_{n}").over(before).alias(f"before_{n}") for n in outputs],
    )
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*upto)
    inside = chunked.withColumns({n: F.sum(v).over(window) for n, v in outputs.items()})
    shifted = inside.join(shifts, _same(inside, shifts, keys), "left")
    return shifted.select(
        *marked.columns,
        *[_add_known(F.col(n), F.col(f"before_{n}"), types[n]).alias(n) for n in outputs],
    )


def _add_known(inside: Column, before: Column, result: T.DataType) -> Column:
    """Sum of the known parts, as a running sum skips NULL.

    Two decimals of full precision would lose a digit when added, so both give up a leading one.
    """
    if isinstance(result, T.DecimalType):
        narrow = T.DecimalType(result.precision - 1, result.scale)
        inside, before = inside.cast(narrow), before.cast(narrow)
    return F.coalesce(inside + before, inside, before).cast(result)


def previous(
    marked: DataFrame, pane: Sequence[str], order: Sequence[Column],
    values: Mapping[str, str], rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Value of the row before, NULL on the first row of a pane: output name -> column name."""
    if marked.count() <= rows_per_task:
        window = Window.partitionBy(*(pane or [F.lit(0)])).orderBy(*order)
        return marked.withColumns({n: F.lag(v).over(window) for n, v in values.items()})
    placed = pin(running(marked, pane, order, {}, _POSITION, rows_per_task), "positions")
    keys = [*pane, _POSITION]
    shifted = placed.select(
        *[F.col(k).alias(f"r_{k}") for k in pane],
        (F.col(_POSITION) + 1).alias(f"r_{_POSITION}"),
        *[F.col(v).alias(n) for n, v in values.items()],
    )
    return placed.join(shifted, _same(placed, shifted, keys), "left").select(*marked.columns, *values)
