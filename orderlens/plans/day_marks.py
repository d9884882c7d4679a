"""Partial aggregates per day, kept up to date, from which reports over any filters are counted.

Two stored tables, in folders by month. ``cells``: one row per day and combination of all columns that reports
filter or group by (several for one with very many order rows), with the parts of its sums. ``orders``: how many order codes occur in this cell and in no other;
codes that occur in several cells are listed by name, a row per cell. The cell's id there is made from its columns as
they are read; only ``orders`` stores it. Sums and counts add up and names can be
counted once, so any filter on those columns picks cells, and what is picked gives the same marks as the order rows,
distinct orders included.

An update of some months reads those months of the order table, and of all others the order codes alone: months that
share a code with a changed one, now or as stored, are made anew as well, and no other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple, Optional

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.functions.money import PARTS, added, from_parts, money_parts
from orderlens.operators.filters import MEMBER_COLUMNS, context_condition
from orderlens.operators.lod import MEASURES, ORDER, VENDOR_MARK, mark_id
from orderlens.params import ViewFilters
from orderlens.session import pin
from orderlens.sources.versions import Folder, open_table, replace_partitions

DAY, MONTH = "created_date_utc", "month"
CELL = tuple(dict.fromkeys([DAY, *MEMBER_COLUMNS, *VENDOR_MARK]))
#: Order rows that one task reduces to cells and writes to one file, about.
ROWS_PER_FILE = 500_000
#: Parts of a month by cell, counted to see whether one cell has most of its rows, and from which multiple of the mean.
SLOTS, HOT = 64, 4


class DayMarks(NamedTuple):
    cells: DataFrame
    orders: DataFrame


def with_month(orders: DataFrame) -> DataFrame:
    return orders.withColumn(MONTH, F.coalesce(F.date_format(DAY, "yyyy-MM"), F.lit("none")))


def _slot(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(SLOTS)).cast("int")


def _sizes(rows: DataFrame, keys: Sequence[str]) -> dict[tuple[str, int], int]:
    """Rows by month and slot of ``keys``: few numbers, which say over how many tasks each is spread."""
    return {(r[MONTH], r["slot"]): r["count"] for r in rows.groupBy(MONTH, _slot(keys).alias("slot")).count().collect()}


def _per_month(sizes: Mapping[tuple[str, int], int]) -> dict[str, int]:
    months: dict[str, int] = {}
    for (month, _), n in sizes.items():
        months[month] = months.get(month, 0) + n
    return months


def _hot_slots(sizes: Mapping[tuple[str, int], int]) -> dict[str, int]:
    """Slots with far more rows than the others of their month, and over how many tasks these are spread."""
    months = _per_month(sizes)
    return {f"{m}/{slot}": n // ROWS_PER_FILE + 1 for (m, slot), n in sizes.items()
            if n > max(ROWS_PER_FILE, HOT * months[m] / SLOTS)}


def _hot_ways(hot: Mapping[str, int], keys: Sequence[str]) -> Column:
    return F.create_map(*[F.lit(v) for pair in hot.items() for v in pair])[F.concat_ws("/", MONTH, _slot(keys))]


def _bucket(sizes: Mapping[tuple[str, int], int], keys: Sequence[str], spread_by: Sequence[str]) -> Column:
    """Which task of its month a row goes to: by ``keys``, or by ``spread_by`` if their slot has far more rows than others."""
    files = F.create_map(*[F.lit(v) for m, n in _per_month(sizes).items() for v in (m, n // ROWS_PER_FILE + 1)])
    bucket = F.pmod(F.xxhash64(F.lit(1), *keys), F.coalesce(files[F.col(MONTH)], F.lit(1)))
    if hot := _hot_slots(sizes):
        ways = _hot_ways(hot, keys)
        # Numbers below 0 are of no key by itself.
        bucket = F.when(ways.isNotNull(), -1 - F.pmod(F.xxhash64(*spread_by), ways)).otherwise(bucket)
    return bucket


def _buckets(sizes: Mapping[tuple[str, int], int], keys: Sequence[str]) -> Column:
    """All tasks of a month that may have rows of these ``keys``."""
    one = F.array(_bucket(sizes, keys, keys).cast("bigint"))
    if hot := _hot_slots(sizes):
        ways = _hot_ways(hot, keys)
        return F.when(ways.isNotNull(), F.sequence(F.lit(-1).cast("bigint"), -ways.cast("bigint"))).otherwise(one)
    return one


def cells_of(orders: DataFrame, sizes: Mapping[tuple[str, int], int]) -> DataFrame:
    """Sums per cell, as parts that add up; each month lies in as many tasks as its order rows (``sizes``) need.

    Cells are nearly as many as order rows where few orders are alike, so the rows themselves are shuffled, once, to
    where their cells are written. A cell with very many rows lies in several tasks, and has a row from each.
    """
    bucket = _bucket(sizes, CELL, [ORDER, *MEASURES]).alias("bucket")
    laid = orders.select(MONTH, *CELL, *MEASURES, bucket).repartition(MONTH, "bucket")
    parts = [part.alias(f"{name}_{m}") for m in MEASURES for name, part in zip(PARTS, added(money_parts(F.col(m))))]
    return laid.groupBy(MONTH, "bucket", *CELL).agg(*parts).drop("bucket")


def _in_several(orders: DataFrame, codes: DataFrame, sizes: Mapping[tuple[str, int], int]) -> DataFrame:
    """Months and codes that are in several cells, as far as one task of a month cannot see that: codes of several
    ``codes`` months, and those of hot slots, whose cells lie in several tasks. The latter are reduced by hashing, in
    each task first: the least and greatest halves of a code's cell ids are longs."""
    months = F.count(F.lit(1)).over(Window.partitionBy(ORDER))
    found = codes.withColumn("months", months).filter("months > 1").select(MONTH, F.col(ORDER).alias("code"))
    if hot := _hot_slots(sizes):
        cell = mark_id(CELL)
        ends = orders.filter(_hot_ways(hot, [ORDER]).isNotNull()).select(
            MONTH, F.col(ORDER).alias("code"), cell["a"].alias("a"), cell["b"].alias("b")).groupBy(MONTH, "code").agg(
            *[f(h).alias(f"{n}_{h}") for h in "ab" for n, f in (("least", F.min), ("most", F.max))])
        found = found.unionByName(
            ends.filter("least_a <> most_a OR least_b <> most_b").select(MONTH, "code")).distinct()
    return found


def orders_of(orders: DataFrame, codes: DataFrame, sizes: Mapping[tuple[str, int], int]) -> DataFrame:
    """Distinct orders per cell: the number of codes that only it has, and by name those that others have as well.

    The codes with their cells are shuffled once, by month and code, to where the names are written; there each task
    sees the cells that a code has in the month. ``codes`` are those of all months, ``sizes`` rows by slot of the code.
    """
    met = orders.filter(F.col(ORDER).isNotNull()).select(
        MONTH, _bucket(sizes, [ORDER], CELL).alias("bucket"), F.col(ORDER).alias("code"), mark_id(CELL).alias("cell"),
    ).repartition(MONTH, "bucket").distinct()
    several = _in_several(orders, codes, sizes).select(
        MONTH, F.explode(_buckets(sizes, ["code"])).alias("bucket"), "code", F.lit(True).alias("listed"))
    cells = F.count(F.lit(1)).over(Window.partitionBy(MONTH, "bucket", "code"))
    marked = met.withColumn("cells", cells).join(several, [MONTH, "bucket", "code"], "left")
    by_name = (F.col("cells") > 1) | F.coalesce("listed", F.lit(False))
    alone = marked.filter(~by_name).groupBy(MONTH, "cell").agg(F.count(F.lit(1)).alias("orders"))
    names = marked.filter(by_name).select(MONTH, "cell", "code", F.lit(1).cast("bigint").alias("orders"))
    return names.unionByName(
        alone.hint("rebalance", MONTH).select(MONTH, "cell", F.lit(None).cast("string").alias("code"), "orders"))


def _touched(codes: DataFrame, stored: DataFrame, months: Sequence[str]) -> list[str]:
    """``months`` and those that share an order code with one of them, as it is in the order table or as stored.

    Of the stored codes only those of ``months`` are read: other months are in the order table as they are stored.
    """
    before = stored.filter(F.col(MONTH).isin(*months) & F.col("code").isNotNull()).select(F.col("code").alias("changed"))
    changed = codes.filter(F.col(MONTH).isin(*months)).select(F.col(ORDER).alias("changed")).unionByName(before).distinct()
    shared = codes.join(changed, F.col(ORDER) == F.col("changed"), "left_semi").select(MONTH).distinct()
    return sorted({*months, *(r[MONTH] for r in shared.collect())})


def _anew(sizes: Mapping[tuple[str, int], int], months: Sequence[str]) -> dict[tuple[str, int], int]:
    return {k: n for k, n in sizes.items() if k[0] in months} or {("none", 0): 0}


def update(orders: DataFrame, folder: str, months: Optional[Sequence[str]] = None) -> list[str]:
    """Make the state under ``folder`` that of ``orders``, of which only ``months`` changed (all, if not given).

    Returns the months that were made anew.
    """
    spark = orders.sparkSession
    rows = with_month(orders)
    sizes = _sizes(rows, CELL)
    codes = pin(rows.filter(F.col(ORDER).isNotNull()).select(MONTH, ORDER).distinct(), "order-codes")
    if months is None:
        # Months that only the stored state has go as well.
        known = [] if not _exists(spark, folder) else [
            r[MONTH] for r in open_table(spark, f"{folder}/cells").select(MONTH).distinct().collect()]
        touched = sorted({*known, *(m for m, _ in sizes)})
    else:
        touched = _touched(codes, open_table(spark, f"{folder}/orders"), months)
    anew = rows.filter(F.col(MONTH).isin(*touched))
    # The orders go first: until the cells follow, a report finds orders of cells that it does not know, and no others.
    by_code = _anew(_sizes(anew.filter(F.col(ORDER).isNotNull()), [ORDER]), touched)
    replace_partitions(orders_of(anew, codes, by_code), f"{folder}/orders", MONTH, touched, laid_out=True)
    replace_partitions(cells_of(anew, _anew(sizes, touched)), f"{folder}/cells", MONTH, touched, laid_out=True)
    return touched


def _exists(spark: SparkSession, folder: str) -> bool:
    return Folder(spark, f"{folder}/cells").current() is not None


def read(spark: SparkSession, folder: str) -> DayMarks:
    cells = open_table(spark, f"{folder}/cells").withColumn("cell", mark_id(CELL))
    return DayMarks(cells, open_table(spark, f"{folder}/orders"))


def _months(filters: ViewFilters) -> Column:
    """The months that a date filter can need, so that folders of others are not read."""
    if filters.created_date_utc is None:
        return F.lit(True)
    first, last = (str(d)[:7] for d in filters.created_date_utc)
    return F.col(MONTH).between(first, last)


def marks(state: DayMarks, filters: ViewFilters = ViewFilters(), keys: Sequence[str] = VENDOR_MARK) -> DataFrame:
    """Marks of the rows that meet ``filters``: keys, distinct orders and exact sums, as from the order rows."""
    cells = state.cells.filter(_months(filters) & context_condition(filters))
    sums = cells.groupBy(*keys).agg(*[
        from_parts(*added([F.col(f"{name}_{m}") for name in PARTS])).alias(m) for m in MEASURES])
    own = cells.select("cell", mark_id(keys).alias("mark")).repartition("cell").distinct()
    met = state.orders.filter(_months(filters)).select("cell", "code", "orders").join(own, "cell")
    # A code by name is one order, in however many cells of the mark; the others are in one cell each.
    by_name = met.groupBy("mark", "code").agg(F.sum("orders").alias("orders"))
    counts = by_name.groupBy("mark").agg(F.sum(F.when(F.col("code").isNull(), F.col("orders"))).alias("alone"),
                                         F.count("code").alias("repeated"))
    total = (F.coalesce("alone", F.lit(0)) + F.coalesce("repeated", F.lit(0))).alias("order_count")
    joined = sums.withColumn("mark", mark_id(keys)).join(counts, "mark", "left")
    return joined.select(*keys, total, *MEASURES)
