"""Aggregation to report marks, and totals fixed at a coarser level."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.money import MONEY, PARTS, added, exact_sum, from_parts, money_parts

ORDER = "platform_order_code"
MEASURES = ("gmv_eur", "gross_profit_eur", "gross_profit_eur_cf")
VENDOR_LEVEL = ("entity_id", "vendor_id")
VERTICAL_LEVEL = ("region", "entity_id", "vertical_type")
VENDOR_MARK = ("region", "entity_id", "vertical_type", "vendor_id")


def sums(rows: DataFrame, keys: Sequence[str], measures: Sequence[str] = MEASURES) -> DataFrame:
    """Decimal sums of order rows per key."""
    return rows.groupBy(*keys).agg(*[exact_sum(F.col(m)).alias(m) for m in measures])


def marks(rows: DataFrame, keys: Sequence[str], total: Callable[..., Column] = from_parts) -> DataFrame:
    """Sums (decimal, unless ``total`` makes another value of their parts) plus exact distinct orders, in two passes
    of ``rows``, which are a stored table.

    The sums are reduced to a row per mark in each task before their shuffle. The distinct orders are shuffled
    on key and order code, without the sums, so a vendor with most of the orders is spread over all tasks.
    """
    names = [f"{name}_{m}" for m in MEASURES for name in PARTS]
    parts = [part for m in MEASURES for part in money_parts(F.col(m))]
    summed = rows.select(*keys, *[p.alias(n) for n, p in zip(names, parts)]).groupBy(*keys).agg(
        *[part.alias(n) for n, part in zip(names, _added_parts(names))], F.lit(0).cast("bigint").alias("order_count"))
    codes = rows.filter(F.col(ORDER).isNotNull()).select(*keys, ORDER).distinct()
    orders = codes.groupBy(*keys).agg(F.count(F.lit(1)).alias("order_count"))
    both = summed.unionByName(orders, allowMissingColumns=True)
    sums_of = _added_parts(names)
    return both.groupBy(*keys).agg(
        F.sum("order_count").alias("order_count"),
        *[total(*sums_of[i:i + len(PARTS)]).alias(m) for i, m in zip(range(0, len(names), len(PARTS)), MEASURES)])


def _added_parts(names: Sequence[str]) -> list[Column]:
    """Parts of all measures, as columns, added up."""
    return [c for i in range(0, len(names), len(PARTS)) for c in added([F.col(n) for n in names[i:i + len(PARTS)]])]


def mark_id(keys: Sequence[str]) -> Column:
    """128 bits that tell marks apart, NULL keys included."""
    cells = [*[F.col(k) for k in keys], *[F.col(k).isNull() for k in keys]]
    return F.struct(F.xxhash64(*cells).alias("a"), F.xxhash64(F.lit(1), *cells).alias("b"))


def order_sets(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct orders as state that can be counted over any choice of marks: ``marks`` (ids) and ``orders``.

    A row says how many order codes occur in exactly these marks. Most codes occur in one, so there are about as
    many rows as marks, however many orders there are. An order that occurs in several chosen marks is one row,
    and so counts once. The codes themselves are shuffled once, each task's repeats taken out before, and spread
    by code, so a mark with most of the orders does not matter. States over disjoint codes add up.
    """
    per_order = rows.filter(F.col(ORDER).isNotNull()).groupBy(ORDER).agg(
        F.sort_array(F.collect_set(mark_id(keys))).alias("marks"))
    return per_order.groupBy("marks").agg(F.count(F.lit(1)).alias("orders"))


def orders_per_mark(sets: DataFrame) -> DataFrame:
    """``mark_id`` and its distinct orders."""
    each = sets.select(F.explode("marks").alias("mark_id"), "orders")
    return each.groupBy("mark_id").agg(F.sum("orders").alias("order_count"))


def orders_in_any(sets: DataFrame, shown: DataFrame) -> DataFrame:
    """One row: the distinct orders that occur in any of the marks ``shown`` (their ``mark_id``)."""
    each = sets.withColumn("row", F.monotonically_increasing_id()).select("row", "orders", F.explode("marks").alias("mark_id"))
    met = each.join(shown.select("mark_id"), "mark_id", "left_semi").dropDuplicates(["row"])
    return met.agg(F.coalesce(F.sum("orders"), F.lit(0)).alias("order_count"))


def counted(summed: DataFrame, sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Marks: the sums of ``summed`` with ``mark_id`` and their distinct orders."""
    known = summed.withColumn("mark_id", mark_id(keys)).join(orders_per_mark(sets), "mark_id", "left")
    return known.withColumn("order_count", F.coalesce("order_count", F.lit(0)))


def roll_up(marked: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """GMV per coarser key from already summed marks; sums add up, distinct counts would not."""
    return marked.groupBy(*keys).agg(F.sum("gmv_eur").alias(name))


def roll_up_sums(marked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All sums per coarser key from already summed marks."""
    return marked.groupBy(*keys).agg(*[F.sum(m).cast(MONEY).alias(m) for m in MEASURES])


def attach(marked: DataFrame, totals: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Put a coarser total on every row, once, matching NULL keys with NULL."""
    renamed = totals.select(*[F.col(k).alias(f"lod_{k}") for k in keys], name)
    condition = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"lod_{k}")) for k in keys])
    return marked.join(renamed, condition, "left").select(*marked.columns, name)
