"""Report filters, in the order they apply.

context filters -> fixed totals -> selected keys -> non-null measures -> running-share range
"""

from __future__ import annotations

from dataclasses import fields
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.params import ViewFilters

MEMBER_COLUMNS = tuple(f.name for f in fields(ViewFilters) if f.name != "created_date_utc")

# The filters that offer only members left over by the other filters.
CASCADING_COLUMNS = ("entity_id", "city_name", "zone_name", "vertical_type")


def member_filter(column: Column, members: Sequence) -> Column:
    """Listed members; a listed None keeps NULL. Never NULL itself."""
    known = [m for m in members if m is not None]
    parts = [column.isNotNull() & column.isin(*known)] if known else []
    if None in members:
        parts.append(column.isNull())
    return reduce(lambda a, b: a | b, parts, F.lit(False)) if parts else F.lit(False)


def context_condition(filters: ViewFilters) -> Column:
    conditions = []
    if filters.created_date_utc is not None:
        first, last = (F.lit(d).cast("date") for d in filters.created_date_utc)
        conditions.append(F.col("created_date_utc").between(first, last))
    for name in MEMBER_COLUMNS:
        members = getattr(filters, name)
        if members is not None:
            conditions.append(member_filter(F.col(name), members))
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def apply_context(orders: DataFrame, filters: ViewFilters) -> DataFrame:
    return orders.filter(context_condition(filters))


def filter_domains(
    orders: DataFrame, filters: ViewFilters, columns: Sequence[str] = CASCADING_COLUMNS,
) -> DataFrame:
    """Members each filter still offers, that is, those left by all the *other* filters.

    One scan serves all columns. Rows are first reduced to distinct combinations of the columns
    and of which of them the row offers; only those few are then listed column by column.
    """
    offered = {name: context_condition(filters.without(name)) for name in columns}
    combinations = orders.select(
        *columns, *[condition.alias(f"offers_{name}") for name, condition in offered.items()],
    ).filter(reduce(lambda a, b: a | b, [F.col(f"offers_{name}") for name in columns])).distinct()
    offers = F.array(*[
        F.when(F.col(f"offers_{name}"), F.struct(F.lit(name).alias("filter_column"), F.col(name).alias("member")))
        for name in columns
    ])
    return (
        combinations.select(F.explode(F.array_compact(offers)).alias("offer"))
        .select("offer.filter_column", "offer.member")
        .distinct()
    )


def keep_selected(rows: DataFrame, selected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys were selected in another report; NULL selects NULL."""
    chosen = selected.select(*[F.col(k).alias(f"selected_{k}") for k in keys]).distinct()
    condition = reduce(
        lambda a, b: a & b,
        [F.col(k).eqNullSafe(F.col(f"selected_{k}")) for k in keys],
    )
    return rows.join(chosen, condition, "left_semi")


def keep_known_measures(marks: DataFrame) -> DataFrame:
    """Groups whose GMV and profit sums are both known."""
    return marks.filter(F.col("gmv_eur").isNotNull() & F.col("gross_profit_eur").isNotNull())


def share_range(marks: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Cut on a running share; applied after the running sums, which it does not change."""
    return marks.filter(F.col(column).between(low, high))
