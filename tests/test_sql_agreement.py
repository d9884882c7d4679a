"""Every registered query gives the rows of its SQL, over whole tables."""

import pytest
from compare import difference, sql_rows
from conftest import CHECK, SMOKE

import __spark_entry__ as contract
from orderlens.checks.registry import QUERIES as REGISTERED
from orderlens.session import tune

# The queries of a subpackage that may be absent have tests of their own.
QUERIES = {name: query for name, query in contract.queries().items() if name in REGISTERED}
SQL = {name: sql for name, sql in contract.oracle_sql().items() if name in REGISTERED}


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_rows_agree(spark, name):
    only_spark, only_sql, _ = difference(QUERIES[name](spark, CHECK), SQL[name], CHECK)
    assert not only_spark and not only_sql, (list(only_spark)[:2], list(only_sql)[:2])


def test_entry(spark):
    frame = contract.entry(spark)
    only_spark, only_sql, rows = difference(frame, SQL["vendor_agg_metrics"], SMOKE)
    assert rows and not only_spark and not only_sql


def cells(names, rows, outputs):
    """Rows as key cells and amounts, by the keys."""
    keys = [n for n, kind in outputs.items() if kind not in ("money", "row", "average", "share")]
    amounts = [n for n in outputs if n not in keys]
    at = {n: i for i, n in enumerate(names)}
    return sorted((tuple(str(r[at[k]]) for k in keys), tuple(None if r[at[a]] is None else float(r[at[a]]) for a in amounts)) for r in rows)


MONEY_TOTALS = [name for name, q in REGISTERED.items() if "money" in q.outputs.values() and name != "vendor_view_long"]


@pytest.mark.parametrize("name", MONEY_TOTALS)
def test_amounts_agree_to_twelve_digits(spark, name):
    """Unrounded amounts against plain sums of doubles: relative to the largest amount that a total adds."""
    query = REGISTERED[name]
    frame = query.frame(tune(spark), CHECK).select(*query.outputs)
    names, expected = sql_rows(f"SELECT {', '.join(query.outputs)} FROM ({query.sql.strip()}) AS q", CHECK)
    left, right = cells(frame.columns, frame.collect(), query.outputs), cells(names, expected, query.outputs)
    assert [k for k, _ in left] == [k for k, _ in right]
    amounts = [abs(v) for _, row in right for v in row if v is not None]
    largest = max(amounts, default=0.0)
    for (_, got), (_, want) in zip(left, right):
        for a, b in zip(got, want):
            assert (a is None) == (b is None) and (a is None or abs(a - b) <= 1e-12 * largest)
