"""Order-insensitive comparison of a Spark query with its SQL in the checking engine."""

from __future__ import annotations

import math
import os
from collections import Counter

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def sql_rows(sql: str, sf_dir: str):
    with duckdb.connect() as db:
        for name in TABLES:
            path = os.path.join(sf_dir, f"{name}.parquet")
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
        result = db.execute(sql)
        names = [d[0] for d in result.description]
        return names, result.fetchall()


def normal(names, rows) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)

    def cell(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else repr(value + 0.0)
        return repr(value)

    return Counter(tuple(cell(row[i]) for i in order) for row in rows)


def difference(frame, sql: str, sf_dir: str):
    """Rows only in Spark and rows only in SQL, both empty when the results agree."""
    names, expected = sql_rows(sql, sf_dir)
    assert sorted(names) == sorted(frame.columns)
    left = normal(frame.columns, [tuple(r) for r in frame.collect()])
    right = normal(names, expected)
    return left - right, right - left, sum(left.values())
