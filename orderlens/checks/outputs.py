"""Comparable output columns, stated once for the Spark query and for its SQL.

Amounts come out as doubles cut to a fixed number of decimals, dates and flags as text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# kind -> decimals kept first, decimals of the result
ROUNDING = {"money": (6, 4), "row": (6, 6), "share": (8, 8), "average": (8, 8)}


def columns(text: str) -> dict[str, str]:
    """'kind: name name; kind: name' to name -> kind."""
    result = {}
    for part in text.split(";"):
        kind, names = part.split(":")
        result.update({n: kind.strip() for n in names.split()})
    return result


def spark_output(df: DataFrame, outputs: dict[str, str]) -> DataFrame:
    def column(name: str, kind: str):
        value = F.col(name)
        if kind in ROUNDING:
            kept, shown = ROUNDING[kind]
            value = value.cast(f"decimal(38,{kept})")
            value = (value if kept == shown else F.round(value, shown)).cast("double")
        elif kind == "int":
            value = value.cast("bigint")
        elif kind == "text":
            value = value.cast("string")
        return value.alias(name)

    return df.select(*[column(n, k) for n, k in outputs.items()])


def sql_output(query: str, outputs: dict[str, str]) -> str:
    def column(name: str, kind: str) -> str:
        if kind in ROUNDING:
            kept, shown = ROUNDING[kind]
            return f"CAST(ROUND(CAST({name} AS DECIMAL(38,{kept})), {shown}) AS DOUBLE) AS {name}"
        if kind == "int":
            return f"CAST({name} AS BIGINT) AS {name}"
        if kind == "text":
            return f"CAST({name} AS VARCHAR) AS {name}"
        return name

    listed = ",\n       ".join(column(n, k) for n, k in outputs.items())
    return f"SELECT {listed}\nFROM (\n{query.strip()}\n) AS result_rows"
