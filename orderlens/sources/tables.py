"""Reading source tables and publishing result tables."""

from __future__ import annotations

import re
from typing import Mapping, Optional, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from orderlens.params import BatchParams
from orderlens.sources.schemas import SOURCE_SCHEMAS, Sources
from orderlens.sources.versions import VERSION, Folder, open_table, publish


def conform(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns a job reads, flat ones in their declared type.

    Nested columns stay as stored, so their structs may hold more fields than the job uses.
    """
    return frame.select(*[
        frame[f.name] if isinstance(f.dataType, (T.ArrayType, T.StructType))
        else frame[f.name].cast(f.dataType).alias(f.name)
        for f in schema
    ])


def read_sources(spark: SparkSession, paths: Mapping[str, str]) -> Sources:
    """Parquet folders or tables in versions, one per source name."""
    return Sources(**{
        name: conform(open_table(spark, paths[name]), schema)
        for name, schema in SOURCE_SCHEMAS.items()
    })


#: Conditions on the two large named tables, as typed parameters of their SQL.
NAMED_CONDITIONS = {
    "sessions": "WHERE created_date BETWEEN :first AND :last AND array_contains(:entities, entity_id)",
    "platform_orders": "WHERE created_date_utc BETWEEN :first AND :last AND array_contains(:entities, global_entity_id)",
}


def read_catalog_sources(
    spark: SparkSession, tables: Mapping[str, str], params: Optional[BatchParams] = None,
) -> Sources:
    """Catalog tables, one per source name, read by SQL with named parameters.

    With ``params`` the large ones are cut to its window and entities, as dates and an array of strings, never as text.
    """
    if missing := set(SOURCE_SCHEMAS) - set(tables):
        raise ValueError(f"no table named for {sorted(missing)}")
    found = {}
    for name, schema in SOURCE_SCHEMAS.items():
        args: dict = {"table": tables[name]}
        condition = NAMED_CONDITIONS.get(name, "") if params else ""
        if condition:
            args |= {"first": params.start_date, "last": params.end_date, "entities": list(params.entity_ids)}
        found[name] = conform(spark.sql(f"SELECT * FROM IDENTIFIER(:table) {condition}", args=args), schema)
    return Sources(**found)


def publish_table(df: DataFrame, table: str, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Create or replace the catalog's ``table``: a view of the rows just written under ``path``.

    The rows are whole before the view moves to them, in one step of the catalog. The view reads a table of its
    own for each version, whose predecessors are dropped afterwards; their files go as ``publish`` says. A stored
    table of the view's name is renamed, and dropped once the view stands.
    """
    spark = df.sparkSession
    publish(df, path, partition_by)
    version = Folder(spark, path).current()
    behind = f"{table}_{version.made_by}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in version.schema)
    parts = ", ".join(f"`{c}`" for c in (*partition_by, VERSION))
    spark.sql(f"CREATE TABLE {behind} ({columns}, `{VERSION}` string) USING parquet PARTITIONED BY ({parts}) LOCATION '{path}'")
    spark.sql(f"MSCK REPAIR TABLE {behind}")
    old = None
    if spark.catalog.tableExists(table) and spark.catalog.getTable(table).tableType != "VIEW":
        old = f"{table}_before"
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    listed = ", ".join(f"`{f.name}`" for f in version.schema)
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT {listed} FROM {behind} WHERE `{VERSION}` = '{version.made_by}'")
    database, _, name = table.rpartition(".")
    for other in spark.catalog.listTables(database or None):
        older = re.fullmatch(re.escape(name) + "_[0-9a-f]{32}", other.name) and not behind.endswith(other.name)
        if older and not other.isTemporary:
            spark.sql(f"DROP TABLE {database + '.' if database else ''}{other.name}")
    if old:
        spark.sql(f"DROP TABLE {old}")
    return spark.table(table)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join keys that occur more than once and would multiply order rows; reported, never removed."""
    return df.dropna(subset=list(keys)).groupBy(*keys).count().filter("count > 1")
