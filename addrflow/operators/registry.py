"""Which sources to read: active servers from a registry, closed tenant databases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrflow.operators.filters import in_window


def active_servers(registry: DataFrame, excluded: DataFrame | None = None) -> DataFrame:
    """Distinct ``db`` of entries with production = 'true' and active = 'true', minus ``excluded``."""
    live = registry.filter((F.col("production") == "true") & (F.col("active") == "true")).select("db").distinct()
    if excluded is None:
        return live
    return live.join(excluded.select(F.col("db").alias("_x")), F.col("db") == F.col("_x"), "left_anti")


def empty_schemas(schemata: DataFrame, tables: DataFrame) -> DataFrame:
    """Schemas without any table (LEFT OUTER JOIN ... IS NULL, i.e. an anti join)."""
    return schemata.join(
        tables.select(F.col("TABLE_SCHEMA").alias("_ts")).distinct(), F.col("SCHEMA_NAME") == F.col("_ts"), "left_anti"
    ).select("SCHEMA_NAME")


def not_in(df: DataFrame, c: str, values: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``c`` is NOT IN ``values`` (one column), with SQL's NULL semantics.

    One anti join, and a one-row count of the list as a scalar subquery: a NULL in the list empties
    the result, and a NULL value is dropped unless the list is empty. Nothing runs before the query
    does, and no list is broadcast for its NULLs' sake.
    """
    name = values.columns[0]
    counts = values.agg(
        F.struct(F.count("*").alias("n"), F.count_if(F.col(name).isNull()).alias("nulls")).alias("counts")
    ).scalar()
    allowed = (counts["nulls"] == 0) & (F.col(c).isNotNull() | (counts["n"] == 0))
    listed = values.filter(F.col(name).isNotNull()).select(F.col(name).alias("_v"))
    return df.filter(allowed).join(listed, F.col(c) == F.col("_v"), "left_anti")


def closed_databases(
    terminated: DataFrame,
    schemata: DataFrame,
    tables: DataFrame,
    from_ts: str,
    till_ts: str,
    system_schemas: tuple[str, ...],
) -> DataFrame:
    """Databases of closed production tenants still worth reading.

    type = 'production', not an empty schema (NULL-aware NOT IN: a NULL in the list empties the
    result), terminated inside the window or not dated, and not a system schema.
    """
    on = F.col("terminated_on")
    when_ok: Column = on.isNull() | in_window(on, terminated.schema["terminated_on"].dataType, from_ts, till_ts)
    server = F.col("terminated_server")
    live = terminated.filter((F.col("type") == "production") & when_ok)
    kept = not_in(live, "terminated_server", empty_schemas(schemata, tables))
    return kept.filter(~server.isin(*system_schemas)).select(server.alias("db")).distinct()
