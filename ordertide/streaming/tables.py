"""Schema and table provisioning (S12-S15), idempotent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ordertide.schemas import BRONZE_COLUMNS, SILVER_COLUMNS

# Table properties applied when the table format is delta.
BRONZE_DELTA_PROPS = {
    "delta.enableChangeDataFeed": "true",
    "delta.autoOptimize.optimizeWrite": "true",
    "delta.autoOptimize.autoCompact": "true",
}
SILVER_DELTA_PROPS = {
    "delta.autoOptimize.optimizeWrite": "true",
    "delta.autoOptimize.autoCompact": "true",
}


def _columns(columns) -> str:
    return ",\n  ".join(f"`{n}` {t} COMMENT '{c}'" for n, t, c in columns)


def _props(fmt: str, props: dict) -> str:
    if fmt != "delta":
        return ""
    body = ", ".join(f"'{k}' = '{v}'" for k, v in props.items())
    return f"\nTBLPROPERTIES ({body})"


def qualified(database: str, name: str, catalog: str | None = None) -> str:
    return ".".join(p for p in (catalog, database, name) if p)


def resolved(name: str, database: str, catalog: str | None = None) -> str:
    """The full name of a table given by one, two or three parts; DDL and writer both use it."""
    parts = name.split(".")
    if len(parts) == 1:
        parts = [database, *parts]
    if len(parts) == 2 and catalog:
        parts = [catalog, *parts]
    return ".".join(parts)


def create_schema(spark: SparkSession, database: str, catalog: str | None = None) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {qualified(database, '', catalog).rstrip('.')}")


def bronze_ddl(table: str, fmt: str = "parquet", partition_by=()) -> str:
    columns = BRONZE_COLUMNS
    if "published_date" in partition_by:
        columns = columns + (("published_date", "DATE", "UTC publication date (replay pruning)"),)
    part = f"\nPARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    return (f"CREATE TABLE IF NOT EXISTS {table} (\n  {_columns(columns)}\n) USING {fmt}{part}\n"
            f"COMMENT 'Bronze: append-only audit log of raw order events'{_props(fmt, BRONZE_DELTA_PROPS)}")


def silver_ddl(table: str, fmt: str = "parquet", partition_by=("window_date",)) -> str:
    columns = SILVER_COLUMNS
    if "window_date" in partition_by:
        columns = columns + (("window_date", "DATE", "UTC date of the window start"),)
    part = f"\nPARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    return (f"CREATE TABLE IF NOT EXISTS {table} (\n  {_columns(columns)}\n) USING {fmt}{part}\n"
            f"COMMENT 'Silver: per-store window metrics'{_props(fmt, SILVER_DELTA_PROPS)}")


def provision(spark: SparkSession, database: str, bronze: str | None, silver: str | None,
              fmt: str = "parquet", catalog: str | None = None,
              silver_partition_by=("window_date",), bronze_partition_by=()) -> DataFrame:
    """Creates schemas and tables if missing; returns the schema's table list.
    Tables may be named by one, two or three parts (``resolved``)."""
    create_schema(spark, database, catalog)
    for name, ddl, partition_by in ((bronze, bronze_ddl, bronze_partition_by), (silver, silver_ddl, silver_partition_by)):
        if name:
            table = resolved(name, database, catalog)
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {table.rpartition('.')[0]}")
            spark.sql(ddl(table, fmt, partition_by))
    return spark.sql(f"SHOW TABLES IN {qualified(database, '', catalog).rstrip('.')}")
