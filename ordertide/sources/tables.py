"""Readers for the given parquet tables and for written result tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, streaming: bool = False,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """One test table, as a batch or as a file stream of the same schema.

    The stream lists the table's folder and keeps only the table's files
    (``pathGlobFilter``), so a table stored as many files streams file by file.
    """
    path = table_path(sf_dir, name)
    if not streaming:
        return spark.read.parquet(path)
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if os.path.isfile(path):
        # a single-file table: stream its folder, keep only this file
        return reader.option("pathGlobFilter", os.path.basename(path)).load(os.path.dirname(path))
    return reader.load(path)


def read_result(spark: SparkSession, table: str | None = None, path: str | None = None,
                fmt: str = "parquet", merge_schema: bool = False) -> DataFrame:
    """A result table by catalog name, else by path (S7); ``merge_schema`` reads files of
    several versions as their superset (S11)."""
    if table:
        return spark.table(table)
    if not path:
        raise ValueError("need a table name or a path")
    return spark.read.option("mergeSchema", str(merge_schema).lower()).format(fmt).load(path)


def read_bronze(spark: SparkSession, table: str | None = None, path: str | None = None,
                fmt: str = "parquet", since=None, until=None) -> DataFrame:
    """The audit table for a replay, optionally limited to ``[since, until)``
    publish time (datetimes in UTC). The bounds become partition filters on
    ``published_date`` (when the table has it) and pushed-down Parquet filters
    on ``kafka_published_timestamp``."""
    import datetime as dt

    from pyspark.sql import functions as F

    def utc(t):
        if isinstance(t, dt.datetime) and t.tzinfo is None:
            return t.replace(tzinfo=dt.timezone.utc)
        return t

    since, until = utc(since), utc(until)
    df = read_result(spark, table, path, fmt)
    has_date = "published_date" in df.columns
    ts = F.col("kafka_published_timestamp")
    if since is not None:
        df = df.filter(ts >= F.lit(since).cast("timestamp"))
        if has_date:
            df = df.filter(F.col("published_date") >= F.lit(since.astimezone(dt.timezone.utc).date()))
    if until is not None:
        df = df.filter(ts < F.lit(until).cast("timestamp"))
        if has_date:
            df = df.filter(F.col("published_date") <= F.lit(until.astimezone(dt.timezone.utc).date()))
    return df
