"""Schema registry as a table, and restart of a stream on a schema it meets for the first time.

A stream is planned with the versions that are registered when it starts. Its frames are joined with the
registry table (a stream-static join), so a frame of an id that nobody registered is told from one that was
registered after the start, if the table's format shows a running query new rows (Parquet files do not). Both stop
the query before the batch is committed; ``run_registered`` registers an id that a schema can be had for and
starts the query again on the same checkpoint, so no frame is lost or taken twice.
"""

from __future__ import annotations

import re
from typing import Callable, Iterable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ordertide.functions.framing import frame_magic, frame_schema_id
from ordertide.operators.decode import Schema, as_struct, decode_by_schema_id

ENTRY = "schema_id LONG, schema STRING"
UNKNOWN, LATER = "unregistered schema id", "schema id registered after this start:"


class SchemaRegistry:
    """(schema_id, schema) rows under ``path``: schema texts, a row for each version."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        spark.createDataFrame([], ENTRY).write.mode("ignore").parquet(path)

    def frame(self) -> DataFrame:
        return self.spark.read.schema(ENTRY).parquet(self.path).distinct()

    def schemas(self) -> dict[int, Schema]:
        """All registered versions: a plan needs each of them, so their texts are read by the driver."""
        return {r["schema_id"]: r["schema"] for r in self.frame().orderBy("schema_id").collect()}

    def register(self, schema_id: int, schema: Schema) -> None:
        """Adds a version; a registered id keeps its schema."""
        text = schema if isinstance(schema, str) else schema.simpleString()[len("struct<"):-1]
        known = self.schemas().get(int(schema_id))
        if known is not None:
            if as_struct(known) != as_struct(text):
                raise ValueError(f"schema id {schema_id} is registered with another schema")
            return
        as_struct(text)                           # a text that is no schema is refused here, not in a batch
        self.spark.createDataFrame([(int(schema_id), text)], ENTRY).coalesce(1).write.mode("append").parquet(self.path)

    def unregistered(self, log: DataFrame, value_col: str = "value") -> DataFrame:
        """(schema_id, n) of well-framed records whose id is not registered."""
        ids = log.filter(frame_magic(value_col) == "00").select(frame_schema_id(value_col).alias("schema_id")).filter("schema_id is not null")
        return ids.groupBy("schema_id").agg(F.count(F.lit(1)).alias("n")).join(self.frame(), "schema_id", "left_anti")


def decode_registered(raw: DataFrame, registry: SchemaRegistry, body_format: str = "json", mode: str = "PERMISSIVE",
                      value_col: str = "value", keep: Iterable[str] = (), fields: Iterable[str] | None = None) -> DataFrame:
    """Decodes by schema id with what is registered now; a batch with any other id fails and names the id."""
    planned = registry.schemas()
    if not planned:
        raise ValueError("no schema is registered")
    known = registry.frame().select(F.col("schema_id").alias("__known"))
    v = F.col(value_col)
    told = raw.withColumn("__id", F.when(frame_magic(v) == "00", frame_schema_id(v))).join(known, F.col("__id") == F.col("__known"), "left")
    stray = F.col("__id").isNotNull() & ~F.col("__id").isin(*planned)
    why = F.when(F.col("__known").isNull(), F.lit(UNKNOWN)).otherwise(F.lit(LATER))
    checked = F.when(stray, F.raise_error(F.concat_ws(" ", why, F.col("__id").cast("string"))).cast("binary")).otherwise(v)
    return decode_by_schema_id(told.withColumn(value_col, checked), planned, body_format, mode, value_col=value_col, keep=keep,
                               with_schema_id=True, fields=fields)


def run_registered(start: Callable[[], StreamingQuery], registry: SchemaRegistry, schema_of: Callable[[int], Schema | None],
                   most: int = 1000) -> int:
    """Drains ``start()``, again on the same checkpoint after each new id that ``schema_of`` has a schema for.

    Returns the number of restarts. An id without a schema, and any other failure, is raised.
    """
    for restarts in range(most + 1):
        query = start()
        try:
            query.awaitTermination()
            return restarts
        except StreamingQueryException as failure:
            found = re.search(f"({UNKNOWN}|{LATER}) ([0-9]+)", str(failure))
            if found is None:
                raise
            if int(found[2]) not in registry.schemas():
                schema = schema_of(int(found[2]))
                if schema is None:
                    raise
                registry.register(int(found[2]), schema)
    raise RuntimeError(f"more than {most} new schemas")
