"""Append table with a batch ledger.

For sinks without a commit log of their own: a batch is written to its own folder and then
committed by one ledger row that holds its number, row count, time bounds and the table's
schema. Readers see committed batches only. A batch killed between write and commit leaves
a folder that nobody reads and that the repeated batch overwrites; a batch that is repeated after its
commit is skipped. ``append(df, batch_id)`` has the signature of ``foreachBatch``.

The table's schema grows: new columns (nested ones too) are added, numbers widen, and rows of
earlier batches show null in columns they lack. A change that could lose values is
refused before anything is written.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMIT = "batch_id LONG, seq LONG, rows LONG, low LONG, high LONG, schema STRING"

#: Number types in widening order: each holds every value of those before it in its row.
WIDENING = (
    ("byte", "short", "integer", "long"),
    ("byte", "short", "integer", "double"),
    ("float", "double"),
)


class SchemaConflict(ValueError):
    """The batch's schema cannot be joined to the table's without losing values."""


def wider(a: T.DataType, b: T.DataType, name: str) -> T.DataType:
    """The type that holds the values of both."""
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged_schema(a, b, name + ".")
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType, name + "[]"), True)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType) and a.keyType == b.keyType:
        return T.MapType(a.keyType, wider(a.valueType, b.valueType, name + "{}"), True)
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        whole = max(a.precision - a.scale, b.precision - b.scale)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    if a == b:
        return a
    for row in WIDENING:
        if a.typeName() in row and b.typeName() in row:
            return a if row.index(a.typeName()) > row.index(b.typeName()) else b
    raise SchemaConflict(f"column {name}: {a.simpleString()} and {b.simpleString()}")


def merged_schema(table: T.StructType, batch: T.StructType, prefix: str = "") -> T.StructType:
    """The table's schema with the batch's new columns behind its own; all columns are nullable."""
    own = {f.name: f.dataType for f in table.fields}
    given = {f.name: f.dataType for f in batch.fields}
    if len({n.lower() for n in (*own, *given)}) != len({*own, *given}):
        raise SchemaConflict("columns differ in case only")
    both = {n: wider(t, given[n], prefix + n) if n in given else t for n, t in own.items()}
    both.update({n: t for n, t in given.items() if n not in own})
    return T.StructType([T.StructField(n, t, True) for n, t in both.items()])


def conformed(value: Column, has: T.DataType, target: T.DataType) -> Column:
    """``value`` of type ``has`` as the wider ``target``."""
    if isinstance(target, T.StructType):
        own = {f.name: f.dataType for f in has.fields}
        fields = [(conformed(value.getField(f.name), own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name)
                  for f in target.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(target, T.ArrayType):
        return F.transform(value, lambda x: conformed(x, has.elementType, target.elementType))
    if isinstance(target, T.MapType):
        return F.transform_values(value, lambda _, x: conformed(x, has.valueType, target.valueType))
    return value.cast(target)


class LedgerTable:
    """Batches under ``path``; ``order_by`` names the timestamp column whose bounds are kept per batch."""

    def __init__(self, spark: SparkSession, path: str, order_by: str | None = None) -> None:
        self.spark, self.path, self.order_by = spark, path.rstrip("/"), order_by
        spark.createDataFrame([], COMMIT).write.mode("ignore").parquet(f"{self.path}/commits")

    def commits(self) -> DataFrame:
        return self.spark.read.schema(COMMIT).parquet(f"{self.path}/commits")

    def schema(self) -> T.StructType | None:
        """Schema of the last commit."""
        last = self.commits().agg(F.max_by("schema", "seq")).first()[0]
        return T._parse_datatype_json_string(last) if last else None

    def append(self, df: DataFrame, batch_id: int, fault: Callable[[str], None] | None = None) -> bool:
        """Writes and commits a batch; False if it is committed already. ``fault`` is called between the two."""
        known = self.commits().agg(F.max("seq"), F.max_by("schema", "seq"), F.bool_or(F.col("batch_id") == batch_id)).first()
        if known[2]:
            return False
        own = T._parse_datatype_json_string(known[1]) if known[1] else T.StructType([])
        target = merged_schema(own, df.schema)
        has = {f.name: f.dataType for f in df.schema.fields}
        rows = df.select(*[(conformed(F.col(f"`{f.name}`"), has[f.name], f.dataType) if f.name in has else F.lit(None).cast(f.dataType)).alias(f.name)
                           for f in target.fields])
        folder = f"{self.path}/data/batch_id={int(batch_id)}"
        rows.write.mode("overwrite").parquet(folder)
        if fault is not None:
            fault("written")
        written = self.spark.read.schema(target).parquet(folder)
        bound = F.unix_micros(F.col(self.order_by).cast("timestamp")) if self.order_by else F.lit(None).cast("long")
        stats = written.agg(F.count(F.lit(1)).alias("rows"), F.min(bound).alias("low"), F.max(bound).alias("high"))
        commit = stats.select(F.lit(int(batch_id)).cast("long").alias("batch_id"), F.lit((known[0] or 0) + 1).cast("long").alias("seq"),
                              "rows", "low", "high", F.lit(target.json()).alias("schema"))
        commit.coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
        return True

    def read(self, keep: DataFrame | None = None) -> DataFrame:
        """Rows of committed batches (or of those in ``keep``, a frame of batch_id), with ``batch_id``.

        The semi-join on the partition column prunes the folders of other batches at run time.
        """
        schema = self.schema()
        if schema is None:
            return self.spark.createDataFrame([], T.StructType([T.StructField("batch_id", T.LongType())]))
        whole = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
        data = self.spark.read.schema(whole).parquet(f"{self.path}/data")
        return data.join((self.commits() if keep is None else keep).select("batch_id").distinct(), "batch_id", "left_semi")

    def newest(self, n: int) -> DataFrame:
        """Rows that hold the newest ``n`` by ``order_by``: whole batches, newest first, until ``n`` rows are certain.

        Every batch has a row, so the ``n`` batches of highest low bound settle the bound; a batch
        whose high bound is below it cannot hold any of the newest rows and is never read.
        """
        if not self.order_by:
            raise ValueError("the newest rows need the column that orders them")
        found, bound = 0, None
        full = self.commits().filter("low is not null")
        for c in full.orderBy(F.col("low").desc()).limit(n).select("low", "rows").collect():
            found, bound = found + c["rows"], c["low"]
            if found >= n:
                break
        if found < n:
            return self.read()
        ids = [c[0] for c in full.filter(F.col("high") >= bound).select("batch_id").limit(10_000).collect()]
        keep = full.filter(F.col("high") >= bound)
        if len(ids) < 10_000:                     # few enough to name: the scan prunes its folders while planning
            schema = T.StructType([*self.schema().fields, T.StructField("batch_id", T.LongType())])
            return self.spark.read.schema(schema).parquet(f"{self.path}/data").filter(F.col("batch_id").isin(ids))
        return self.read(keep)
