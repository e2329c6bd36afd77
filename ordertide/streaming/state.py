"""State of a streaming query as data (W5, W7): rows by operator and state partition.

Reads the checkpoint of a query that has stopped, or between its batches, with Spark's state data
source, so a plan can be held to what it claims to keep.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.functions.timefns import session_zone, wall_clock


def operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(operator_id, operator, partitions, last_batch) of each stateful operator of the query."""
    meta = spark.read.format("state-metadata").load(checkpoint)
    return meta.groupBy(F.col("operatorId").alias("operator_id"), F.col("operatorName").alias("operator")).agg(
        F.max("numPartitions").alias("partitions"), F.max("maxBatchId").alias("last_batch"))


def state_rows(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """(operator_id, partition_id, key, value) of every state row of every operator; key and value as JSON text.

    One reader per operator of the plan; state is read in parallel by state partition.
    """
    parts = []
    for (operator,) in operators(spark, checkpoint).select("operator_id").distinct().orderBy("operator_id").collect():
        reader = spark.read.format("statestore").option("operatorId", operator)
        if batch is not None:
            reader = reader.option("batchId", batch)
        rows = reader.load(checkpoint)
        parts.append(rows.select(F.lit(operator).cast("long").alias("operator_id"), F.col("partition_id").cast("int").alias("partition_id"),
                                 F.to_json("key").alias("key"), F.to_json("value").alias("value")))
    if not parts:
        return spark.createDataFrame([], "operator_id LONG, partition_id INT, key STRING, value STRING")
    return reduce(DataFrame.union, parts)


def partition_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(operator_id, operator, partition_id, rows): each state partition of each operator, empty ones too."""
    every = operators(spark, checkpoint).select(
        "operator_id", "operator", F.explode(F.sequence(F.lit(0), (F.col("partitions") - 1).cast("int"))).alias("partition_id"))
    held = state_rows(spark, checkpoint).groupBy("operator_id", "partition_id").agg(F.count(F.lit(1)).alias("n"))
    return every.join(held, ["operator_id", "partition_id"], "left").select(
        "operator_id", "operator", "partition_id", F.coalesce("n", F.lit(0)).alias("rows"))


WINDOW_KEY = "struct<start:timestamp,end:timestamp>"


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(stage, window_start, store_id, rows): the open windows that a metrics query holds, by stage.

    The stage that keys its state by salt is the first one; a stage without any rows is one row with null keys and 0.
    """
    key = "window STRUCT<start: TIMESTAMP, end: TIMESTAMP>, store_id STRING, salt INT"
    rows = state_rows(spark, checkpoint).withColumn("k", F.from_json("key", key))
    held = rows.groupBy("operator_id", F.col("k.window.start").alias("window_start"), F.col("k.store_id").alias("store_id")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("k.salt").isNotNull()).alias("salted"))
    every = operators(spark, checkpoint).select("operator_id")
    out = every.join(held, "operator_id", "left")
    salted = F.coalesce("salted", F.lit(False))
    return out.select(F.when(salted, F.lit("window, store, salt")).otherwise(F.lit("window, store")).alias("stage"),
                      wall_clock("window_start", session_zone(spark)).alias("window_start"), "store_id",
                      F.coalesce("n", F.lit(0)).alias("rows"))
