"""What a stream dropped, by name (W6): bronze against silver.

Spark drops a row silently when its window has closed. The audit table keeps every row
with its ingestion time, which is the same for all rows of a batch, so the watermark that each batch met can be computed
again: the largest event time of all earlier batches, less the delay, in whole milliseconds. The
orders behind it are named, and counted against what the silver windows lack.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordertide.operators.curate import PLACED
from ordertide.operators.metrics import window_col
from ordertide.params import PipelineParams

INGESTED = "bronze_ingestion_timestamp"


def batch_watermarks(curated: DataFrame, params: PipelineParams) -> DataFrame:
    """(ingestion time, watermark) of each batch: what it met, from the batches before it. One row a batch."""
    high = curated.groupBy(INGESTED).agg(F.max(PLACED).alias("high"))
    before = F.max("high").over(Window.orderBy(INGESTED).rowsBetween(Window.unboundedPreceding, -1))
    mark = F.timestamp_millis(F.unix_millis(before)) - F.expr(f"INTERVAL {params.watermark_delay}")
    return high.select(INGESTED, mark.alias("watermark"))


def late_orders(curated: DataFrame, params: PipelineParams, keep: tuple[str, ...] = ("order_id",)) -> DataFrame:
    """Orders that came after their window had closed, for a stream that took the batches of bronze one by one."""
    marks = batch_watermarks(curated, params)
    rows = curated.withColumn("window", window_col(params)).join(marks, INGESTED)
    return rows.filter(F.col("window.end") <= F.col("watermark")).select(
        *keep, "store_id", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"))


def missing_counts(curated: DataFrame, silver: DataFrame, params: PipelineParams) -> DataFrame:
    """(window_start, store_id, orders, counted, missing) of closed windows whose silver row lacks orders of bronze.

    Both sides are one row per window and store before they meet.
    """
    delay = F.expr(f"INTERVAL {params.watermark_delay}")
    end = curated.agg(F.timestamp_millis(F.unix_millis(F.max(PLACED))) - delay).scalar()
    have = curated.groupBy(window_col(params).alias("window"), "store_id").agg(F.count(F.lit(1)).alias("orders"))
    have = have.filter(F.col("window.end") <= end).select(F.col("window.start").alias("window_start"), "store_id", "orders")
    both = have.join(silver.select("window_start", "store_id", F.col("total_order_count").alias("n")), ["window_start", "store_id"], "left")
    counted = F.coalesce("n", F.lit(0))
    return both.select("window_start", "store_id", "orders", counted.alias("counted"), (F.col("orders") - counted).alias("missing")).filter("missing <> 0")


def late_ledger(curated: DataFrame, silver: DataFrame, params: PipelineParams) -> DataFrame:
    """Every dropped order, beside the number that its window lacks; a window whose numbers disagree has ``agrees`` false.

    (window_start, store_id, order_id, missing, agrees); order_id is null for a window that lacks
    orders none of which was late.
    """
    late = late_orders(curated, params)
    n = late.groupBy("window_start", "store_id").agg(F.count(F.lit(1)).alias("late"))
    missing = missing_counts(curated, silver, params).select("window_start", "store_id", "missing")
    both = missing.join(n, ["window_start", "store_id"], "full").select(
        "window_start", "store_id", F.coalesce("missing", F.lit(0)).alias("missing"), F.coalesce(F.col("missing") == F.col("late"), F.lit(False)).alias("agrees"))
    return both.join(late.select("window_start", "store_id", "order_id"), ["window_start", "store_id"], "left").select(
        "window_start", "store_id", "order_id", "missing", "agrees")
