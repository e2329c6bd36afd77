"""Bronze projection and order curation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide.functions.ordercols import wait_seconds
from ordertide.functions.timefns import parse_timestamp, session_zone, wall_clock
from ordertide.params import PipelineParams

PLACED = "order_placed_timestamp"
FULFILLED = "order_fulfilled_timestamp"


def bronze_projection(raw: DataFrame, stamp: bool = True,
                      partition_by: tuple[str, ...] = ()) -> DataFrame:
    """C1 (+C6): raw log columns -> bronze columns, payload kept as bytes.

    ``partition_by=("published_date",)`` adds the UTC publication date, the
    partition column that lets replays prune the audit table by time.
    """
    cols = [
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").alias("raw_payload"),
        F.col("topic"),
        F.col("partition"),
        F.col("offset"),
        F.col("timestamp").alias("kafka_published_timestamp"),
    ]
    if stamp:
        cols.append(F.current_timestamp().alias("bronze_ingestion_timestamp"))
    if "published_date" in partition_by:
        zone = session_zone(raw.sparkSession)
        cols.append(F.to_date(wall_clock(F.col("timestamp"), zone)).alias("published_date"))
    return raw.select(*cols)


def valid_order() -> Column:
    """C5 on decoded fields: a store, and a placed time that is one."""
    return F.col("store_id").isNotNull() & parse_timestamp(PLACED).isNotNull()


def curate_orders(parsed: DataFrame) -> DataFrame:
    """Typed event times and amount, wait time, validity filter.

    Text that is not a timestamp / number becomes null instead of failing the
    batch; rows without a store or a placed time are dropped (this also drops
    frames the decoder could not read).
    """
    return (parsed
            .withColumn(PLACED, parse_timestamp(PLACED))
            .withColumn(FULFILLED, parse_timestamp(FULFILLED))
            .withColumn("transaction_amount", F.col("transaction_amount").try_cast("double"))
            .withColumn("wait_time_seconds", wait_seconds(FULFILLED, PLACED))
            .filter(F.col("store_id").isNotNull() & F.col(PLACED).isNotNull()))


def with_event_watermark(curated: DataFrame, params: PipelineParams) -> DataFrame:
    """Event time = placed time; watermark = max seen - delay."""
    return curated.withWatermark(PLACED, params.watermark_delay)
