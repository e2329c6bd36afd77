"""Bronze and silver streaming queries.

Each query has its own checkpoint; the file / table sink commits a batch
together with its id, so a batch replayed after a crash is not written twice.
Both queries read the source themselves (fan-out), so either can restart
independently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ordertide.functions.timefns import session_zone, wall_clock
from ordertide.operators.curate import bronze_projection, curate_orders, valid_order, with_event_watermark
from ordertide.operators.decode import decode
from ordertide.operators.metrics import store_metrics
from ordertide.params import PipelineParams

# order fields the metrics read; the decoder parses only these
METRIC_INPUTS = ("order_id", "store_id", "order_placed_timestamp", "order_fulfilled_timestamp",
                 "transaction_amount")


def configure_trigger(writer: DataStreamWriter, params: PipelineParams) -> DataStreamWriter:
    """Drain what is there and stop, or run every interval."""
    if params.trigger_available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=params.trigger_processing_time)


def start_writer(writer: DataStreamWriter, table: str | None, path: str | None) -> StreamingQuery:
    """Catalog table when named, else a path, else the sink's own options."""
    if table:
        return writer.toTable(table)
    if path:
        return writer.start(path)
    return writer.start()          # sinks configured by options only (kafka, noop, console)


def bronze_stream(raw: DataFrame, params: PipelineParams) -> StreamingQuery:
    """Raw rows appended unchanged (plus ingestion time) to the audit table."""
    writer = (bronze_projection(raw, partition_by=params.bronze_partition_by).writeStream
              .queryName(params.bronze_query_name)                 # W10
              .format(params.sink_format)
              .outputMode("append")
              .option("checkpointLocation", params.bronze_checkpoint)
              .option("mergeSchema", "true"))                      # S11
    if params.bronze_partition_by and not params.bronze_table:
        writer = writer.partitionBy(*params.bronze_partition_by)
    return start_writer(configure_trigger(writer, params), params.bronze_table, params.bronze_path)


def silver_frame(raw: DataFrame, params: PipelineParams, stamp: bool = True) -> DataFrame:
    """Raw log -> decoded -> curated -> watermarked -> window metrics."""
    parsed = decode(raw, params, fields=METRIC_INPUTS)
    if raw.isStreaming:
        # Every batch reports how many of its frames give no valid order
        parsed = parsed.observe("frames", F.count(F.lit(1)).alias("frames"), F.count_if(~valid_order()).alias("invalid"))
    curated = with_event_watermark(curate_orders(parsed), params)
    return store_metrics(curated, params, stamp=stamp)


def by_output_partition(df: DataFrame, partition_by, files: int = 1) -> DataFrame:
    """Groups rows for a partitioned write, and adds the date column if they are written by date.

    Aggregates come out hash-partitioned by (window, store); written as is,
    every task would add a file to every folder. A batch's finalized rows are
    few (one per closed window and store), so this small shuffle keeps it at
    one file per store folder, or at ``files`` files by store for each date.
    """
    if "window_date" not in partition_by:
        return df.repartition(*partition_by)
    dated = df.withColumn("window_date", F.to_date(wall_clock("window_start", session_zone(df.sparkSession))))
    return dated.repartition(files, "store_id")


def silver_stream(raw: DataFrame, params: PipelineParams, output_mode: str = "append") -> StreamingQuery:
    """S9 + W4/W5: finalized windows appended once the watermark passes their end.

    The salted plan chains two stateful aggregations, which Spark only allows
    in append mode; the one-stage plan (``salt_factor`` None) may use update.
    """
    if params.salted and output_mode != "append":
        raise ValueError("the two-stage (salted) aggregation supports append mode only; "
                         "set salt_factor=None for update mode")
    silver = silver_frame(raw, params)
    partition_by = params.silver_partition_by      # a provisioned table is partitioned the same way
    if partition_by:
        silver = by_output_partition(silver, partition_by, params.silver_files)
    writer = (silver.writeStream
              .queryName(params.silver_query_name)
              .format(params.sink_format)
              .outputMode(output_mode)
              .option("checkpointLocation", params.silver_checkpoint)
              .option("mergeSchema", "true"))
    if partition_by and not params.silver_table:   # a table brings its own partitioning
        writer = writer.partitionBy(*partition_by)
    return start_writer(configure_trigger(writer, params), params.silver_table, params.silver_path)


def start_bronze_and_silver(raw: DataFrame, params: PipelineParams) -> tuple[StreamingQuery, StreamingQuery]:
    """One source feeds two independent queries."""
    return bronze_stream(raw, params), silver_stream(raw, params)


def await_all(queries, params: PipelineParams, spark=None, timeout: float | None = None) -> None:
    """Drain mode waits for each query in turn, and raises if one is not done when
    ``timeout`` seconds have passed; continuous mode returns (or raises) as soon as any
    query ends, or when the timeout passes."""
    if params.trigger_available_now:
        for q in queries:
            ended = q.awaitTermination(timeout) if timeout else (q.awaitTermination() or True)
            if q.exception():
                raise q.exception()
            if not ended:
                raise TimeoutError(f"query {q.name or q.id} has not drained its source after {timeout} s")
    else:
        spark = spark or SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
        spark.streams.resetTerminated()          # only terminations from now on count
        if all(q.isActive for q in queries):     # one may have ended before the reset
            if timeout:
                spark.streams.awaitAnyTermination(timeout)
            else:
                spark.streams.awaitAnyTermination()
        for q in queries:
            if q.exception():
                raise q.exception()
