"""Named plans, one per check of the operator inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole tables.
Timestamps leave as UTC wall clock ``TIMESTAMP_NTZ``; no processing-time
column is returned. Streaming plans run the job itself over the log, slice by
slice, into a fresh folder under the session's checkpoint folder and return
its tables read back.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ordertide.job import SINKS, start
from ordertide.functions.timefns import session_zone, wall_clock
from ordertide.operators import metrics as M
from ordertide.operators import profiles as P
from ordertide.operators import reconcile as R
from ordertide.operators.curate import FULFILLED, PLACED, bronze_projection, curate_orders
from ordertide.operators.decode import (
    decode, decode_by_schema_id, decode_fixed, encode_frames, frame_outcomes, split_frame, superset_schema,
)
from ordertide.operators.reconcile import INGESTED
from ordertide.params import PRODUCTION, PipelineParams
from ordertide.schemas import METRIC_COLUMNS, ORDER_EVENT, ORDER_EVENT_V2, RAW_LOG, SILVER_COLUMNS, ddl
from ordertide.session import fresh_dir, streaming_session
from ordertide.sources.fixtures import SCHEMA_LARGE, SCHEMA_UNKNOWN, flat_orders, nested_orders, order_lines, raw_log
from ordertide.sources.tables import read_bronze, read_result, read_table
from ordertide.streaming.ledger import LedgerTable
from ordertide.streaming.listener import ProgressTable
from ordertide.streaming.registry import SchemaRegistry, decode_registered, run_registered
from ordertide.streaming.sinks import METRIC_INPUTS, await_all
from ordertide.streaming.state import open_windows

# recommended plan: one-stage aggregate (see PipelineParams.salt_factor)
SCHEMAS = {101: ORDER_EVENT, 102: ORDER_EVENT_V2}
PARAMS = PRODUCTION.replace(source_format="parquet", sink_format="parquet", salt_factor=None, schemas=SCHEMAS)
# the shipped production plan: two-stage, salt factor 16
SALTED = PARAMS.replace(salt_factor=16)

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- inputs ----

def orders(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    return flat_orders(read_table(spark, sf_dir, "events", streaming=streaming))


def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate_orders(orders(spark, sf_dir))


def log(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    return raw_log(orders(spark, sf_dir, streaming))


def nested_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_lines(read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "part"))


def nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested_orders(read_table(spark, sf_dir, "orders"), nested_lines(spark, sf_dir))


def metrics_out(df: DataFrame) -> DataFrame:
    zone = session_zone(df.sparkSession)
    return df.withColumns({"window_start": wall_clock("window_start", zone),
                           "window_end": wall_clock("window_end", zone)})


SLICES = 3


def staged_log(spark: SparkSession, sf_dir: str, path: str, last: int | None = None) -> list[DataFrame]:
    """Derives the log once, written by arrival, and returns each delivery: ``SLICES`` publish-time
    slices, and log partition ``last`` after all of them. A delivery reads its own partition only."""
    raw = log(spark, sf_dir)
    micros = F.unix_micros("timestamp")
    lo, hi = raw.agg(F.min(micros), F.max(micros)).first()
    step = 1 if lo is None else (hi - lo) // SLICES + 1
    arrival = F.call_function("div", micros - F.lit(lo or 0), F.lit(step))
    if last is not None:
        arrival = F.when(F.col("partition") == last, F.lit(SLICES)).otherwise(arrival)
    raw.withColumn("arrival", arrival.cast("int")).write.partitionBy("arrival").parquet(path)
    staged = spark.read.schema(T.StructType([*RAW_LOG.fields, T.StructField("arrival", T.IntegerType())])).parquet(path)
    return [staged.filter(F.col("arrival") == k).drop("arrival") for k in range(SLICES + (last is not None))]


@dataclass
class Replay:
    """A finished run of the job over the log's deliveries: its session, folders and each run's queries."""

    spark: SparkSession
    base: str
    params: PipelineParams
    runs: list[tuple[StreamingQuery, ...]] = field(default_factory=list)

    @property
    def bronze(self) -> DataFrame:
        return read_bronze(self.spark, path=self.params.bronze_path)

    @property
    def silver(self) -> DataFrame:
        return self.spark.read.schema(ddl(SILVER_COLUMNS)).parquet(self.params.silver_path)


def replay(spark: SparkSession, sf_dir: str, params: PipelineParams, label: str,
           last: int | None = None, sinks: tuple[str, ...] = SINKS) -> Replay:
    """Runs the job (``ordertide.job.start``, with the ``sinks`` that are asked for) over the log's deliveries.

    Each one is drained by an ``availableNow`` run that resumes from the
    checkpoints, so state is carried over from batch to batch.
    """
    spark = streaming_session(spark)
    base = fresh_dir(spark, label)
    params = params.replace(
        trigger_available_now=True, bronze_path=f"{base}/bronze", bronze_checkpoint=f"{base}/bronze-checkpoint",
        silver_path=f"{base}/silver", silver_checkpoint=f"{base}/silver-checkpoint")
    out = Replay(spark, base, params)
    for delivery in staged_log(spark, sf_dir, f"{base}/staged", last):
        delivery.write.mode("append").parquet(f"{base}/log")
        out.runs.append(start(spark, params, f"{base}/log", sinks))
        await_all(out.runs[-1], params, spark)
    return out


# ------------------------------------------------------- window metrics ----

def store_metrics_5m(spark, sf_dir, params: PipelineParams = PARAMS):
    return metrics_out(M.store_metrics(curated(spark, sf_dir), params))


def store_metrics_5m_direct(spark, sf_dir):
    return store_metrics_5m(spark, sf_dir, PARAMS.replace(salt_factor=None))


def store_metrics_5m_salted(spark, sf_dir):
    return store_metrics_5m(spark, sf_dir, SALTED)


def store_metrics_1h(spark, sf_dir):
    p = PARAMS.replace(window_duration="1 hour", slide_duration="1 hour")
    return metrics_out(M.store_metrics(curated(spark, sf_dir), p))


def store_metrics_1d(spark, sf_dir):
    p = PARAMS.replace(window_duration="1 day", slide_duration="1 day")
    return metrics_out(M.store_metrics(curated(spark, sf_dir), p))


def store_metrics_sliding(spark, sf_dir):
    p = PARAMS.replace(window_duration="10 minutes", slide_duration="5 minutes")
    return metrics_out(M.store_metrics(curated(spark, sf_dir), p))


def store_totals_direct(spark, sf_dir):
    return M.store_totals_direct(curated(spark, sf_dir), PARAMS)


def salting_parity(spark, sf_dir):
    return M.salting_parity(curated(spark, sf_dir), SALTED).select("groups", "mismatches")


def partials_invariants(spark, sf_dir):
    return M.partials_invariants(curated(spark, sf_dir), SALTED).withColumn(
        "window_start", wall_clock("window_start", session_zone(spark)))


def null_amount_metrics(spark, sf_dir):
    out = M.store_metrics(curated(spark, sf_dir), PARAMS, null_counts=True)
    return metrics_out(out.filter(F.col("null_amount_count") > 0))


def salt_spread(spark, sf_dir):
    return M.salt_spread(curated(spark, sf_dir), SALTED)


def wait_time(spark, sf_dir):
    return curated(spark, sf_dir).select("order_id", "wait_time_seconds")


# ------------------------------------------------- decode and curation ----

def curate_orders_q(spark, sf_dir):
    parsed = decode_by_schema_id(log(spark, sf_dir), SCHEMAS, fields=METRIC_INPUTS)
    zone = session_zone(spark)
    return curate_orders(parsed).select(
        "order_id", "store_id", wall_clock(PLACED, zone).alias(PLACED),
        wall_clock(FULFILLED, zone).alias(FULFILLED), "transaction_amount", "wait_time_seconds")


def bronze_out(bronze: DataFrame, *more: str) -> DataFrame:
    zone = session_zone(bronze.sparkSession)
    return bronze.select(
        *more,
        "kafka_key", F.hex("raw_payload").alias("raw_payload_hex"), "topic", "partition", "offset",
        wall_clock("kafka_published_timestamp", zone).alias("kafka_published_timestamp"))


def bronze_projection_q(spark, sf_dir):
    return bronze_out(bronze_projection(log(spark, sf_dir), stamp=False))


def wire_frame_split(spark, sf_dir):
    return split_frame(log(spark, sf_dir)).select(
        "offset", "magic", "schema_id", F.length("payload").alias("body_length"))


def decode_orders(spark, sf_dir):
    d = decode_fixed(log(spark, sf_dir), ORDER_EVENT, mode="PERMISSIVE", keep=["offset"])
    return d.select(
        "offset", "order_id", "store_id", "customer_id", "channel", PLACED, FULFILLED,
        "transaction_amount",
        F.when(F.col("items").isNotNull(), F.size("items")).alias("n_items"),
        F.col("payment.primary_tender").alias("primary_tender"))


def decode_by_schema_id_q(spark, sf_dir):
    d = decode_by_schema_id(log(spark, sf_dir), SCHEMAS, keep=["offset"], with_schema_id=True)
    return d.select("offset", "schema_id", "order_id", "store_id", "loyalty_tier",
                    F.col("payment.wallet").alias("wallet"), "transaction_amount")


def decode_outcomes(spark, sf_dir):
    """Frames per decoding outcome: what the silver stream drops, and where."""
    return frame_outcomes(log(spark, sf_dir), SCHEMAS, keep=["offset"]).groupBy("outcome").agg(
        F.count(F.lit(1)).alias("n"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset"))


def frame_round_trip(spark, sf_dir):
    """Decoded order -> re-framed with its schema id -> decoded again == original;
    null for a frame that does not decode."""
    target = superset_schema(SCHEMAS.values())
    first = decode_by_schema_id(log(spark, sf_dir), SCHEMAS, keep=["offset"], with_schema_id=True)
    framed = encode_frames(first, F.col("schema_id"), target,
                           keep=["offset", F.struct(*target.fieldNames()).alias("orig")])
    again = decode_by_schema_id(framed, SCHEMAS, keep=["offset", "orig"])
    return again.select(
        F.col("orig.order_id").alias("order_id"),
        F.when(F.col("orig.order_id").isNotNull(),
               F.col("orig").eqNullSafe(F.struct(*[F.col(c) for c in target.fieldNames()]))).alias("ok"))


# ------------------------------------------------------------ streaming ----

def stream_bronze(spark, sf_dir):
    return bronze_out(replay(spark, sf_dir, PARAMS, "bronze", sinks=("bronze",)).bronze)


def stream_store_metrics(spark, sf_dir, params: PipelineParams = PARAMS):
    return metrics_out(replay(spark, sf_dir, params, "silver", sinks=("silver",)).silver.select(*METRIC_COLUMNS))


def stream_store_metrics_salted(spark, sf_dir):
    """Chained stateful aggregation (stage 1 by window, store, salt; stage 2 by window, store)."""
    return stream_store_metrics(spark, sf_dir, SALTED)


LAGGING_PARTITION = 3


def stream_lagging_partition(spark, sf_dir):
    """W6 on the given data: log partition 3 lags and arrives last. The watermark
    is global, so the lagging rows whose window it has already closed are
    dropped and the rest are counted; windows still open at the end stay
    unwritten."""
    done = replay(spark, sf_dir, PARAMS, "lagging", last=LAGGING_PARTITION, sinks=("silver",))
    return metrics_out(done.silver.select(*METRIC_COLUMNS))


def late_ledger(spark, sf_dir):
    """The orders that the silver stream dropped, by name, from bronze; each window's number
    is held against what the window lacks."""
    done = replay(spark, sf_dir, PARAMS, "late", last=LAGGING_PARTITION)
    parsed = decode(done.bronze, PARAMS, fields=METRIC_INPUTS, value_col="raw_payload", keep=[INGESTED])
    ledger = R.late_ledger(curate_orders(parsed), done.silver, PARAMS)
    return ledger.withColumn("window_start", wall_clock("window_start", session_zone(done.spark)))


def stream_state(spark, sf_dir):
    """What the two stages hold after the log is drained: stage 1 a row for each open window, store
    and salt, stage 2 nothing."""
    done = replay(spark, sf_dir, SALTED, "state", sinks=("silver",))
    return open_windows(done.spark, done.params.silver_checkpoint)


def stream_progress(spark, sf_dir):
    """The silver stream's progress as a table: each run's rows, invalid ones among them, and the watermark it left."""
    done = replay(spark, sf_dir, PARAMS, "progress", sinks=("silver",))
    log = ProgressTable(done.spark, f"{done.base}/progress")
    for n, queries in enumerate(done.runs, 1):
        log.append(n, queries)
    by_run = log.read().groupBy("run").agg(
        F.sum("input_rows").alias("input_rows"), F.sum("invalid_rows").alias("invalid_rows"), F.max("watermark").alias("watermark"))
    return by_run.withColumn("watermark", wall_clock("watermark", session_zone(done.spark)))


def stream_new_schema(spark, sf_dir):
    """The stream starts with versions 101 and 102 registered, stops on each id it does not know, and goes
    on from its checkpoint when the id's schema is in the registry."""
    spark = streaming_session(spark)
    base = fresh_dir(spark, "registry")
    registry = SchemaRegistry(spark, f"{base}/registry")
    for k, schema in SCHEMAS.items():
        registry.register(k, schema)
    to_come = {SCHEMA_UNKNOWN: ORDER_EVENT_V2, SCHEMA_LARGE: ORDER_EVENT_V2}
    for delivery in staged_log(spark, sf_dir, f"{base}/staged"):
        delivery.write.mode("append").parquet(f"{base}/log")

        def begin() -> StreamingQuery:
            raw = spark.readStream.schema(RAW_LOG).parquet(f"{base}/log")
            orders = decode_registered(raw, registry, keep=["offset"])
            tiers = {c: F.col(c) if c in orders.columns else F.lit(None).cast("string") for c in ("loyalty_tier",)}
            return (orders.select("offset", "schema_id", "order_id", "store_id", tiers["loyalty_tier"].alias("loyalty_tier"),
                                  F.col("payment.wallet").alias("wallet"), "transaction_amount")
                    .writeStream.option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True)
                    .format("parquet").start(f"{base}/orders"))

        run_registered(begin, registry, to_come.get)
    return spark.read.parquet(f"{base}/orders")


# ---------------------------------------------------------- ledger tables ----

class Killed(RuntimeError):
    """The fault that the ledger queries put between write and commit."""


def append_with_faults(table: LedgerTable, batches: list[Callable[[], DataFrame]], killed: int = 1) -> None:
    """Appends all batches, is killed once between write and commit of one of them, and starts again from the first."""
    def fault(_: str) -> None:
        raise Killed

    for attempt in range(2):
        try:
            for k, batch in enumerate(batches):
                table.append(batch(), k, fault if (attempt, k) == (0, killed) else None)
        except Killed:
            continue


def bronze_ledger(spark: SparkSession, sf_dir: str, label: str) -> LedgerTable:
    base = fresh_dir(spark, label)
    table = LedgerTable(spark, f"{base}/bronze", order_by="kafka_published_timestamp")
    deliveries = staged_log(spark, sf_dir, f"{base}/staged")
    append_with_faults(table, [lambda d=d: bronze_projection(d, stamp=False) for d in deliveries])
    return table


def ledger_bronze(spark, sf_dir):
    """Bronze through the batch ledger, exactly once though a batch is killed after its write."""
    rows = bronze_ledger(spark, sf_dir, "ledger-bronze").read()
    return bronze_out(rows, "batch_id")


def ledger_silver(spark, sf_dir):
    """The windows that each run of the silver stream finishes, published to a ledger table with a fault in between."""
    done = replay(spark, sf_dir, PARAMS, "ledger-silver", sinks=("silver",))
    table = LedgerTable(done.spark, f"{done.base}/published", order_by="window_start")

    def fresh() -> DataFrame:
        have = table.read()
        return done.silver.join(have, ["window_start", "store_id"], "left_anti") if "store_id" in have.columns else done.silver

    append_with_faults(table, [fresh] * SLICES, killed=0)
    return metrics_out(table.read().select(*METRIC_COLUMNS))


def schema_growth(spark, sf_dir):
    """The first batch is read with version 1, later ones with version 2 and a wider number, into one table."""
    base = fresh_dir(spark, "growth")
    table = LedgerTable(spark, f"{base}/orders")
    for k, delivery in enumerate(staged_log(spark, sf_dir, f"{base}/staged")):
        length = (F.length("value") - 5).cast("int" if k == 0 else "long")
        rows = delivery.withColumn("body_length", length)
        table.append(decode_fixed(rows, ORDER_EVENT if k == 0 else ORDER_EVENT_V2, mode="PERMISSIVE", keep=["offset", "body_length"]), k)
    return table.read().select("offset", "order_id", "transaction_amount", "body_length", F.col("payment.wallet").alias("wallet"), "loyalty_tier")


# ---------------------------------------------------- dashboard views ----

def dashboard_silver(spark, sf_dir):
    path = fresh_dir(spark, "silver-batch")
    # rebalanced by store, so a store with a long history is more than one task and file
    silver = M.store_metrics(curated(spark, sf_dir), PARAMS, stamp=True).hint("rebalance", "store_id")
    silver.write.partitionBy("store_id").mode("errorifexists").parquet(path)
    silver = read_result(spark, path=path).select(*METRIC_COLUMNS)
    return P.dashboard(metrics_out(silver))


def bronze_replay_metrics(spark, sf_dir):
    """Silver metrics recomputed in batch from the audit table (written
    partitioned by publication date, then read back and decoded)."""
    path = fresh_dir(spark, "bronze-batch")
    (bronze_projection(log(spark, sf_dir), partition_by=("published_date",))
     .write.partitionBy("published_date").mode("errorifexists").parquet(path))
    bronze = read_bronze(spark, path=path)
    parsed = decode(bronze, PARAMS, fields=METRIC_INPUTS, value_col="raw_payload")
    return metrics_out(M.store_metrics(curate_orders(parsed), PARAMS))


def bronze_latest(spark, sf_dir):
    """O2: newest rows of an audit table of several batches; only the batches that can hold them are read."""
    return bronze_out(P.latest_bronze(bronze_ledger(spark, sf_dir, "latest").newest(20), 20))


# ------------------------------------------------------------- profiles ----

def skew_profile(spark, sf_dir):
    return P.skew_profile(orders(spark, sf_dir))


def channel_profile(spark, sf_dir):
    decoded = decode_by_schema_id(log(spark, sf_dir), SCHEMAS, fields=["channel"])
    return P.channel_profile(decoded)


def lateness_profile(spark, sf_dir):
    return P.lateness_profile(orders(spark, sf_dir))


def order_total_check(spark, sf_dir):
    return P.order_total_check(nested(spark, sf_dir))


def split_tender_check(spark, sf_dir):
    return P.split_tender_check(nested(spark, sf_dir))


def item_lines(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key"))
    return P.item_lines(nested_lines(spark, sf_dir), orders)


FLAGSHIP = "store_metrics_5m"

QUERIES: dict[str, Query] = {
    "store_metrics_5m": store_metrics_5m,
    "store_metrics_5m_direct": store_metrics_5m_direct,
    "store_metrics_5m_salted": store_metrics_5m_salted,
    "store_metrics_1h": store_metrics_1h,
    "store_metrics_1d": store_metrics_1d,
    "store_metrics_sliding": store_metrics_sliding,
    "store_totals_direct": store_totals_direct,
    "salting_parity": salting_parity,
    "partials_invariants": partials_invariants,
    "null_amount_metrics": null_amount_metrics,
    "salt_spread": salt_spread,
    "wait_time": wait_time,
    "curate_orders": curate_orders_q,
    "bronze_projection": bronze_projection_q,
    "wire_frame_split": wire_frame_split,
    "decode_orders": decode_orders,
    "decode_by_schema_id": decode_by_schema_id_q,
    "decode_outcomes": decode_outcomes,
    "frame_round_trip": frame_round_trip,
    "stream_bronze": stream_bronze,
    "stream_store_metrics": stream_store_metrics,
    "stream_store_metrics_salted": stream_store_metrics_salted,
    "stream_lagging_partition": stream_lagging_partition,
    "late_replay": stream_lagging_partition,
    "late_ledger": late_ledger,
    "stream_state": stream_state,
    "stream_progress": stream_progress,
    "stream_new_schema": stream_new_schema,
    "ledger_bronze": ledger_bronze,
    "ledger_silver": ledger_silver,
    "schema_growth": schema_growth,
    "dashboard_silver": dashboard_silver,
    "bronze_latest": bronze_latest,
    "bronze_replay_metrics": bronze_replay_metrics,
    "skew_profile": skew_profile,
    "lateness_profile": lateness_profile,
    "channel_profile": channel_profile,
    "order_total_check": order_total_check,
    "split_tender_check": split_tender_check,
    "item_lines": item_lines,
}
