"""Streaming semantics: watermark, late data (FIXTURES F9 cases A-C), chained
aggregation, append finalization, restart, triggers, fan-out, telemetry."""

import datetime as dt
import os
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ordertide.operators import metrics as M
from ordertide.operators.curate import curate_orders, with_event_watermark
from ordertide.params import PipelineParams
from ordertide.streaming.listener import ProgressLog, progress_frame
from ordertide.streaming.sinks import bronze_stream, start_bronze_and_silver, silver_stream
from ordertide.schemas import ORDER_EVENT, ORDER_EVENT_V2
from ordertide.sources.fixtures import flat_orders, raw_log
from ordertide.sources.tables import read_table

from tests.conftest import SF001

UTC = dt.timezone.utc
DAY = dt.datetime(2024, 1, 1, tzinfo=UTC)
SCHEMA = "order_id string, store_id string, placed timestamp, amount double"


def at(hhmm: str) -> dt.datetime:
    h, m = map(int, hhmm.split(":"))
    return DAY.replace(hour=h, minute=m)


class Batches:
    """One parquet file per micro-batch, listed in write order."""

    def __init__(self, root):
        self.dir = os.path.join(root, "src")
        os.makedirs(self.dir, exist_ok=True)
        self.n = 0

    def add(self, rows):
        tbl = pa.table({
            "order_id": pa.array([f"o{self.n}_{i}" for i in range(len(rows))], pa.string()),
            "store_id": pa.array([r[0] for r in rows], pa.string()),
            "placed": pa.array([r[1] for r in rows], pa.timestamp("us", tz="UTC")),
            "amount": pa.array([r[2] for r in rows], pa.float64()),
        })
        path = os.path.join(self.dir, f"batch-{self.n:04d}.parquet")
        pq.write_table(tbl, path)
        t = time.time() - 1000 + self.n
        os.utime(path, (t, t))
        self.n += 1


def totals_query(spark, src, out, ckpt, salt_factor=4):
    p = PipelineParams(salt_factor=salt_factor, trigger_available_now=True)
    raw = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
           .select("order_id", "store_id", F.col("placed").alias("order_placed_timestamp"),
                   F.lit(None).cast("timestamp").alias("order_fulfilled_timestamp"),
                   F.col("amount").alias("transaction_amount")))
    totals = M.rollup(M.salted_partials(with_event_watermark(curate_orders(raw), p), p), p)
    q = (totals.select(F.col("window.start").alias("ws"), "store_id",
                       (F.col("amount").cast("double") / 1e10).alias("amount"),
                       F.col("orders").alias("n"))
         .writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start(out))
    q.awaitTermination()
    assert q.exception() is None
    return q


def read_out(spark, out):
    return sorted((r["ws"].strftime("%H:%M"), r["store_id"], r["amount"], r["n"])
                  for r in spark.read.parquet(out).collect())


def test_late_replay_case_a(spark, tmp):
    b = Batches(tmp)
    b.add([("S1", at("08:01"), 1.0)])
    b.add([("S1", at("08:30"), 1.0)])
    b.add([("S1", at("08:31"), 1.0)])
    b.add([("S1", at("08:02"), 7.0), ("S1", at("08:17"), 9.0)])
    b.add([("S1", at("09:00"), 1.0)])
    q = totals_query(spark, b.dir, f"{tmp}/out", f"{tmp}/ckpt")
    assert read_out(spark, f"{tmp}/out") == [("08:00", "S1", 1.0, 1), ("08:15", "S1", 9.0, 1),
                                             ("08:30", "S1", 2.0, 2)]
    prog = q.recentProgress
    dropped = [sum(o["numRowsDroppedByWatermark"] for o in p["stateOperators"]) for p in prog]
    assert sum(dropped) == 1
    marks = [p["eventTime"].get("watermark") for p in prog]
    assert "2024-01-01T08:16:00.000Z" in marks and marks[-1] == "2024-01-01T08:45:00.000Z"


def test_late_filter_lags_one_batch_case_b(spark, tmp):
    b = Batches(tmp)
    b.add([("S1", at("08:00") + dt.timedelta(seconds=27 * i), 1.0) for i in range(10)]
          + [("S2", at("08:01"), 2.0)])
    b.add([("S1", at("08:12"), 1.0)] * 3 + [("S1", at("08:00"), 5.0)])
    b.add([("S1", at("08:22"), 1.0)])
    b.add([("S1", at("08:03"), 7.0), ("S1", at("08:06"), 9.0)])
    b.add([("S1", at("08:40"), 1.0)])
    totals_query(spark, b.dir, f"{tmp}/out", f"{tmp}/ckpt")
    expected = [("08:00", "S1", 22.0, 12), ("08:00", "S2", 2.0, 1), ("08:05", "S1", 9.0, 1),
                ("08:10", "S1", 3.0, 3), ("08:20", "S1", 1.0, 1)]
    assert read_out(spark, f"{tmp}/out") == expected
    # restart with no new data: nothing is replayed or re-emitted
    totals_query(spark, b.dir, f"{tmp}/out", f"{tmp}/ckpt")
    assert read_out(spark, f"{tmp}/out") == expected


def test_salt_factor_change_on_restart_case_c(spark, tmp):
    b = Batches(tmp)
    b.add([("S1", at("08:01"), 1.0)] * 40)
    totals_query(spark, b.dir, f"{tmp}/out", f"{tmp}/ckpt", salt_factor=4)
    assert read_out(spark, f"{tmp}/out") == []
    b.add([("S1", at("08:02"), 1.0)] * 40 + [("S1", at("09:00"), 1.0)])
    totals_query(spark, b.dir, f"{tmp}/out", f"{tmp}/ckpt", salt_factor=16)
    assert read_out(spark, f"{tmp}/out") == [("08:00", "S1", 80.0, 80)]


def _log_files(spark, tmp, parts=3):
    """Raw log (F7 of sf0.001) written as a few files -> a replayable file log."""
    path = f"{tmp}/log"
    raw_log(flat_orders(read_table(spark, SF001, "events"))).repartition(parts).write.parquet(path)
    return path


def pipeline_params(tmp, **kw):
    base = dict(source_format="parquet", sink_format="parquet", trigger_available_now=True,
                silver_partition_by=("store_id",), max_files_per_trigger=1, salt_factor=4, schemas={101: ORDER_EVENT, 102: ORDER_EVENT_V2},
                bronze_path=f"{tmp}/bronze", bronze_checkpoint=f"{tmp}/ck_bronze",
                silver_path=f"{tmp}/silver", silver_checkpoint=f"{tmp}/ck_silver")
    base.update(kw)
    return PipelineParams(**base)


def test_fan_out_bronze_and_silver(spark, tmp):
    from ordertide.sources.log_source import log_source
    path = _log_files(spark, tmp)
    p = pipeline_params(tmp)
    raw = log_source(spark, p, path)
    bq, sq = start_bronze_and_silver(raw, p)
    bq.awaitTermination(); sq.awaitTermination()
    assert bq.exception() is None and sq.exception() is None
    assert bq.name == p.bronze_query_name and sq.name == p.silver_query_name
    n_in = spark.read.parquet(path).count()
    # both queries read every input row; one file per trigger
    assert sum(x["numInputRows"] for x in bq.recentProgress) == n_in
    assert sum(x["numInputRows"] for x in sq.recentProgress) == n_in
    assert sum(1 for x in bq.recentProgress if x["numInputRows"] > 0) == 3
    assert spark.read.parquet(p.bronze_path).count() == n_in
    silver = spark.read.parquet(p.silver_path)
    assert set(silver.columns) >= {"window_start", "store_id", "avg_order_value",
                                   "metrics_calculated_timestamp"}
    assert os.path.isdir(f"{tmp}/silver/store_id=STORE-0001")        # partitioned by store
    # silver equals the batch plan restricted to windows closed by the watermark
    prog = progress_frame(spark, [bq, sq])
    assert prog.filter(F.col("query_name") == p.silver_query_name).count() == len(sq.recentProgress)


def test_restart_adds_no_duplicates(spark, tmp):
    from ordertide.sources.log_source import log_source
    path = _log_files(spark, tmp, parts=2)
    p = pipeline_params(tmp)
    for _ in range(2):
        q = bronze_stream(log_source(spark, p, path), p)
        q.awaitTermination()
    assert spark.read.parquet(p.bronze_path).count() == spark.read.parquet(path).count()


def test_processing_time_trigger_and_stop(spark, tmp):
    from ordertide.sources.log_source import log_source
    path = _log_files(spark, tmp, parts=1)
    p = pipeline_params(tmp, trigger_available_now=False, trigger_processing_time="1 second")
    q = bronze_stream(log_source(spark, p, path), p)
    try:
        q.processAllAvailable()
        assert q.isActive
    finally:
        q.stop()
    assert spark.read.parquet(p.bronze_path).count() == spark.read.parquet(path).count()


def test_update_mode_rejected_for_salted_plan(spark, tmp):
    from ordertide.sources.log_source import log_source
    path = _log_files(spark, tmp, parts=1)
    p = pipeline_params(tmp)
    with pytest.raises(ValueError, match="append"):
        silver_stream(log_source(spark, p, path), p, output_mode="update")


def test_listener_records_events(spark):
    class Ev:
        def __init__(self, **kw):
            self.__dict__.update(kw)

    log = ProgressLog()
    log.onQueryStarted(Ev(id="1", runId="r", name="q"))
    log.onQueryProgress(Ev(progress=Ev(name="q", batchId=0, numInputRows=5,
                                       processedRowsPerSecond=None, eventTime={})))
    log.onQueryIdle(Ev(id="1"))
    log.onQueryTerminated(Ev(id="1", exception=None))
    assert [e["kind"] for e in list(log.events)] == ["started", "progress", "idle", "terminated"]
    assert log.events[1]["rate"] is None and log.events[1]["watermark"] is None
    rows = log.frame(spark).collect()
    assert len(rows) == 1 and rows[0]["input_rows"] == 5 and rows[0]["query_name"] == "q"


def test_one_stage_silver_supports_update_mode(spark, tmp):
    from ordertide.sources.log_source import log_source
    path = _log_files(spark, tmp, parts=1)
    p = pipeline_params(tmp, salt_factor=None, sink_format="noop", silver_path=None,
                        silver_partition_by=())
    q = silver_stream(log_source(spark, p, path), p, output_mode="update")
    q.awaitTermination()
    assert q.exception() is None
    # update mode emits every changed (window, store) row in the data batch
    assert q.recentProgress[0]["sink"]["numOutputRows"] > 0


def test_bronze_stream_partitioned_by_publish_date(spark, tmp):
    from ordertide.sources.log_source import log_source
    path = _log_files(spark, tmp, parts=1)
    p = pipeline_params(tmp, bronze_partition_by=("published_date",))
    q = bronze_stream(log_source(spark, p, path), p)
    q.awaitTermination()
    days = [d for d in os.listdir(p.bronze_path) if d.startswith("published_date=")]
    assert len(days) >= 28
    assert spark.read.parquet(p.bronze_path).count() == spark.read.parquet(path).count()


def test_partitioned_silver_writes_one_file_per_store_per_batch(spark, tmp):
    from ordertide.sources.log_source import log_source
    path = _log_files(spark, tmp, parts=3)
    p = pipeline_params(tmp, salt_factor=None)
    q = silver_stream(log_source(spark, p, path), p)
    q.awaitTermination()
    writing = len(q.recentProgress)          # file sinks do not report output rows
    for d in os.listdir(p.silver_path):
        if d.startswith("store_id="):
            files = [f for f in os.listdir(os.path.join(p.silver_path, d)) if f.endswith(".parquet")]
            assert 1 <= len(files) <= writing, d


def test_chained_aggregation_stage_two_holds_no_state(spark, tmp):
    from ordertide.sources.log_source import log_source
    key = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    path = _log_files(spark, tmp, parts=2)
    p = pipeline_params(tmp, salt_factor=4)
    old = spark.conf.get(key)
    spark.conf.set(key, "true")                  # row counts for this check only
    try:
        q = silver_stream(log_source(spark, p, path), p)
        q.awaitTermination()
    finally:
        spark.conf.set(key, old)
    assert q.exception() is None
    for prog in q.recentProgress:
        stage2, stage1 = prog["stateOperators"]
        assert stage2["numRowsTotal"] == 0               # finalized rows pass straight through
    last = q.recentProgress[-1]["stateOperators"]
    assert last[0]["numRowsUpdated"] + sum(p["stateOperators"][0]["numRowsUpdated"]
                                           for p in q.recentProgress[:-1]) > 0


def test_interrupted_stream_resumes_exactly_once(spark, tmp):
    import threading
    from ordertide.sources.log_source import log_source
    path = _log_files(spark, tmp, parts=6)
    p = pipeline_params(tmp, trigger_available_now=False, trigger_processing_time="0 seconds")
    q = bronze_stream(log_source(spark, p, path), p)
    # stop while batches are still being processed (at most one file per batch)
    done = threading.Event()

    def stop_soon():
        while not done.is_set():
            if q.lastProgress and q.lastProgress["batchId"] >= 1:
                q.stop()
                return
            time.sleep(0.05)

    t = threading.Thread(target=stop_soon)
    t.start()
    try:
        q.awaitTermination(60)
    finally:
        done.set()
        t.join()
        q.stop()
    n_in = spark.read.parquet(path).count()
    first = spark.read.parquet(p.bronze_path).count() if os.path.exists(p.bronze_path) else 0
    assert first < n_in                                          # interrupted part-way
    q2 = bronze_stream(log_source(spark, p.replace(trigger_available_now=True), path),
                       p.replace(trigger_available_now=True))
    q2.awaitTermination()
    bronze = spark.read.parquet(p.bronze_path)
    assert bronze.count() == n_in
    assert bronze.select("offset").distinct().count() == n_in    # no duplicates


def _time_ordered_log_files(spark, tmp, parts=5):
    """The raw log as ``parts`` files in publish-time order (one write each), so
    that no row arrives behind the watermark."""
    path = f"{tmp}/tlog"
    raw = raw_log(flat_orders(read_table(spark, SF001, "events")))
    micros = F.unix_micros("timestamp")
    lo, hi = raw.agg(F.min(micros), F.max(micros)).first()
    step = (hi - lo) // parts + 1
    for k in range(parts):
        raw.filter(F.call_function("div", micros - F.lit(lo), F.lit(step)) == k) \
           .coalesce(1).write.mode("append").parquet(path)
    return path


def test_interrupted_silver_recovers_state(spark, tmp):
    """Stopped in the middle of a batch and restarted, the silver query gives
    the same windows as an uninterrupted run (state restored from the
    checkpoint). Input is in publish-time order: rows behind the watermark may
    or may not be dropped after a restart, so they would make runs differ."""
    import threading
    from ordertide.sources.log_source import log_source
    path = _time_ordered_log_files(spark, tmp)
    cols = ["window_start", "store_id", "total_order_count", "avg_order_value", "avg_wait_time_seconds"]

    ref = pipeline_params(f"{tmp}/ref", salt_factor=4, silver_partition_by=())
    r = silver_stream(log_source(spark, ref, path), ref)
    r.awaitTermination()
    expected = sorted(tuple(x) for x in spark.read.parquet(ref.silver_path).select(*cols).collect())
    assert sum(x["stateOperators"][1]["numRowsDroppedByWatermark"] for x in r.recentProgress) == 0

    p = pipeline_params(f"{tmp}/cut", salt_factor=4, silver_partition_by=(), trigger_available_now=False,
                        trigger_processing_time="0 seconds")
    q = silver_stream(log_source(spark, p, path), p)
    done = threading.Event()

    def stop_soon():                          # as soon as batch 1 has finished
        while not done.is_set():
            if q.lastProgress and q.lastProgress["batchId"] >= 1:
                q.stop()
                return
            time.sleep(0.05)

    t = threading.Thread(target=stop_soon)
    t.start()
    try:
        q.awaitTermination(60)
    finally:
        done.set()
        t.join()
        q.stop()
    p2 = p.replace(trigger_available_now=True)
    q2 = silver_stream(log_source(spark, p2, path), p2)
    q2.awaitTermination()
    assert q2.exception() is None
    got = sorted(tuple(x) for x in spark.read.parquet(p.silver_path).select(*cols).collect())
    assert got == expected and len(got) > 0


def test_unregistered_and_odd_headers_do_not_stop_silver(spark, tmp):
    from ordertide.sources.log_source import log_source
    path = _log_files(spark, tmp, parts=2)
    odd = spark.createDataFrame([(None, bytearray(b"\x00\xff\xff\xff\xff{}"), "t", 0, -1, DAY), (None, bytearray(b"\x01"), "t", 0, -2, DAY), (None, None, "t", 0, -3, DAY)],
                                "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    odd.write.mode("append").parquet(path)
    p = pipeline_params(tmp)
    q = silver_stream(log_source(spark, p, path), p)
    q.awaitTermination()
    assert q.exception() is None and spark.read.parquet(p.silver_path).count() > 0


def test_drain_that_times_out_raises():
    from ordertide.streaming.sinks import await_all

    class Slow:
        name, id = "slow", "1"
        def awaitTermination(self, timeout=None):
            return False
        def exception(self):
            return None

    with pytest.raises(TimeoutError):
        await_all([Slow()], PipelineParams(trigger_available_now=True), timeout=1)


def test_listener_keeps_a_bounded_log():
    log = ProgressLog(keep=3)
    for i in range(10):
        log.onQueryIdle(type("E", (), {"id": str(i)}))
    assert [e["id"] for e in log.events] == ["7", "8", "9"]


def test_table_names_resolve_once():
    from ordertide.streaming.tables import resolved
    assert resolved("t", "db") == "db.t" and resolved("x.t", "db") == "x.t"
    assert resolved("t", "db", "cat") == "cat.db.t" and resolved("c.x.t", "db", "cat") == "c.x.t"


def test_silver_by_date_adds_one_file_a_batch(spark, tmp):
    from ordertide.sources.log_source import log_source
    path = _log_files(spark, tmp, parts=1)
    p = pipeline_params(tmp, silver_partition_by=("window_date",))
    q = silver_stream(log_source(spark, p, path), p)
    q.awaitTermination()
    assert q.exception() is None
    silver = spark.read.parquet(p.silver_path)
    assert silver.filter("window_date <> to_date(window_start)").count() == 0 and silver.count() > 0
    for date in [d for d in os.listdir(p.silver_path) if d.startswith("window_date=")]:
        assert len([f for f in os.listdir(f"{p.silver_path}/{date}") if f.endswith(".parquet")]) <= len(q.recentProgress)
