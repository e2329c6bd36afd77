from pyspark.sql import functions as F

from ordertide.params import PRODUCTION, PipelineParams
from ordertide.session import ROCKSDB_PROVIDER, fresh_dir, session_conf, work_dir
from ordertide.streaming.sinks import await_all, bronze_stream
from ordertide.sources.fixtures import flat_orders, raw_log
from ordertide.sources.log_source import log_source
from ordertide.sources.tables import read_table

from tests.conftest import SF001


def test_session_conf_from_params():
    conf = session_conf(PRODUCTION)
    assert conf["spark.sql.adaptive.enabled"] == "true"
    assert conf["spark.sql.shuffle.partitions"] == "128"
    assert conf["spark.sql.streaming.stateStore.providerClass"] == ROCKSDB_PROVIDER
    assert conf["spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"] == "true"


def test_state_store_applied(spark):
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == ROCKSDB_PROVIDER


def test_work_dir_uses_session_setting(spark):
    base = work_dir(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert base == configured.rstrip("/") if configured else base == work_dir(spark)
    a, b = fresh_dir(spark, "x"), fresh_dir(spark, "x")
    assert a != b and a.startswith(base)


def test_drain_mode_awaits_each_query_and_stamps_one_time_per_batch(spark, tmp):
    path = f"{tmp}/log"
    raw_log(flat_orders(read_table(spark, SF001, "events"))).write.parquet(path)
    p = PipelineParams(source_format="parquet", trigger_available_now=True,
                       bronze_path=f"{tmp}/b", bronze_checkpoint=f"{tmp}/ck")
    q = bronze_stream(log_source(spark, p, path), p)
    await_all([q], p)
    assert not q.isActive
    stamps = spark.read.parquet(f"{tmp}/b").agg(F.countDistinct("bronze_ingestion_timestamp")).first()[0]
    assert stamps == len([x for x in q.recentProgress if x["numInputRows"] > 0])


def test_continuous_mode_awaits_any_query(spark, tmp):
    import time
    path = f"{tmp}/log"
    raw_log(flat_orders(read_table(spark, SF001, "events"))).write.parquet(path)
    p = PipelineParams(source_format="parquet", trigger_processing_time="1 second",
                       bronze_path=f"{tmp}/b", bronze_checkpoint=f"{tmp}/ck")
    q = bronze_stream(log_source(spark, p, path), p)
    try:
        t0 = time.time()
        await_all([q], p, spark, timeout=3)        # returns when the timeout passes
        assert q.isActive and time.time() - t0 >= 2.5
    finally:
        q.stop()
    assert not q.isActive
