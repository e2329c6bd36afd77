import os

from pyspark.sql import functions as F

from ordertide.operators.metrics import store_metrics
from ordertide.operators.profiles import dashboard, latest_bronze
from ordertide.operators.curate import bronze_projection
from ordertide.params import PRODUCTION, PipelineParams
from ordertide.schemas import ORDER_EVENT, ORDER_EVENT_V2, BRONZE_COLUMNS, SILVER_COLUMNS
from ordertide.sources.fixtures import flat_orders, raw_log
from ordertide.sources.log_source import log_source
from ordertide.sources.tables import read_result, read_table
from ordertide.streaming.sinks import bronze_stream, silver_stream
from ordertide.streaming.tables import bronze_ddl, provision, silver_ddl
from ordertide.operators.curate import curate_orders

from tests.conftest import SF001


def test_provision_is_idempotent_and_typed(spark):
    t1 = provision(spark, "ops_test", "bronze_orders", "silver_metrics")
    t2 = provision(spark, "ops_test", "bronze_orders", "silver_metrics")
    names = sorted(r["tableName"] for r in t2.collect())
    assert names == ["bronze_orders", "silver_metrics"] == sorted(r["tableName"] for r in t1.collect())
    b = spark.table("ops_test.bronze_orders")
    assert [(f.name, f.dataType.simpleString()) for f in b.schema.fields] == [
        (n, t.lower().replace("integer", "int")) for n, t, _ in BRONZE_COLUMNS]
    s = spark.table("ops_test.silver_metrics")
    assert [f.name for f in s.schema.fields][-1] == "window_date"       # partition column
    parts = spark.sql("DESCRIBE TABLE EXTENDED ops_test.silver_metrics").collect()
    assert any("window_date" in (r["col_name"] or "") for r in parts)


def test_delta_properties_only_for_delta():
    assert "TBLPROPERTIES" not in bronze_ddl("db.b", "parquet")
    assert "delta.enableChangeDataFeed" in bronze_ddl("db.b", "delta")
    assert "PARTITIONED BY (window_date)" in silver_ddl("db.s", "delta")
    assert "PARTITIONED BY (store_id)" in silver_ddl("db.s", "delta", ("store_id",))
    assert "delta.enableChangeDataFeed" not in silver_ddl("db.s", "delta")


def test_stream_into_named_tables(spark, tmp):
    provision(spark, "ops_stream", "bronze", "silver", silver_partition_by=())
    path = f"{tmp}/log"
    raw_log(flat_orders(read_table(spark, SF001, "events"))).write.parquet(path)
    p = PipelineParams(source_format="parquet", trigger_available_now=True, salt_factor=4,
                       schemas={101: ORDER_EVENT, 102: ORDER_EVENT_V2}, silver_partition_by=(),
                       bronze_table="ops_stream.bronze", bronze_checkpoint=f"{tmp}/ckb",
                       silver_table="ops_stream.silver", silver_checkpoint=f"{tmp}/cks")
    bq = bronze_stream(log_source(spark, p, path), p)
    sq = silver_stream(log_source(spark, p, path), p)
    bq.awaitTermination(); sq.awaitTermination()
    assert bq.exception() is None and sq.exception() is None
    bronze = read_result(spark, table="ops_stream.bronze")
    assert bronze.count() == spark.read.parquet(path).count()
    silver = read_result(spark, table="ops_stream.silver")
    assert silver.count() > 0
    top = latest_bronze(bronze, 20).collect()
    assert len(top) == 20
    ordered = dashboard(silver).select("window_end").collect()
    assert ordered == sorted(ordered, reverse=True)


def test_reader_merges_additive_schemas(spark, tmp):
    spark.createDataFrame([(1, "a")], "id int, x string").write.parquet(f"{tmp}/t/v=1")
    spark.createDataFrame([(2, "b", 3.5)], "id int, x string, y double").write.parquet(f"{tmp}/t/v=2")
    merged = read_result(spark, path=f"{tmp}/t", merge_schema=True)
    assert set(merged.columns) == {"id", "x", "y", "v"}
    assert merged.filter("id = 1").first()["y"] is None


def test_batch_silver_written_partitioned(spark, tmp):
    cur = curate_orders(flat_orders(read_table(spark, SF001, "events")))
    store_metrics(cur, PRODUCTION, stamp=True).write.partitionBy("store_id").parquet(f"{tmp}/silver")
    assert os.path.isdir(f"{tmp}/silver/store_id=STORE-0001")
    back = read_result(spark, path=f"{tmp}/silver")
    assert set(back.columns) == {n for n, _, _ in SILVER_COLUMNS}


def test_bronze_replay_prunes_by_publish_time(spark, tmp):
    import datetime as dt
    from ordertide.sources.tables import read_bronze

    raw = raw_log(flat_orders(read_table(spark, SF001, "events")))
    bronze_projection(raw, partition_by=("published_date",)).write.partitionBy("published_date") \
        .parquet(f"{tmp}/bronze")
    since, until = dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 12, 6)
    df = read_bronze(spark, path=f"{tmp}/bronze", since=since, until=until)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(published_date" in plan
    assert "GreaterThanOrEqual(kafka_published_timestamp" in plan
    expected = raw.filter((F.col("timestamp") >= F.lit(since).cast("timestamp"))
                          & (F.col("timestamp") < F.lit(until).cast("timestamp"))).count()
    assert df.count() == expected > 0


def test_log_source_batch_and_one_sided_ranges(spark, tmp):
    import datetime as dt
    from ordertide.sources.tables import read_bronze

    raw = raw_log(flat_orders(read_table(spark, SF001, "events")))
    raw.write.parquet(f"{tmp}/log")
    p = PipelineParams(source_format="parquet")
    assert log_source(spark, p, f"{tmp}/log", streaming=False).count() == raw.count()
    bronze_projection(raw).write.parquet(f"{tmp}/bronze")          # unpartitioned bronze
    cut = dt.datetime(2024, 1, 15)
    before = read_bronze(spark, path=f"{tmp}/bronze", until=cut).count()
    after = read_bronze(spark, path=f"{tmp}/bronze", since=cut).count()
    assert before > 0 and after > 0 and before + after == raw.count()


def test_bronze_table_partitioned_by_publish_date(spark, tmp):
    provision(spark, "ops_dated", "bronze", None, bronze_partition_by=("published_date",))
    b = spark.table("ops_dated.bronze")
    assert b.columns[-1] == "published_date"
    raw = raw_log(flat_orders(read_table(spark, SF001, "events")))
    bronze_projection(raw, stamp=True, partition_by=("published_date",)).write.insertInto("ops_dated.bronze")
    assert spark.table("ops_dated.bronze").select("published_date").distinct().count() >= 28
