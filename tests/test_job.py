import json
import os

import pytest

from ordertide.params import PRODUCTION, SERVERLESS, SMALL, PipelineParams
from ordertide.job import main
from ordertide.schemas import ORDER_EVENT, ORDER_EVENT_V2
from ordertide.sources.fixtures import flat_orders, raw_log
from ordertide.sources.tables import read_table

from tests.conftest import SF001

SCHEMAS = {"101": ORDER_EVENT.simpleString(), "102": ORDER_EVENT_V2.simpleString()}

CONFIG = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "config")


def test_config_files_match_presets():
    for name, preset in (("production", PRODUCTION), ("serverless", SERVERLESS), ("small", SMALL)):
        p = PipelineParams.from_json(os.path.join(CONFIG, f"{name}.json"))
        for key in ("max_offsets_per_trigger", "min_partitions", "salt_factor", "watermark_delay",
                    "window_duration", "slide_duration", "trigger_available_now", "shuffle_partitions"):
            assert getattr(p, key) == getattr(preset, key), (name, key)


def test_main_runs_both_queries_to_completion(spark, tmp):
    log_path = f"{tmp}/log"
    raw_log(flat_orders(read_table(spark, SF001, "events"))).repartition(2).write.parquet(log_path)
    conf = {
        "source": {"source_format": "parquet", "max_files_per_trigger": 1},
        "decoder": {"body_format": "json"}, "schemas": SCHEMAS,
        "tuning": {"trigger_available_now": True, "salt_factor": None, "shuffle_partitions": 4},
        "sinks": {"sink_format": "parquet",
                  "bronze_path": f"{tmp}/bronze", "bronze_checkpoint": f"{tmp}/ckb",
                  "silver_path": f"{tmp}/silver", "silver_checkpoint": f"{tmp}/cks"},
    }
    with open(f"{tmp}/params.json", "w") as fh:
        json.dump(conf, fh)
    assert main([f"{tmp}/params.json", log_path]) == 0
    assert spark.read.parquet(f"{tmp}/bronze").count() == 1000
    assert spark.read.parquet(f"{tmp}/silver").count() > 0


def test_main_provisions_and_fills_named_tables(spark, tmp):
    log_path = f"{tmp}/log"
    raw_log(flat_orders(read_table(spark, SF001, "events"))).repartition(2).write.parquet(log_path)
    conf = {
        "source": {"source_format": "parquet", "max_files_per_trigger": 1},
        "decoder": {"body_format": "json"}, "schemas": SCHEMAS,
        "tuning": {"trigger_available_now": True, "salt_factor": 4, "shuffle_partitions": 4},
        "sinks": {"sink_format": "parquet", "database": "ops_job",
                  "bronze_table": "ops_job.bronze", "bronze_checkpoint": f"{tmp}/ckb",
                  "silver_table": "ops_job.silver", "silver_checkpoint": f"{tmp}/cks"},
    }
    with open(f"{tmp}/params.json", "w") as fh:
        json.dump(conf, fh)
    assert main([f"{tmp}/params.json", log_path]) == 0
    names = {r["tableName"] for r in spark.sql("SHOW TABLES IN ops_job").collect()}
    assert {"bronze", "silver"} <= names
    assert spark.table("ops_job.bronze").count() == 1000
    silver = spark.table("ops_job.silver")
    assert silver.count() > 0 and silver.columns[-1] == "window_date"


def test_plans_cli(spark, capsys):
    from ordertide.plans.__main__ import main as plans_main
    assert plans_main(["--list"]) == 0
    assert "store_metrics_5m" in capsys.readouterr().out.split()
    assert plans_main(["no_such_query"]) == 2
    assert plans_main(["skew_profile", SF001]) == 0


@pytest.mark.parametrize("bronze, silver", [("bronze", "silver"), ("ops_b.bronze", "ops_s.silver"), ("spark_catalog.ops_b3.bronze", "spark_catalog.ops_b3.silver")])
def test_tables_provisioned_are_those_written(spark, tmp, bronze, silver):
    from ordertide.job import start
    from ordertide.streaming.sinks import await_all

    log_path = f"{tmp}/log"
    raw_log(flat_orders(read_table(spark, SF001, "events"))).write.parquet(log_path)
    p = PipelineParams(source_format="parquet", trigger_available_now=True, schemas={101: ORDER_EVENT, 102: ORDER_EVENT_V2},
                       database="ops_names", bronze_table=bronze, silver_table=silver, shuffle_partitions=4,
                       bronze_checkpoint=f"{tmp}/ckb", silver_checkpoint=f"{tmp}/cks")
    await_all(start(spark, p, log_path), p, spark)
    full = [n if "." in n else f"ops_names.{n}" for n in (bronze, silver)]
    assert spark.table(full[0]).count() == 1000 and spark.table(full[1]).count() > 0
    assert "window_date" in {r["col_name"] for r in spark.sql(f"DESCRIBE {full[1]}").collect() if r["col_name"]}
    listed = {r["tableName"] for r in spark.sql("SHOW TABLES IN ops_names").collect()}
    assert listed == ({"bronze", "silver"} if "." not in bronze else listed & {"bronze", "silver"})
    for name in full:
        spark.sql(f"DROP TABLE {name}")
