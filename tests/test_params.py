from ordertide.params import PRODUCTION, SERVERLESS, SMALL, PipelineParams
from ordertide.sources.log_source import log_source_options


def test_presets_match_shipped_parameter_sets():
    assert (PRODUCTION.max_offsets_per_trigger, PRODUCTION.min_partitions, PRODUCTION.salt_factor,
            PRODUCTION.shuffle_partitions) == (50000, 64, 16, 128)
    assert SERVERLESS.trigger_available_now and SERVERLESS.salt_factor == 4
    assert SMALL.trigger_processing_time == "10 seconds" and SMALL.shuffle_partitions == 4
    for p in (PRODUCTION, SERVERLESS, SMALL):
        assert p.watermark_delay == "15 minutes"
        assert p.window_duration == p.slide_duration == "5 minutes"


def test_from_nested_dict():
    conf = {
        "source": {"topic": "orders", "starting_offsets": "earliest", "fail_on_data_loss": "false"},
        "tuning": {"max_offsets_per_trigger": 10, "salt_factor": 8, "trigger_available_now": "true"},
        "sinks": {"silver_partition_by": ["store_id"]},
        "unknown_section": {"ignored": 1},
    }
    p = PipelineParams.from_dict(conf)
    assert p.topic == "orders" and p.starting_offsets == "earliest"
    assert p.fail_on_data_loss is False and p.trigger_available_now is True
    assert p.max_offsets_per_trigger == 10 and p.salt_factor == 8
    assert p.silver_partition_by == ("store_id",)


def test_source_options_kafka_and_files():
    p = PipelineParams(source_options={"kafka.bootstrap.servers": "broker:9092",
                                       "kafka.security.protocol": "SASL_SSL",
                                       "kafka.sasl.mechanism": "PLAIN"})
    o = log_source_options(p)
    assert o["subscribe"] == "live_orders"
    assert o["maxOffsetsPerTrigger"] == "50000" and o["minPartitions"] == "64"
    assert o["startingOffsets"] == "latest" and o["failOnDataLoss"] == "false"
    assert o["kafka.security.protocol"] == "SASL_SSL" and o["kafka.bootstrap.servers"] == "broker:9092"
    f = log_source_options(p.replace(source_format="parquet", max_files_per_trigger=3, source_options={}))
    assert f == {"maxFilesPerTrigger": "3", "ignoreMissingFiles": "true"}


def test_salted_flag():
    assert PRODUCTION.salted
    assert not PRODUCTION.replace(salt_factor=None).salted
    assert not PRODUCTION.replace(salt_factor=1).salted


def test_sasl_plain_options_merge_into_source_options():
    from ordertide.sources.log_source import sasl_plain_options
    sec = sasl_plain_options("broker:9093", "key", "secret")
    assert sec["kafka.sasl.jaas.config"] == (
        "org.apache.kafka.common.security.plain.PlainLoginModule required "
        "username='key' password='secret';")
    o = log_source_options(PipelineParams(source_options=sec))
    assert o["kafka.security.protocol"] == "SASL_SSL" and o["kafka.sasl.mechanism"] == "PLAIN"
    assert o["subscribe"] == "live_orders"


def test_original_job_configuration_layout():
    conf = {
        "environment": "production",
        "kafka": {"topic": "orders_topic", "starting_offsets": "latest", "fail_on_data_loss": "false"},
        "schema_registry": {"subject": "orders-value", "mode": "PERMISSIVE"},
        "delta_lake": {"bronze_table_path": "/lake/b", "bronze_checkpoint_path": "/ck/b",
                       "silver_table_path": "/lake/s", "silver_checkpoint_path": "/ck/s",
                       "silver_table_name": "db.silver"},
        "tuning_parameters": {"max_offsets_per_trigger": 50000, "min_partitions": 64, "salt_factor": 16,
                              "watermark_duration": "15 minutes", "window_duration": "5 minutes",
                              "slide_duration": "5 minutes", "trigger_processing_time": "10 seconds",
                              "spark_shuffle_partitions": 128},
    }
    p = PipelineParams.from_dict(conf)
    assert p.topic == "orders_topic" and p.fail_on_data_loss is False
    assert p.watermark_delay == "15 minutes" and p.shuffle_partitions == 128 and p.salt_factor == 16
    assert (p.bronze_path, p.bronze_checkpoint, p.silver_path, p.silver_checkpoint) == (
        "/lake/b", "/ck/b", "/lake/s", "/ck/s")
    assert p.silver_table == "db.silver" and p.sink_format == "delta" and p.parse_mode == "PERMISSIVE"


def test_static_mode_and_sections_apart():
    p = PipelineParams.from_dict({"confluent_kafka": {"topic": "t"}, "schema_registry": {"mode": "STATIC"}, "delta_lake": {"database": "d"},
                                  "other": {"mode": "ignored?"}} | {"other": {}})
    assert (p.decode, p.parse_mode, p.body_format, p.sink_format, p.database) == ("fixed", "FAILFAST", "avro", "delta", "d")
    q = PipelineParams.from_dict({"confluent_kafka": {"topic": "first"}, "later": {"topic": "second"}, "schemas": {"7": {"type": "record", "name": "E", "fields": []}}})
    assert q.topic == "first" and list(q.schemas) == [7]


def test_file_sources_count_files():
    p = PipelineParams(source_format="parquet")
    assert "maxFilesPerTrigger" not in log_source_options(p)
    assert log_source_options(p.replace(max_files_per_trigger=2))["maxFilesPerTrigger"] == "2"
