"""Streaming log source.

Production reads a message log (``kafka``); any file format of the raw-log
shape works for replays and tests. Options map one-to-one from parameters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.params import PipelineParams
from ordertide.schemas import RAW_LOG


PLAIN_LOGIN_MODULE = "org.apache.kafka.common.security.plain.PlainLoginModule"


def sasl_plain_options(bootstrap_servers: str, username: str, password: str,
                       login_module: str = PLAIN_LOGIN_MODULE) -> dict[str, str]:
    """Options for a SASL_SSL / PLAIN secured log (pass as ``source_options``)."""
    jaas = f"{login_module} required username='{username}' password='{password}';"
    return {
        "kafka.bootstrap.servers": bootstrap_servers,
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": jaas,
    }


def log_source_options(params: PipelineParams) -> dict[str, str]:
    if params.source_format == "kafka":
        opts = {
            "subscribe": params.topic,
            "startingOffsets": params.starting_offsets,         # S4: only for a new checkpoint
            "maxOffsetsPerTrigger": str(params.max_offsets_per_trigger),   # S2
            "minPartitions": str(params.min_partitions),        # S3
            "failOnDataLoss": str(params.fail_on_data_loss).lower(),       # S5
        }
    else:
        # file replay of the same columns: files are counted, or their bytes, which stand for records
        opts = {"ignoreMissingFiles": str(not params.fail_on_data_loss).lower()}
        if params.max_files_per_trigger:
            opts["maxFilesPerTrigger"] = str(params.max_files_per_trigger)
        elif params.record_bytes:
            opts["maxBytesPerTrigger"] = str(params.max_offsets_per_trigger * params.record_bytes)
    opts.update({k: str(v) for k, v in params.source_options.items()})   # S6: security etc.
    return opts


def log_source(spark: SparkSession, params: PipelineParams, path: str | None = None,
               streaming: bool = True) -> DataFrame:
    """The raw log, ``(key, value, topic, partition, offset, timestamp)``."""
    opts = log_source_options(params)
    if params.source_format == "kafka":
        reader = spark.readStream if streaming else spark.read
        if not streaming:                         # a bounded read of the whole retained log
            opts = {k: v for k, v in opts.items() if k != "maxOffsetsPerTrigger"}
            # "latest" would be empty in a bounded read; a position given by offset stays
            if opts.get("startingOffsets") == "latest":
                opts["startingOffsets"] = "earliest"
        return reader.format("kafka").options(**opts).load()
    reader = spark.readStream if streaming else spark.read
    if not streaming:
        opts = {k: v for k, v in opts.items() if k not in ("maxFilesPerTrigger", "maxBytesPerTrigger")}
    return reader.format(params.source_format).schema(RAW_LOG).options(**opts).load(path)


def record_bytes(written: DataFrame) -> int | None:
    """Average stored bytes of a record of a file table: what ``record_bytes`` is for its log. Row
    counts come from the files' own footers."""
    files = written.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("size"))
    per_file = files.groupBy("f").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("n"))
    size, n = per_file.agg(F.sum("size"), F.sum("n")).first()
    return -(-size // n) if n else None


def floor_conf(params: PipelineParams) -> dict[str, str]:
    """S3 for file sources, which have no minPartitions: session settings by which the scan itself splits
    its files (at row groups) into ``min_partitions`` tasks or more, without a shuffle."""
    if not params.read_floor:
        return {}
    return {"spark.sql.files.minPartitionNum": str(params.min_partitions), "spark.sql.files.openCostInBytes": "65536"}
