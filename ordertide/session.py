"""Session setup (W7, W13) and the shared work folder for streams and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from ordertide.params import PipelineParams
from ordertide.sources.log_source import floor_conf

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def session_conf(params: PipelineParams) -> dict[str, str]:
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(params.shuffle_partitions),
        "spark.sql.session.timeZone": "UTC",
        **floor_conf(params),
        # off-heap keyed state with incremental (changelog) checkpoints
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        # no read-before-write to keep a total row count (only a metric)
        "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    }


def build_session(params: PipelineParams | None = None, master: str | None = None,
                  app_name: str = "ordertide", conf: dict[str, str] | None = None) -> SparkSession:
    params = params or PipelineParams()
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**session_conf(params), **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_state_store(spark)
    return spark


def apply_state_store(spark: SparkSession) -> None:
    """State backend for stateful streaming (runtime-settable session confs)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")


def streaming_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A child session (same context, own SQL conf) for running a stream.

    A stateful query keeps ``spark.sql.shuffle.partitions`` state partitions
    for its whole life: the caller's setting, unless ``partitions`` is given.
    Time zone and state store follow the library's setup.
    """
    child = spark.newSession()
    child.conf.set("spark.sql.shuffle.partitions", str(partitions or spark.conf.get("spark.sql.shuffle.partitions")))
    child.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    apply_state_store(child)
    return child


_local_folders: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written tables.

    Uses the cluster's ``spark.checkpoint.dir``. Only a local-mode session
    without one (tests) gets a folder of its own, and the caller's context
    keeps its setting.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not conf_dir:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        app = spark.sparkContext.applicationId
        conf_dir = _local_folders.setdefault(app, "") or tempfile.mkdtemp(prefix="ordertide-")
        _local_folders[app] = conf_dir
    return conf_dir.rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused sub-folder of the work folder."""
    base = work_dir(spark)
    return f"{base}/ordertide/{label}-{uuid.uuid4().hex[:12]}"
