"""Job entry: parameters -> session -> log source -> bronze + silver queries -> wait.

usage: python -m ordertide.job [params.json] [log path for file sources]
"""

from __future__ import annotations

import logging
import sys

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ordertide.params import PRODUCTION, PipelineParams
from ordertide.session import build_session
from ordertide.sources.log_source import log_source
from ordertide.streaming.listener import ProgressLog
from ordertide.streaming.sinks import await_all, bronze_stream, silver_stream
from ordertide.streaming.tables import provision, resolved

log = logging.getLogger("ordertide")


SINKS = ("bronze", "silver")


def start(spark: SparkSession, params: PipelineParams, log_path: str | None = None,
          sinks: tuple[str, ...] = SINKS) -> tuple[StreamingQuery, ...]:
    """Provisions named tables (if any), then starts both queries (or only those of ``sinks``) on one source."""
    if params.bronze_table or params.silver_table:
        params = params.replace(**{
            name: resolved(getattr(params, name), params.database, params.catalog)
            for name in ("bronze_table", "silver_table") if getattr(params, name)})
        provision(spark, params.database, params.bronze_table, params.silver_table,
                  fmt=params.sink_format, catalog=params.catalog,
                  silver_partition_by=params.silver_partition_by,
                  bronze_partition_by=params.bronze_partition_by)
    raw = log_source(spark, params, log_path)
    begin = {"bronze": bronze_stream, "silver": silver_stream}
    return tuple(begin[name](raw, params) for name in SINKS if name in sinks)


def main(argv: list[str] | None = None) -> int:
    argv = list(sys.argv[1:] if argv is None else argv)
    params = PipelineParams.from_json(argv[0]) if argv else PRODUCTION
    log_path = argv[1] if len(argv) > 1 else None
    spark = build_session(params)
    spark.streams.addListener(ProgressLog())
    bronze, silver = start(spark, params, log_path)
    log.info("started %s (%s) and %s (%s)", bronze.name, bronze.id, silver.name, silver.id)
    await_all([bronze, silver], params, spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
