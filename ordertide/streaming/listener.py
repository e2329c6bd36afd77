"""Progress telemetry.

``ProgressLog`` is a ``StreamingQueryListener`` that records one entry per
event (start, progress, idle, terminated). ``progress_frame`` turns the
progress of finished or running queries into a DataFrame (one row per batch),
which is how the tests and the benchmark read telemetry. ``state_rows`` is only
maintained when the RocksDB store tracks its row count (off by default here), else null.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger("ordertide.streaming")

PROGRESS_DDL = ("query_name STRING, batch_id BIGINT, input_rows BIGINT, "
                "rows_per_second DOUBLE, watermark STRING, dropped_by_watermark BIGINT, "
                "state_rows BIGINT")


def progress_row(p: dict) -> tuple:
    ops = p.get("stateOperators") or []
    return (
        p.get("name"), p.get("batchId"), p.get("numInputRows"),
        p.get("processedRowsPerSecond"),
        (p.get("eventTime") or {}).get("watermark"),
        sum(int(o.get("numRowsDroppedByWatermark", 0) or 0) for o in ops),
        # the RocksDB store reports no total unless it tracks it
        sum(totals) if (totals := [int(o.get("numRowsTotal") or 0) for o in ops]) and any(totals) else None,
    )


class ProgressLog(StreamingQueryListener):
    """Logs each event and keeps the latest ``keep`` of them."""

    def __init__(self, keep: int = 1000) -> None:
        self.events: deque[dict] = deque(maxlen=keep)

    def onQueryStarted(self, event) -> None:
        self.events.append({"kind": "started", "id": str(event.id), "name": event.name})
        log.info("stream started: %s (%s)", event.name, event.id)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        rate = getattr(p, "processedRowsPerSecond", None)
        watermark = (getattr(p, "eventTime", None) or {}).get("watermark")
        self.events.append({"kind": "progress", "name": p.name, "batch": p.batchId,
                            "rows": p.numInputRows, "rate": rate, "watermark": watermark})
        log.info("batch %s of %s: %s rows, %s rows/s, watermark %s", p.batchId, p.name,
                 p.numInputRows, "n/a" if rate is None else f"{rate:.1f}", watermark or "n/a")

    def onQueryIdle(self, event) -> None:
        self.events.append({"kind": "idle", "id": str(event.id)})

    def frame(self, spark: SparkSession) -> DataFrame:
        """Captured progress events as rows (query, batch, input rows, rate, watermark)."""
        rows = [(e["name"], e["batch"], e["rows"], e["rate"], e["watermark"])
                for e in self.events if e["kind"] == "progress"]
        return spark.createDataFrame(rows, "query_name STRING, batch_id BIGINT, input_rows BIGINT, "
                                           "rows_per_second DOUBLE, watermark STRING")

    def onQueryTerminated(self, event) -> None:
        self.events.append({"kind": "terminated", "id": str(event.id), "error": event.exception})
        if event.exception:
            log.error("stream %s failed: %s", event.id, event.exception)
        else:
            log.info("stream %s ended cleanly", event.id)


class ProgressTable:
    """Progress of finished runs as a table that outlives them, keyed by run, query and batch."""

    DDL = ("run LONG, query_name STRING, batch_id LONG, input_rows LONG, invalid_rows LONG, rows_per_second DOUBLE, "
           "watermark TIMESTAMP, dropped_by_watermark LONG, state_rows LONG")

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def append(self, run: int, queries) -> None:
        """The kept progress of a run's queries (``spark.sql.streaming.numRecentProgressUpdates`` of each);
        a run that is appended again replaces its rows."""
        rows = []
        for p in (p for q in queries for p in q.recentProgress):
            name, batch, n, rate, mark, dropped, state = progress_row(p)
            seen = (p.get("observedMetrics") or {}).get("frames")
            at = dt.datetime.fromisoformat(mark.replace("Z", "+00:00")) if mark else None
            rows.append((run, name, batch, n, None if seen is None else int(seen["invalid"]), rate, at, dropped, state))
        frame = self.spark.createDataFrame(rows, self.DDL)
        frame.drop("run").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/run={int(run)}")

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.DDL).parquet(self.path)


def progress_frame(spark: SparkSession, queries) -> DataFrame:
    rows = [progress_row(p) for q in queries for p in q.recentProgress]
    return spark.createDataFrame(rows, PROGRESS_DDL)
