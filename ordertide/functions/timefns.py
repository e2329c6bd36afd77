"""Event-time helpers.

Inside the library every event time is a ``TIMESTAMP`` instant (watermarks
require it). Naive wall-clock inputs (``TIMESTAMP_NTZ``, as in the test tables)
are read as UTC, and results go back out as UTC wall clock ``TIMESTAMP_NTZ``,
whatever the session time zone is.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def session_zone(spark: SparkSession | None = None) -> str:
    """The session time zone of ``spark`` (else of the active / only session)."""
    spark = spark or SparkSession.getActiveSession() or SparkSession._instantiatedSession
    return spark.conf.get("spark.sql.session.timeZone") if spark else "UTC"


def _is_utc(zone: str) -> bool:
    return zone.upper() in ("UTC", "Z", "GMT", "+00:00", "ETC/UTC")


def utc_instant(col: Column | str, source_type: T.DataType | None = None,
                zone: str | None = None) -> Column:
    """Wall-clock ``TIMESTAMP_NTZ`` read as UTC -> ``TIMESTAMP`` instant.

    ``zone`` is the session time zone of the plan (default: the active session's).
    """
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(source_type, T.TimestampType):
        return c
    zone = zone or session_zone()
    if _is_utc(zone):
        return c.cast("timestamp")
    # built from its fields in UTC: a cast would read it in the session zone, which skips or repeats hours
    return F.make_timestamp(F.year(c), F.month(c), F.day(c), F.hour(c), F.minute(c),
                            F.extract(F.lit("SECOND"), c), F.lit("UTC"))


def wall_clock(col: Column | str, zone: str | None = None) -> Column:
    """``TIMESTAMP`` instant -> UTC wall clock as ``TIMESTAMP_NTZ``."""
    c = F.col(col) if isinstance(col, str) else col
    zone = zone or session_zone()
    if _is_utc(zone):
        return c.cast("timestamp_ntz")
    # counted from the epoch: rendering in the session zone would skip or repeat hours
    since = F.make_dt_interval(secs=(F.unix_micros(c) / 1000000).cast("decimal(18,6)"))
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since


def parse_timestamp(col: Column | str) -> Column:
    """ISO-8601 text -> ``TIMESTAMP``; malformed text -> null (never raises)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast("timestamp")
