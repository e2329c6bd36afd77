"""Wire frame of a log record: byte 0 magic (0x00), bytes 1-4 big-endian
schema id, then the encoded body. All built-in binary expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEADER_BYTES = 5


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def frame_payload(value: Column | str) -> Column:
    """Body bytes: everything after the 5-byte header."""
    v = _c(value)
    return F.substring(v, F.lit(HEADER_BYTES + 1), F.length(v) - HEADER_BYTES)


def frame_magic(value: Column | str) -> Column:
    """Magic byte as two hex digits."""
    return F.hex(F.substring(_c(value), 1, 1))


def frame_schema_id(value: Column | str) -> Column:
    """4-byte big-endian schema id as BIGINT (ids are unsigned); null for frames shorter than 5 bytes."""
    v = _c(value)
    return F.when(F.length(v) >= HEADER_BYTES,
                  F.conv(F.hex(F.substring(v, 2, 4)), 16, 10).cast("bigint"))


def build_frame(schema_id: Column | int, body: Column) -> Column:
    """Inverse of the three readers above (D7): magic + id + body bytes."""
    sid = F.lit(schema_id) if isinstance(schema_id, int) else schema_id
    header = F.unhex(F.concat(F.lit("00"), F.lpad(F.hex(sid.cast("long")), 8, "0")))
    return F.concat(header, body.cast("binary"))
