"""Column expressions (all built-in, JVM-side, codegen-friendly)."""

from ordertide.functions.framing import build_frame, frame_magic, frame_payload, frame_schema_id
from ordertide.functions.ordercols import (
    half_up_ratio, salt, strays, units, wait_seconds,
)
from ordertide.functions.timefns import parse_timestamp, session_zone, utc_instant, wall_clock

__all__ = [
    "build_frame", "frame_magic", "frame_payload", "frame_schema_id",
    "half_up_ratio", "salt", "wait_seconds", "units", "strays",
    "utc_instant", "wall_clock", "parse_timestamp", "session_zone",
]
