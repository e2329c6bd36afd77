"""Structured Streaming: sinks, triggers, fan-out, telemetry, table DDL."""

from ordertide.streaming.sinks import (
    bronze_stream, silver_stream, configure_trigger, start_writer, start_bronze_and_silver,
    silver_frame, await_all,
)
from ordertide.streaming.listener import ProgressLog, progress_frame

__all__ = ["bronze_stream", "silver_stream", "configure_trigger", "start_writer",
           "start_bronze_and_silver", "silver_frame", "await_all", "ProgressLog", "progress_frame"]
