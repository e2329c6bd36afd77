"""Sources: test tables, log source, and fixture derivations of the test tables."""

from ordertide.sources.tables import read_table, read_result
from ordertide.sources.fixtures import flat_orders, nested_orders, order_lines, raw_log
from ordertide.sources.log_source import log_source, log_source_options

__all__ = ["read_table", "read_result", "flat_orders", "raw_log", "nested_orders", "order_lines",
           "log_source", "log_source_options"]
