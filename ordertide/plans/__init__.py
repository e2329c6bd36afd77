"""Query catalogue: named end-to-end plans over the given tables."""

from ordertide.plans.catalogue import QUERIES, FLAGSHIP
from ordertide.plans.oracle import ORACLE_SQL

__all__ = ["QUERIES", "FLAGSHIP", "ORACLE_SQL"]
