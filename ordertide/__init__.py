"""ordertide — store-operations order analytics on Spark.

Framed order events are landed unchanged in an audit (bronze) table and, in
parallel, decoded and rolled up into per-store event-time window metrics
(silver). Every transform is a plain ``DataFrame -> DataFrame`` function that
works on batch and streaming inputs alike; only ``sources`` and ``streaming``
know whether a plan is bounded.
"""

from ordertide.params import PipelineParams

__all__ = ["PipelineParams"]
