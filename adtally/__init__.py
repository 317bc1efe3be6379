"""adtally: programmatic ad-event analytics as Spark DataFrame jobs.

Layers (each a plain function DataFrame -> DataFrame):

* ``sources``    raw tables (fixture derivation over the driver's parquet), schemas, mart IO
* ``functions``  column expressions shared by every layer (portable rounding, guarded ratios, flags)
* ``operators``  reusable relational building blocks (latest-row dedup, top-k, data tests)
* ``plans``      the models: staging, marts, dashboard charts, profiling, data tests, anomalies
* ``streaming``  Structured Streaming variants of dedup / CTR alerting / load lag
"""

from adtally.session import get_spark, checkpoint_root

__all__ = ["get_spark", "checkpoint_root"]
