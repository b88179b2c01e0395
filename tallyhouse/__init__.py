"""tallyhouse: a retail sales warehouse built from Spark DataFrame and SQL operators.

Layers (each a module of pure ``DataFrame -> DataFrame`` functions):

* ``sources``    staging readers (CSV, driver parquet adapter) and period-partitioned tables
* ``functions``  column expressions (date parts, discount price, exact rounding, address parsing)
* ``operators``  keys, normalisation, exploration, quality checks, star schema, cumulative tables, SCD2
* ``plans``      the warehouse build, business questions and validated ingestion
* ``streaming``  the after-insert trigger as a Structured Streaming ``foreachBatch``
"""

__all__ = ["session", "schemas"]
