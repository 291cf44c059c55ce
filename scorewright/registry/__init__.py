"""Driver-facing registry: one Spark query per SURVEY §2 item and its DuckDB oracle.

``spark_queries.QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame``;
``oracle.ORACLES`` maps the same name to an independent SQL text over the
driver's parquet views.  Results are presented with numbers as DOUBLE and
dates as 'yyyy-MM-dd' text on both sides, so the cross-engine hash compares
values rather than engine-specific types.
"""
