"""hydrix: measurement-compliance analytics as Spark DataFrame operators.

Layout
------
functions/   Column -> Column expressions (dates, lab-result parser, keyword families, ratios)
operators/   DataFrame -> DataFrame transforms (cleaning, dedup, metrics, profiling, checks)
sources/     readers and writers (JSON Lines, Parquet, paged envelopes, previews)
plans/       compositions: silver, gold, quality gates, raw profile, end-to-end runs
streaming/   incremental ingest of landed page files with Structured Streaming
bindings/    the registered queries over the driver's test tables and their DuckDB oracle SQL
session.py   shared scratch folder (spark.checkpoint.dir), staging, cluster sizing, local sessions

Every operator is lazy: it returns a DataFrame (or Column) and leaves planning to Catalyst.
Outside the optional ``llm`` part no operator calls ``toPandas`` or a Python UDF; collected are check results
(one row per check), observed counts and the partition values that a batch touches.
"""

__version__ = "0.1.0"
