"""strata — Spark-native metrics engine for dated data drops.

Sub-packages:
  sources    readers and sinks (snapshot layout, CSV/Parquet/JSON, tables)
  functions  Column -> Column helpers (coercion, dates, strings, ratios)
  operators  DataFrame -> DataFrame operators (filters, joins, aggregates,
             windows, sets, history maintenance, data-quality suites)
  plans      parameterised metric families and the registered query catalog
  streaming  incremental landing-zone ingest (Structured Streaming)
"""

__version__ = "0.1.0"
