"""bankspark: banking and market analytics as Spark DataFrame operators.

Sub-packages:
  sources    table scans, role views over the driver tables, text scans, sinks
  functions  Column -> Column scalar functions (keys, buckets, lenient parsing, exact rounding)
  operators  reusable distributed operators (ranks, long-series windows, allocation, stats, models)
  plans      the jobs themselves: daily funding summary, monthly report, scorecard, market features
  streaming  incremental driver for the daily funding job
  queries    registry of named queries with their DuckDB oracle text
"""

__all__ = ["session"]
