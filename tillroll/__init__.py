"""tillroll: retail sales analytics as Spark DataFrame jobs.

Layers: CSV / test tables -> raw (append-only) -> staging (rebuilt) ->
star schema (dims + fact) -> marts, quality checks, statistics, exports.
Every operator takes DataFrames and returns a DataFrame; actions only
happen in sinks (writes) and in explicit size checks before a broadcast.
"""

__all__ = ["session", "schemas"]
