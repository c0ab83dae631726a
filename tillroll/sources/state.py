"""Change-gate state: ``{data_signature: {max_date, n_rows}, version, last_run_utc}``.

Stored as a one-row JSON dataset. A missing path means "first run"; a
file that exists but does not parse fails loudly (FAILFAST) instead of
silently restarting the version count.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.combine import side_by_side
from tillroll.schemas import STATE_SCHEMA


def read_state(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(STATE_SCHEMA).option("mode", "FAILFAST").json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], STATE_SCHEMA)
        raise


def change_gate(signature: DataFrame, state: DataFrame) -> DataFrame:
    """One row: the new signature, the stored version, whether the data
    changed, and the version the next publish gets (unchanged -> same)."""
    prev = state.agg(
        F.max(F.col("data_signature.max_date")).alias("prev_max_date"),
        F.max(F.col("data_signature.n_rows")).alias("prev_n_rows"),
        F.max(F.col("data_signature.net_revenue")).alias("prev_net_revenue"),
        F.max("version").alias("previous_version"),
        F.count(F.lit(1)).alias("_has_state"))
    with_rev = "net_revenue" in signature.columns
    sig = signature.select(F.col("max_date").cast("date").cast("string").alias("max_date"),
                           F.col("n_rows").cast("long").alias("n_rows"),
                           *([F.col("net_revenue").cast("string").alias("_net_revenue")] if with_rev else []))
    j = side_by_side(sig, prev)
    same = ((F.col("_has_state") > 0)
            & F.col("prev_max_date").eqNullSafe(F.col("max_date"))
            & F.col("prev_n_rows").eqNullSafe(F.col("n_rows")))
    if with_rev:
        same = same & F.col("prev_net_revenue").eqNullSafe(F.col("_net_revenue"))
    prev_v = F.coalesce(F.col("previous_version"), F.lit(0)).cast("long")
    return j.select(
        "max_date", "n_rows",
        *([F.col("_net_revenue").alias("net_revenue")] if with_rev else []),
        prev_v.alias("previous_version"),
        (~same).alias("changed"),
        F.when(same, prev_v).otherwise(prev_v + 1).alias("next_version"))


def write_state(gate: DataFrame, path: str) -> None:
    """Persist the gate row as the new state (one small JSON file)."""
    out = gate.select(
        F.struct(F.col("max_date"), F.col("n_rows"),
                 (F.col("net_revenue") if "net_revenue" in gate.columns
                  else F.lit(None).cast("string")).alias("net_revenue")).alias("data_signature"),
        F.col("next_version").alias("version"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("last_run_utc"))
    out.coalesce(1).write.mode("overwrite").json(path)
