"""Incremental raw sync: only unseen lines are appended.

A line is new when no raw line has the same
(invoice, stockcode, invoicedate, quantity, price, country). SQL equality
semantics: a NULL in any key never matches, so such lines count as new on
every run (``null_safe=True`` switches to null-safe equality). The batch is
not de-duplicated and description / customer_id are not compared.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.joins import checked_broadcast
from tillroll.schemas import RAW_COLUMNS, SYNC_KEYS

# above so many calendar months the month filter is a shuffle join (same rows)
MAX_BATCH_MONTHS = 100_000


def union_yearly(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL by column name of the yearly source files."""
    return reduce(lambda a, b: a.unionByName(b), frames).select(*RAW_COLUMNS)


def month_number(ts_col: str = "invoicedate") -> Column:
    """yyyyMM of a timestamp, 0 for NULL: a NULL date has a month of its own,
    so pruning by month never loses the lines that null-safe keys match."""
    return F.coalesce((F.year(ts_col) * 100 + F.month(ts_col)).cast("int"), F.lit(0))


def _any_key_null(keys: list[str]):
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def new_rows(incoming: DataFrame, existing: DataFrame, null_safe: bool = False,
             prune_by_month: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """Incoming lines whose six-column key is absent from ``existing``, with
    the source columns and those of ``carry``.

    Plan shape for scale:
    * lines with a NULL key cannot match under SQL equality; they bypass the
      join entirely (no shuffle, and no hot NULL partition);
    * both sides meet the left-anti join straight from their exchange: with
      nothing between the shuffle and the join's sort, AQE can split a hot
      key of the incoming side over several tasks (an aggregate there, such
      as a distinct of the existing keys, rules that out);
    * ``prune_by_month``: the existing side is restricted to the months that
      occur in the batch (a size-checked broadcast semi join on the month,
      which starts a job; the warehouse uses a partition filter instead).
      The key contains invoicedate, so the result is unchanged.
    """
    columns = [*RAW_COLUMNS, *carry]
    incoming = incoming.select(*columns)
    ex_keys = existing.select(*SYNC_KEYS)
    if prune_by_month:
        batch_months = incoming.select(month_number().alias("_m")).distinct()
        ex_keys = (ex_keys.withColumn("_m", month_number())
                   .join(checked_broadcast(batch_months, MAX_BATCH_MONTHS), "_m", "left_semi")
                   .drop("_m"))

    # The existing keys grow with raw and are never broadcast: Spark's static
    # estimate (compressed Parquet size of a few columns) can fall under the
    # broadcast threshold while the hash relation is large, so the anti join
    # is pinned to a shuffle (sort-merge) join.
    if null_safe:
        # existing keys renamed, so the condition is unambiguous even when
        # both sides come from the same table
        ex_keys = ex_keys.select(*[F.col(k).alias(f"_ex_{k}") for k in SYNC_KEYS]).hint("shuffle_merge")
        cond = reduce(lambda a, b: a & b,
                      [F.col(k).eqNullSafe(F.col(f"_ex_{k}")) for k in SYNC_KEYS])
        return incoming.join(ex_keys, cond, "left_anti").select(*columns)

    has_null = _any_key_null(SYNC_KEYS)
    ex_keys = ex_keys.where(~has_null).hint("shuffle_merge")
    keyed = incoming.where(~has_null).join(ex_keys, on=SYNC_KEYS, how="left_anti")
    return keyed.select(*columns).unionByName(incoming.where(has_null))
