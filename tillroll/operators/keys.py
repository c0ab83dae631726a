"""Surrogate keys without a single-task window.

``dense_number`` assigns 1..N in sort order, distributed:

1. range-partition the rows on the sort key (each partition holds a
   contiguous key range, partitions are ordered);
2. sort inside each partition and number the rows from their position;
3. count rows per partition: one row per partition, so the running offset
   over partitions touches only as many rows as there are partitions;
4. add each partition's offset (broadcast; size = number of partitions).

The numbered intermediate is checkpointed to the shared checkpoint folder
so partition ids and local numbers are computed once and stay stable when
the two branches read them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.operators.joins import checked_broadcast
from tillroll.session import ensure_checkpoint_dir

MAX_PARTITIONS = 1_000_000


def dense_number(df: DataFrame, order_col: str, id_col: str, num_partitions: int | None = None) -> DataFrame:
    """Rows of ``df`` (distinct on ``order_col``) with ``id_col`` = 1..N in
    ascending ``order_col`` order (NULLs not expected)."""
    ensure_checkpoint_dir(df.sparkSession)
    ranged = (df.repartitionByRange(num_partitions, order_col) if num_partitions
              else df.repartitionByRange(order_col)).sortWithinPartitions(order_col)
    # monotonically_increasing_id = (partition index << 33) + position in the
    # partition, so after the local sort the position is the row number
    # inside the partition: no window, no second shuffle
    local = (ranged.select("*", F.spark_partition_id().alias("_part"),
                           F.monotonically_increasing_id().alias("_mid"))
             .withColumn("_local", F.col("_mid") - F.shiftleft(F.col("_part").cast("long"), 33) + 1)
             .drop("_mid")
             .checkpoint(eager=True))
    sizes = local.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_n").over(Window.orderBy("_part")
                                    .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    # one row per partition: checked like every broadcast (count is cheap,
    # the numbered rows are already checkpointed)
    return (local.join(checked_broadcast(offsets, MAX_PARTITIONS, materialize=False), "_part")
            .select((F.col("_local") + F.col("_off")).cast("long").alias(id_col),
                    *[c for c in df.columns]))


def row_numbers(landed: DataFrame, id_col: str, first: int) -> DataFrame:
    """``landed``, a DataFrame read straight from Parquet files (with a filter
    or none), with ``id_col`` = first, first + 1, ...: files in order of their
    names, rows in the order they have in them. A filter leaves the numbers of
    the lines it drops unused, up to the file's last line that it keeps.

    The number follows from the file and the row's place in it alone, so a task
    that runs again, or a stage after a lost executor, gives the same ones. The
    running offsets are one row for each file, broadcast behind a size check.
    """
    return place_rows(landed, file_offsets(landed), id_col, first)


def file_offsets(landed: DataFrame) -> DataFrame:
    """For each file of ``landed``: its name, the numbers it takes (``_n``) and those before it (``_off``)."""
    files = (landed.select(F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
             .groupBy("_file").agg((F.max("_row") + 1).alias("_n")))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    return checked_broadcast(files.select("_file", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")),
                             MAX_PARTITIONS)


def place_rows(landed: DataFrame, offsets: DataFrame, id_col: str, first: int) -> DataFrame:
    """``row_numbers`` by offsets made before."""
    placed = landed.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return (placed.join(offsets.drop("_n"), "_file")
            .select((F.lit(first) + F.col("_off") + F.col("_row")).cast("long").alias(id_col), *landed.columns))


def slices(counts: DataFrame, key: str, number: int) -> DataFrame:
    """``key``, ``_first`` and ``_slices``: which of ``number`` equal slices
    (from 0), in order of the key, hold a key's rows.

    ``counts`` has a row for each key with the number ``n`` of its rows; the
    keys must be few (calendar days). A key with more rows than a slice has
    several for itself, and small neighbours share one.
    """
    upto = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    reached = F.sum("n").over(upto)
    placed = counts.select(key, (reached - F.col("n")).alias("_before"), (reached - 1).alias("_last"), F.sum("n").over(whole).alias("_all"))
    first, last = (F.floor(F.col(c) * F.lit(float(number)) / F.col("_all")) for c in ("_before", "_last"))
    return placed.select(key, first.alias("_first"), (F.least(last, F.lit(number - 1)) - first + 1).alias("_slices"))
