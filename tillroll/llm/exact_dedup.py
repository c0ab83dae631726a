"""Exact deduplication by skew-safe combining.

Equal texts meet in three steps, each of which groups by the full text and
not by the digest alone: map-side partial aggregation merges copies inside a
task, then rows of one (digest, salt) are merged, then the salts' winners.
Only digests that hold more than ``hot_share`` of all rows are salted, so at
most ``1 / hot_share`` digests are, and the set of them can be broadcast.
Texts cross the network once; afterwards only ids and digests move.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1e-4
SALTS = 64


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                hot_share: float = HOT_SHARE, salts: int = SALTS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs``.

    The row with the largest id of equal texts stays. A null text counts as
    empty. A null id never wins against another id; in a group of null ids
    only, keep_id is null and the rows are kept. Rows that repeat id and text
    count in group_size and share the decision on their id. Other columns of
    ``docs``, whatever their names, are not read. An empty table gives no
    rows.
    """
    if not 0 < hot_share < 1:
        raise ValueError("hot_share must lie between 0 and 1")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.sha2(text, 256).alias("digest"))
    ids = rows.select("doc_id", "digest")
    least = max(1.0, docs.count() * hot_share)
    hot = F.broadcast(ids.groupBy("digest").count().where(F.col("count") > least)
                      .select("digest", F.lit(True).alias("hot")))

    def marked(df):
        return df.join(hot, "digest", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))

    salt = F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id"), F.lit(salts))).otherwise(F.lit(0))
    merged = (marked(rows).withColumn("salt", salt)
              .groupBy("digest", "hot", "salt", "text").agg(F.max("doc_id").alias("keep"), F.count("*").alias("n")))
    # a cold group is whole already: it goes on under its winner instead of its text
    winners = (merged.select("digest", "hot", "keep", "n", F.when(F.col("hot"), F.col("text")).alias("text"),
                             F.when(~F.col("hot"), F.struct("keep")).alias("whole"))
               .groupBy("digest", "hot", "text", "whole")
               .agg(F.max("keep").alias("keep_id"), F.sum("n").alias("group_size"))
               .groupBy("digest", "hot")
               .agg(F.first("keep_id").alias("keep_id"), F.first("group_size").alias("group_size"),
                    F.count("*").alias("texts"))
               # two texts under one digest would be a SHA-256 collision: fail, never merge them
               .withColumn("group_size", F.when(F.col("texts") == 1, F.col("group_size")).otherwise(
                   F.raise_error(F.concat(F.lit("different texts share the digest "), F.col("digest"))).cast("long"))))
    few = F.broadcast(winners.where("hot").select("digest", F.col("keep_id").alias("hot_id"),
                                                  F.col("group_size").alias("hot_size")))
    rest = winners.where(~F.col("hot")).select(F.col("digest").alias("key"), "keep_id", "group_size")
    # rows answered by the broadcast get a key of their own, so they don't meet in one task
    key = F.when(F.col("hot_size").isNull(), F.col("digest")).otherwise(
        F.concat(F.lit("-"), F.xxhash64("doc_id").cast("string")))
    found = ids.join(few, "digest", "left").withColumn("key", key).join(rest, "key", "left")
    keep = F.when(F.col("hot_size").isNull(), F.col("keep_id")).otherwise(F.col("hot_id"))
    return found.select("doc_id", keep.alias("keep_id"), F.coalesce("hot_size", "group_size").alias("group_size"),
                        F.col("doc_id").eqNullSafe(keep).alias("kept"),
                        F.col("digest").alias("text_sha256"))
