"""The training-corpus pipeline: five stages from ``documents`` to packed sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept. All but the last return the columns of ``docs``; between stages the
rows are written as Parquet and read again, so a stage never runs twice.

Rows that share a doc_id and a text go through every stage together; a null
doc_id is an id of its own. Empty tables pass through as empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import decontaminate, exact_dedup, near_dedup, packing, quality
from tillroll.llm.common import held_out, land, table
from tillroll.llm.queries import tokenizer_file


def _carried(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` from the ones an operator carried along."""
    return df.select(*[F.col(f"_keep{i}").alias(c) for i, c in enumerate(docs.columns)])


def _same() -> Column:
    """A document's id and text are those kept under _id and _sha."""
    text = F.sha2(F.coalesce("text", F.lit("")), 256)
    return (text == F.col("_sha")) & F.col("doc_id").eqNullSafe(F.col("_id"))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score 0.3 or more)."""
    weights = quality.fit(docs, table(spark, sf_dir, "labels").where(~held_out("doc_id")))
    scored = quality.score(docs, weights, threshold=0.3, keep=tuple(docs.columns))
    return _carried(scored.where("predicted = 1"), docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the largest doc_id) of each text."""
    kept = exact_dedup.exact_dedup(docs).where("kept").select(
        F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).distinct()
    return docs.join(kept, _same(), "left_semi")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id, of its texts the one with the smallest digest) of each group of near duplicates."""
    kept = near_dedup.representatives(docs).select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    return docs.join(kept, _same(), "left_semi")


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), keep=tuple(docs.columns))
    return _carried(found.where(F.size("hits") == 0), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in sequences of 4096 tokens."""
    return packing.pack(packing.tokenize_pieces(docs, tokenizer_file()))


STAGES = [
    ("quality classifier", quality_filter),
    ("exact dedup", exact_copies),
    ("near dedup", near_copies),
    ("benchmark decontamination", benchmark_free),
    ("best-fit packing", packed),
]

#: A classifier's training, band joins and the tokenizer can't be written in SQL: tests/llm/test_corpus_pipeline.py
#: holds run() against plain versions of the stages after the classifier, and checks the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
