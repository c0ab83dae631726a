"""Token counts of documents in flat, unindexed token files.

A token file is the ids of many documents end to end, each closed by an
end-of-document id, with no index of where documents lie. Files are read in
blocks, each by whichever task gets it; a block's search for the id is one
vector comparison. A document that crosses blocks is stitched by a prefix
scan over the blocks' summaries: how many documents ended before the block and
how many tokens were left open.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.common import bounded_batches, land, utf8
from tillroll.llm.tokens import word_tokens
from tillroll.session import scratch_root

BLOCK_BYTES = 4 << 20


def open_store(path: str):
    """File system and path of a shared folder's path as Spark names it. HDFS needs libhdfs on every machine."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    scheme, colon, rest = path.partition("://")
    if colon and scheme in ("s3a", "s3n"):
        path = f"s3://{rest}"
    elif colon and scheme not in ("s3", "gs", "hdfs", "viewfs", "abfs", "abfss"):
        raise ValueError(f"token files can't be kept on {scheme}://; set spark.checkpoint.dir to a folder on "
                         "a shared disk, S3, Google or Azure storage or HDFS")
    return pyarrow.fs.FileSystem.from_uri(path)


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int, folder: str, dtype: str = "<u2",
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One token file per task in ``folder``; returns file, ordinal, doc_id of the documents written.

    A null or empty text is written as its end alone. Texts that spell a
    special token are ordinary text. Files of attempts that failed aren't in
    the result.
    """
    bounded_batches(docs.sparkSession)
    if end_id > np.iinfo(dtype).max:
        raise ValueError(f"{end_id} doesn't fit {dtype}")
    store, root = open_store(folder)
    store.create_dir(root, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_tokens(tokenizer, special=False)
        end = np.array([end_id], dtype)
        store, root = open_store(folder)
        task = TaskContext.get()
        name = f"tokens-{task.partitionId():06d}-{task.taskAttemptId()}.bin"
        ordinal, out = 0, None
        for batch in batches:
            if out is None and batch.num_rows:
                out = store.open_output_stream(f"{root}/{name}")
            texts = utf8(batch.column("text"))
            for ids in encoder.encode(texts):
                out.write(np.concatenate([ids.astype(dtype), end]).tobytes())
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * n, pa.string()), pa.array(range(ordinal, ordinal + n), pa.int64()), batch.column("doc_id")],
                ["file", "ordinal", "doc_id"])
            ordinal += n
        if out is not None:
            out.close()

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return land(rows.mapInArrow(run, f"file string, ordinal long, doc_id {id_type}"), "token-manifest")


def count_tokens(spark: SparkSession, folder: str, end_id: int, dtype: str = "<u2",
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """path, ordinal, start, n_tokens (without the end), closed per document of the files in ``folder``.

    Tokens after a file's last end are a document of their own that isn't
    closed. Empty documents count; an empty folder gives no rows, and bytes
    that make no whole token at a file's end are an error.
    """
    bounded_batches(spark)
    width = np.dtype(dtype).itemsize
    per = max(1, block_bytes // width)
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
             .select("path", "length").where("length > 0"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, block, length in zip(*(batch.column(c).to_pylist() for c in ("path", "block", "length"))):
                if length % width:
                    raise ValueError(f"{path} holds no whole number of tokens")
                store, name = open_store(path)
                with store.open_input_file(name) as f:
                    ids = np.frombuffer(f.read_at(min(per * width, length - block * per * width), block * per * width), dtype)
                ends = np.flatnonzero(ids == end_id)
                tail = len(ids) - 1 - int(ends[-1]) if len(ends) else len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path]), pa.array([block], pa.int64()), pa.array([tail], pa.int64()),
                     pa.array([ends.astype(np.int64)], pa.list_(pa.int64()))], ["path", "block", "tail", "ends"])

    blocks = files.select("path", "length", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("length") / width - 1) / per).cast("long"))).alias("block"))
    found = blocks.repartition(F.col("path"), F.col("block")).mapInArrow(
        search, "path string, block long, tail long, ends array<long>")
    # prefix scan over a file's blocks: documents ended so far, tokens open at the block's start; it sees two
    # numbers of each block, and the blocks' contents stay where they were written
    found = land(found, "token-blocks")
    by = Window.partitionBy("path").orderBy("block")
    scan = (found.select("path", "block", "tail", F.size("ends").alias("n"))
            .withColumn("base", F.coalesce(F.sum("n").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("part", F.sum((F.col("n") > 0).cast("int")).over(by.rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("open_end", F.sum("tail").over(
                Window.partitionBy("path", "part").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("open", F.coalesce(F.lag("open_end").over(by), F.lit(0)))
            .withColumn("last", F.lead("block").over(by).isNull()))
    scan = found.select("path", "block", "ends").join(scan.hint("shuffle_merge"), ["path", "block"])
    first = F.col("block") * per
    begin = F.transform("ends", lambda e, i: F.when(i == 0, first - F.col("open")).otherwise(
        first + F.get(F.col("ends"), i - 1) + 1))
    whole = F.transform(F.arrays_zip(F.col("ends").alias("end"), begin.alias("begin")), lambda x, i: F.struct(
        (F.col("base") + i).alias("ordinal"), x["begin"].alias("start"),
        (first + x["end"] - x["begin"]).alias("n_tokens"), F.lit(True).alias("closed")))
    rest = F.when(F.col("last") & (F.col("open_end") > 0), F.array(F.struct(
        (F.col("base") + F.col("n")).alias("ordinal"),
        (F.when(F.col("n") > 0, first + F.element_at("ends", -1) + 1).otherwise(first - F.col("open"))).alias("start"),
        F.col("open_end").alias("n_tokens"), F.lit(False).alias("closed"))))
    doc = F.concat(whole, F.coalesce(rest, F.array().cast(
        "array<struct<ordinal:bigint,start:bigint,n_tokens:bigint,closed:boolean>>")))
    return scan.select("path", F.explode(doc).alias("doc")).select("path", "doc.*")


def token_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/token-files-{uuid.uuid4().hex[:12]}"
