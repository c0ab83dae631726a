"""Documents in blocks, and questions put to all blocks at once.

A block is a row with the texts of some thousand documents, so per-document
work runs on arrays. Blocks are stored once, bucketed by block number: what
other stages find out about a block is joined to it without moving its texts.

A question goes out as packed keys: each block sends each bucket one row with
all keys that fall into it. A bucket sees a key from every block that holds
it, once, and answers each block.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tillroll.llm.common import bounded_batches, utf8
from tillroll.session import scratch_root

BLOCK_BYTES, BLOCK_ROWS = 2 << 20, 4000
#: A block's number is its task's and a serial one; with the row it numbers every document in 63 bits.
SERIAL_BITS, ROW_BITS = 20, 12
#: A null id sorts after every other.
NULL_ID = np.iinfo(np.int64).max

SCHEMA = "block long, ids binary, sizes binary, text binary"


def build_blocks(docs: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
    """Blocks of ``docs``: ids and byte lengths as int64 arrays, texts end to end.

    Inside a block documents are in the order of their ids. A null text is
    empty. The table lies in the shared folder.
    """
    spark = docs.sparkSession
    bounded_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << SERIAL_BITS
        ids: list[int] = []
        texts: list[bytes] = []
        size = 0

        def flush():
            order = np.argsort(np.array(ids, np.int64), kind="stable")
            own = [texts[i] for i in order]
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([np.array(ids, np.int64)[order].tobytes()], pa.binary()),
                 pa.array([np.array([len(t) for t in own], np.int64).tobytes()], pa.binary()),
                 pa.array([b"".join(own)], pa.binary())], ["block", "ids", "sizes", "text"])

        for batch in batches:
            for i, text in zip(batch.column("id").to_pylist(), utf8(batch.column("text"))):
                ids.append(NULL_ID if i is None else i)
                texts.append(text)
                size += len(text)
                if size >= BLOCK_BYTES or len(ids) >= BLOCK_ROWS:
                    yield flush()
                    number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    key = f"{name}_{uuid.uuid4().hex[:12]}"
    (rows.mapInArrow(run, SCHEMA).write.format("parquet").option("compression", "zstd")
     .option("parquet.block.size", str(32 << 20)).option("path", f"{scratch_root(spark)}/{key}")
     .bucketBy(buckets_of(docs), "block").saveAsTable(key))
    return spark.table(key)


def buckets_of(df: DataFrame) -> int:
    """As many buckets as the session shuffles into: sized there for the input."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def arrays(ids: bytes, sizes: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int64), np.frombuffer(sizes, np.int64)


def split_by_bucket(key: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, list[slice]]:
    """Order that groups ``key`` by bucket (stable), the buckets met, and their slices."""
    bucket = ((key >> np.uint64(20)) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    met, first = np.unique(bucket[order], return_index=True)
    ends = [*first[1:].tolist(), len(key)]
    return order, met, [slice(a, b) for a, b in zip(first.tolist(), ends)]


def over_blocks(blocks: DataFrame, fn: Callable[[dict], list[tuple]], schema: str) -> DataFrame:
    """``fn`` maps a block (a dict of its columns) to rows of ``schema``."""
    spark = blocks.sparkSession
    bounded_batches(spark)
    kind = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                block = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                rows = fn(block)
                for at in range(0, len(rows), 2000):
                    part = rows[at:at + 2000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), f.type) for c, f in zip(zip(*part), kind)], kind.names)

    return blocks.mapInArrow(run, schema)


def ask(questions: DataFrame, fn: Callable[[pd.DataFrame], list[tuple]], schema: str) -> DataFrame:
    """``fn`` answers the questions of one bucket (all its rows, in the order of the blocks)."""
    names = [x.split()[0] for x in schema.split(",")]

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = fn(rows.sort_values("block", kind="stable"))
        return pd.DataFrame(out, columns=names)

    return questions.groupBy("bucket").applyInPandas(run, schema)


def with_answers(blocks: DataFrame, answers: DataFrame, name: str = "answers") -> DataFrame:
    """The blocks and, as a list, their answers; the texts stay where they are."""
    columns = [c for c in answers.columns if c != "block"]
    grouped = answers.groupBy("block").agg(F.collect_list(F.struct(*columns)).alias(name))
    return blocks.join(grouped.hint("shuffle_hash"), "block", "left")
