"""Helpers shared by the operators: reading, landing, batch sizes."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import scratch_root

#: One Arrow batch holds at most so many rows and bytes, so a worker's memory
#: doesn't grow with the split or with very long texts.
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage
    and outlives executors."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``fn`` over the Arrow batches of ``df``, one at a time."""
    bounded_batches(df.sparkSession)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    return df.mapInArrow(run, schema)


def utf8(column: pa.Array) -> list[bytes]:
    """The column's texts as UTF-8 bytes, null as empty."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    return [x or b"" for x in column.to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixer (splitmix64's finaliser) over a uint64 array."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def digests(parts: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of BLAKE2b for each byte string, as two uint64 arrays."""
    both = np.frombuffer(b"".join([blake2b(p, digest_size=16).digest() for p in parts]), np.uint64).reshape(-1, 2)
    return both[:, 0].copy(), both[:, 1].copy()


def word_names(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits of BLAKE2b for each word text[start:end]; words don't overlap. Each distinct one is hashed once."""
    edge = np.zeros(len(text) + 1, np.int8)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    inside = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(text[inside].tobytes())])
    found = words.dictionary_encode()
    names = b"".join([blake2b(w, digest_size=8).digest() for w in found.dictionary.to_pylist()])
    return np.frombuffer(names, np.uint64)[found.indices.to_numpy()] if len(starts) else np.zeros(0, np.uint64)


def window_prints(values: np.ndarray, width: int, key: np.uint64) -> np.ndarray:
    """Fingerprints of every ``width`` neighbouring values, by pairing neighbours: of 1, 2, 4, ... values, mixed at
    every step, so they have no structure that a sequence could follow."""
    odd, turn = np.uint64(0x9E3779B97F4A7C15), np.uint64(29)
    table, size = mix64(values ^ key), 1
    out, have = None, 0
    while True:
        if width & size:
            own = table[have:]
            if out is None:
                out = own
            else:
                n = min(len(out), len(own))
                out = mix64(out[:n] * odd + (own[:n] ^ (own[:n] >> turn)) + np.uint64(width))
            have += size
        if 2 * size > width or len(table) <= size:
            break
        left, right = table[:-size], table[size:]
        table = mix64(left * odd + (right ^ (right >> turn)) + np.uint64(size))
        size *= 2
    n = max(0, len(values) - width + 1)
    return out[:n] if out is not None and have == width else np.zeros(0, np.uint64)


def held_out(doc_id: str) -> F.Column:
    """Rows that no label may be learned from: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def worker_state(key: tuple, make: Callable):
    """An object that lives as long as its Python worker, so later tasks find it filled."""
    import sys
    import types

    state = sys.modules.setdefault("_tillroll_worker", types.ModuleType("_tillroll_worker")).__dict__
    if key not in state:
        state[key] = make()
    return state[key]
