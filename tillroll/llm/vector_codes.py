"""Vector compression to short codes by ball k-means.

A vector is cut into equal consecutive parts; every part position has a
codebook, and a vector's code names the nearest entry of each. Entries move to
the mean of their parts for a few rounds.

Each assignment starts from the one before (the first: all parts at entry 0).
The parts at an entry form its ball. An entry further away than twice the
ball's radius can't be nearest for any part of it, so only nearer ones are
neighbours; a part closer to its entry than half the way to the nearest
neighbour lies in the stable core and is left alone; the others lie in rings
that say how many neighbours, nearest first, have to be looked at. Everything
is integer arithmetic, so skipped entries are skipped exactly, ties included.

Vectors stay in their tasks. Codebooks (parts * entries * width integers) and
their sums are all that passes through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import bounded_batches, land

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Totals of at most so many labels are broadcast; beyond it they are joined by (label, salt).
BROADCAST_LABELS, SALTS = 100_000, 32
#: Parts handled at once, which bounds a worker's memory.
CHUNK = 1 << 17


def usable(vector_col: str) -> F.Column:
    """Neither the vector nor a component is null, NaN or infinite."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                      & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(F.col(vector_col).isNotNull() & finite, F.lit(False))


def largest(dimensions: int) -> int:
    """Components saturate here, so that squared distances fit 64 bits."""
    return min(isqrt(2**61 // max(1, dimensions)) // 2, 2**30)


class Codebooks:
    """All entries, in order of part and entry, with what the pruning needs."""

    def __init__(self, entries: np.ndarray):
        self.parts, self.size, self.width = entries.shape
        self.entries = entries.reshape(-1, self.width)
        between = ((entries[:, :, None, :] - entries[:, None, :, :]) ** 2).sum(-1)
        # nearest first, of equally near ones the lower index; the entry itself isn't its own neighbour
        own = np.arange(self.size)
        between[:, own, own] = -1
        order = np.argsort(between, axis=2, kind="stable")[:, :, 1:]
        self.neighbour = (order + (np.arange(self.parts) * self.size)[:, None, None]).reshape(len(self.entries), -1)
        self.apart = np.take_along_axis(between, order, 2).reshape(len(self.entries), -1)

    def rings(self, at: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """How many neighbours of its entry a part at that distance must be compared with: 0 in the stable core."""
        count = np.zeros(len(at), np.int64)
        radius = np.full(len(self.entries), -1)
        np.maximum.at(radius, at, distance)
        # neighbours of each ball: entries at most two radii away
        near = (self.apart <= 4 * radius[:, None]).sum(1)
        for k in range(int(near.max(initial=0))):
            inside = np.flatnonzero(count == k)
            inside = inside[near[at[inside]] > k]
            count[inside[self.apart[at[inside], k] <= 4 * distance[inside]]] += 1
        return count

    def assign(self, points: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of each point (lower index of equally near ones) and its squared distance."""
        best, distance = at.copy(), ((points - self.entries[at]) ** 2).sum(1)
        count = self.rings(at, distance)
        order = np.argsort(-count, kind="stable")
        still = np.searchsorted(-count[order], -np.arange(1, count.max(initial=0) + 1), side="right")
        for k, n in enumerate(still.tolist()):
            who = order[:n]
            other = self.neighbour[at[who], k]
            d = ((points[who] - self.entries[other]) ** 2).sum(1)
            closer = (d < distance[who]) | ((d == distance[who]) & (other < best[who]))
            best[who[closer]], distance[who[closer]] = other[closer], d[closer]
        return best, distance

    def codes(self, vectors: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of ``vectors`` (rows of integers), from earlier ones, and their errors."""
        base = np.arange(self.parts) * self.size
        out, error = np.empty_like(codes), np.empty(len(codes), np.int64)
        step = max(1, CHUNK // self.parts)
        for a in range(0, len(codes), step):
            points = vectors[a:a + step].astype(np.int64).reshape(-1, self.width)
            best, distance = self.assign(points, (codes[a:a + step] + base).ravel())
            out[a:a + step] = best.reshape(-1, self.parts) - base
            error[a:a + step] = distance.reshape(-1, self.parts).sum(1)
        return out, error

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _rows(column: pa.Array, dtype, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(-1, width)


def _packed(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _assigned(coded: DataFrame, books: Codebooks, name: str) -> DataFrame:
    """``coded`` (id, label, vector, code) with codes by ``books`` and their errors, written."""
    bounded_batches(coded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = _rows(batch.column("vector"), np.int32, books.parts * books.width)
                codes, error = books.codes(vectors, _rows(batch.column("code"), np.uint8, books.parts).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("label"), batch.column("vector"),
                     _packed(codes.astype(np.uint8)), pa.array(error)], ["id", "label", "vector", "code", "error"])

    label = coded.schema["label"].dataType.simpleString()
    kind = coded.schema["id"].dataType.simpleString()
    return land(coded.mapInArrow(run, f"id {kind}, label {label}, vector binary, code binary, error long"), name)


def _moved(coded: DataFrame, books: Codebooks) -> Codebooks:
    """Entries at the floor of their parts' mean; those without parts stay."""
    bounded_batches(coded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(books.entries), np.int64)
        sums = np.zeros(books.entries.shape, np.int64)
        base = np.arange(books.parts) * books.size
        for batch in batches:
            if batch.num_rows:
                points = _rows(batch.column("vector"), np.int32, books.parts * books.width).reshape(-1, books.width)
                at = (_rows(batch.column("code"), np.uint8, books.parts) + base).ravel()
                n += np.bincount(at, minlength=len(n))
                for k in range(books.width):  # exact: a batch's sums are far below 2^53
                    sums[:, k] += np.bincount(at, points[:, k], len(n)).astype(np.int64)
        met = np.flatnonzero(n)
        place = np.repeat(met, books.width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(place), pa.array(np.tile(np.arange(books.width), len(met))), pa.array(n[place]), pa.array(sums[met].ravel())],
            ["entry", "k", "n", "s"])

    parts = coded.select("vector", "code").mapInArrow(run, "entry long, k long, n long, s long")
    moved = books.entries.copy()
    for r in parts.groupBy("entry", "k").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect():
        moved[r["entry"], r["k"]] = r["s"] // r["n"]
    return Codebooks(moved.reshape(books.parts, books.size, books.width))


def encode(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
           parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Codebooks | None]:
    """(id, label, code as bytes, error) of every usable vector, and the codebooks (None if there is no such vector).

    A component x counts as floor(scale * x), and saturates at ``largest`` of
    the dimensions. Vectors that are null, or hold null, NaN or infinite
    components, are dropped. Codebooks start as the parts of the vectors with
    the smallest ids, a null id after all others, rows of one id in order of
    their integers; with fewer vectors than entries the codebooks are smaller.
    Their number of dimensions is that of the first vector whose length is a
    multiple of ``parts`` (not 0); vectors of another length stay, with null
    code and error. Repeated rows are coded each. Other columns, whatever
    their names, aren't read. An empty table gives no rows.
    """
    if not (parts >= 1 and 1 <= entries <= 256 and rounds >= 0):
        raise ValueError("parts and entries must be positive, entries at most 256")
    spark = vectors.sparkSession
    rows = (vectors.where(usable(vector_col))
            .select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                    F.transform(vector_col, lambda x: F.floor(x.cast("double") * F.lit(float(scale)))).alias("v")))
    fits = (F.size("v") > 0) & (F.size("v") % parts == 0)
    first = rows.where(fits).orderBy(F.col("id").asc_nulls_last(), "v").select("v").limit(1).collect()
    label, kind = (rows.schema[c].dataType.simpleString() for c in ("label", "id"))
    if not first:
        return rows.select("id", "label", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error")), None
    d = len(first[0]["v"])
    most = largest(d)
    whole = rows.where(F.size("v") == d).withColumn(
        "v", F.transform("v", lambda x: F.greatest(F.least(x, F.lit(most)), F.lit(-most)).cast("int")))
    seeds = whole.orderBy(F.col("id").asc_nulls_last(), "v").select("v").limit(entries).collect()
    start = np.array([r["v"] for r in seeds], np.int64).reshape(len(seeds), parts, d // parts)
    books = Codebooks(start.transpose(1, 0, 2).copy())

    bounded_batches(spark)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zero = bytes(parts)
        for batch in batches:
            if batch.num_rows:
                v = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int32).reshape(-1, d)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("label"), _packed(v), pa.array([zero] * len(v), pa.binary())],
                    ["id", "label", "vector", "code"])

    coded = _assigned(whole.mapInArrow(pack, f"id {kind}, label {label}, vector binary, code binary"), books, "vector-codes")
    for _ in range(rounds):
        books = _moved(coded, books)
        coded = _assigned(coded.drop("error"), books, "vector-codes")
    odd = rows.where(F.size("v") != d).select("id", "label", F.lit(None).cast("binary").alias("code"),
                                              F.lit(None).cast("long").alias("error"))
    return coded.select("id", "label", "code", "error").unionByName(odd), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` and label_error, the sum of the errors of its label (null is a label too).

    A label may hold any share of the rows: sums are combined before the
    shuffle, and rows find their label's total in a broadcast of at most
    ``BROADCAST_LABELS`` rows or, beyond, under one of ``SALTS`` salts.
    """
    totals = land(coded.groupBy("label").agg(F.sum("error").alias("label_error"))
                  .withColumnRenamed("label", "of"), "label-errors")
    if totals.count() <= BROADCAST_LABELS:
        return coded.join(F.broadcast(totals), F.col("label").eqNullSafe(F.col("of")), "left").drop("of")
    salted = totals.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = coded.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    return rows.join(salted.hint("shuffle_merge"), F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("part")),
                     "left").drop("of", "salt", "part")
