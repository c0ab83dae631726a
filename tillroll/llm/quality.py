"""Quality classifier: hashed word n-gram logistic regression, trained with
follow-the-regularised-leader (FTRL-proximal) updates.

A text is split into runs of letters and digits, of other signs, and line
ends. Each token is read twice: as itself and as its class (letter case,
length, digits, sign run, repeat of the token before it), so n-grams of
classes carry over to words never seen. A document's features are the hashed
n-grams' relative frequencies; its score is a sparse dot product through the
logistic function.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import bounded_batches, map_batches, mix64, utf8

BITS = 18
#: The classifier is fitted on at most so many labelled rows (those with the smallest hash of doc_id).
MAX_TRAIN_ROWS = 6000
EPOCHS, ALPHA, BETA, L1, L2, SCALE = 4, 0.5, 1.0, 1e-4, 1e-5, 40.0
#: Tokens are handled in pieces of at most so many, so a very long text needs no more memory than others.
PIECE = 1 << 18
#: The longest n-gram less one, and how far back a token's class looks.
OVERLAP = 3 + 2

TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|\n|[^0-9A-Za-z\x80-\xff\s]+")


def token_class(token: bytes) -> int:
    """A small code for how a token looks."""
    first = token[:1]
    if token == b"\n":
        return 1
    if not (first.isalnum() or first >= b"\x80"):
        return 2 + (zlib.crc32(token) & 0xFFFF)  # sign runs stand for themselves
    text = token.decode("utf-8", "replace")
    kind = (0 if text.isdigit() else 1 if text.islower() else 2 if text.istitle() else 3 if text.isupper() else 4)
    return (1 << 17) + kind * 8 + min(7, len(text) // 3)


class Codes:
    """Hashes of token strings; forgets when it has grown large."""

    def __init__(self, most: int = 400_000):
        self.most, self.known = most, {}

    def __call__(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > self.most:
            self.known.clear()
        known = self.known
        for t in set(tokens).difference(known):
            known[t] = (zlib.crc32(t) | token_class(t) << 32)
        both = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
        return both & np.uint64(0xFFFFFFFF), both >> np.uint64(32)


def ngram_hashes(tokens: list[bytes], codes: Codes, bits: int, known: int = 0) -> np.ndarray:
    """Feature numbers of a token sequence's n-grams: words 1-2, classes 1-4.

    Those that lie within the first ``known`` tokens are left out."""
    word, kind = codes(tokens)
    kind = kind.copy()
    if len(word) > 1:
        kind[1:][word[1:] == word[:-1]] += np.uint64(1 << 20)  # repeats
    if len(word) > 2:
        kind[2:][word[2:] == word[:-2]] += np.uint64(1 << 21)
    out = []
    for seq, tag, most in ((word, 1, 2), (kind, 2, 4)):
        h = np.full(len(seq), tag, np.uint64)
        for n in range(1, min(most, len(seq)) + 1):
            h = mix64(h[:len(seq) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + seq[n - 1:])
            out.append(h[max(0, known - n + 1):] >> np.uint64(64 - bits))
    return np.concatenate(out).astype(np.int32) if out else np.zeros(0, np.int32)


def pieces(text: bytes) -> Iterator[tuple[list[bytes], int]]:
    """The text's tokens, in pieces of bounded length. Each begins with tokens of the one before, as many as said:
    enough for the n-grams across the cut."""
    if len(text) <= 8 * PIECE:
        yield TOKEN.findall(text), 0
        return
    part, known = [], 0
    for m in TOKEN.finditer(text):
        part.append(m[0])
        if len(part) == PIECE:
            yield part, known
            part, known = part[-OVERLAP:], OVERLAP
    if len(part) > known:
        yield part, known


def features(text: bytes, codes: Codes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers and their relative frequencies, scaled."""
    index, count = np.zeros(0, np.int32), np.zeros(0)
    for part, known in pieces(text):
        own, n = np.unique(ngram_hashes(part, codes, bits, known), return_counts=True)
        both = np.concatenate([index, own])
        index, where = np.unique(both, return_inverse=True)
        count = np.bincount(where, weights=np.concatenate([count, n]), minlength=len(index))
    return index, (count * (SCALE / count.sum()) if len(count) else count).astype(np.float32)


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, float]], bits: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights after FTRL-proximal passes over (index, value, label) examples; the last one is the bias."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(z, n):
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    order = np.random.default_rng(7)
    bias = np.array([1 << bits], np.int32)
    for _ in range(epochs):
        for k in order.permutation(len(examples)):
            index, value, label = examples[k]
            index, value = np.concatenate([index, bias]), np.append(value, np.float32(1))
            zi, ni = z[index], n[index]
            w = weights(zi, ni)
            p = 1 / (1 + np.exp(-np.clip(w @ value, -35, 35)))
            g = (p - label) * value
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
            z[index] += g - sigma * w
            n[index] += g * g
    return weights(z, n).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
        text_col: str = "text", max_rows: int = MAX_TRAIN_ROWS, bits: int = BITS) -> np.ndarray:
    """Weights learned from at most ``max_rows`` labelled rows of ``docs``.

    ``labels`` holds the rows that may be learned from; rows with a null id
    or label are left out, and of an id labelled more than once the largest
    label counts. Without labelled rows all weights are 0 (every score 0.5).
    """
    bounded_batches(docs.sparkSession)
    known = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("label"))
             .dropna().groupBy("doc_id").agg(F.max("label").alias("label"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    sample = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(
        F.broadcast(known), "doc_id")

    def encode(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        codes = Codes()
        found = [features(t, codes, bits) for t in utf8(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [pa.array([0] * len(found), pa.int32()), batch.column("doc_id"), batch.column("label"),
             pa.array([i.tobytes() for i, _ in found], pa.binary()),
             pa.array([v.tobytes() for _, v in found], pa.binary())],
            ["part", "doc_id", "label", "index", "value"])

    def train(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "index"])
        examples = [(np.frombuffer(i, np.int32), np.frombuffer(v, np.float32), y)
                    for i, v, y in zip(rows["index"], rows["value"], rows["label"])]
        return pd.DataFrame({"weights": [ftrl(examples, bits).tobytes()]})

    id_type = docs.schema[id_col].dataType.simpleString()
    encoded = map_batches(sample, encode,
                          f"part int, doc_id {id_type}, label double, index binary, value binary")
    # one group, of at most max_rows rows: FTRL updates follow one another
    row = encoded.groupBy("part").applyInPandas(train, "weights binary").first()
    return np.frombuffer(row["weights"], np.float32) if row else np.zeros((1 << bits) + 1, np.float32)


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = 0.3, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, score and predicted for every row; ``keep`` names columns to carry along.

    A null or empty text has no n-grams and gets the bias alone. The weights
    have a fixed size of 2^bits and are broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    bits = (len(weights) - 1).bit_length() - 1
    kind = {f.name: f.dataType.simpleString() for f in docs.schema}
    memory: list = []

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not memory:
            memory.append(Codes())
        w = shared.value
        out = []
        for text in utf8(batch.column("_text")):
            total, count = 0.0, 0
            for part, known in pieces(text):
                h = ngram_hashes(part, memory[0], bits, known)
                total += float(w[h].sum(dtype=np.float64))
                count += len(h)
            margin = float(w[-1]) + (SCALE * total / count if count else 0.0)
            out.append(1 / (1 + np.exp(-min(35.0, max(-35.0, margin)))))
        out = np.array(out)
        yield pa.RecordBatch.from_arrays(
            [batch.column("_id"), *[batch.column(f"_keep{i}") for i in range(len(keep))],
             pa.array(out), pa.array((out >= threshold).astype(np.int32))],
            ["doc_id", *[f"_keep{i}" for i in range(len(keep))], "score", "predicted"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"),
                       *[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)])
    schema = ", ".join([f"doc_id {kind[id_col]}", *[f"_keep{i} {kind[c]}" for i, c in enumerate(keep)],
                        "score double", "predicted int"])
    return map_batches(rows, run, schema)
