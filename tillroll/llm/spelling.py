"""Spelling variants of frequent words, found by PartEnum signatures.

Words that differ by one inserted, deleted or replaced letter have letter
multisets that, as binary vectors with a dimension for each (letter, which
occurrence of it), differ in at most two dimensions. PartEnum deals the
dimensions into ``outer`` times ``inner`` parts. Of two differences an outer
part holds at most ``(2 + 1) / outer - 1`` somewhere (rounded up), so there the
words agree in all inner parts but so many. A word has one signature for each
outer part and each choice of that many inner parts to leave out: the content
of the others. Near words share a signature, without exception.

A signature says nothing about the order of letters, so words that share one
are grouped further, again without exception: one edit leaves the first or the
last half of the shortest allowed word alone, and the key takes either in. The
equi-join of the keys verifies every meeting by edit distance; only near pairs
leave it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import bounded_batches, land, utf8

MIN_LENGTH, MIN_COUNT, DOMINANCE, NOISE = 7, 2, 10, 31
#: PartEnum's numbers of parts, for differences in two dimensions.
OUTER, INNER, DIFFERENCES = 1, 5, 2
#: Texts are handled together up to so many bytes; a longer one alone.
CHUNK_BYTES = 8 << 20
#: Runs of more bytes are hashed one by one, not column by column.
LONG_RUN = 64


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1).astype(np.uint32)
    return c


CRC = _crc_table()


def _crcs(text: np.ndarray, starts: np.ndarray, sizes: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of text[start:start + size], going on from the crc32 ``before`` each."""
    order = np.argsort(-sizes, kind="stable")
    at, length = starts[order], sizes[order]
    state = before[order] ^ np.uint32(0xFFFFFFFF)
    many = int(np.searchsorted(-length, -LONG_RUN, side="left"))
    for k in range(many):
        run = text[at[k]:at[k] + length[k]].tobytes()
        state[k] = zlib.crc32(run, int(state[k]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    for k in range(int(length[many:].max(initial=0))):
        n = int(np.searchsorted(-length, -k, side="left"))
        part = state[many:n]
        state[many:n] = CRC[(part ^ text[at[many:n] + k]) & np.uint32(0xFF)] ^ (part >> np.uint32(8))
    out = np.empty_like(state)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


def words_of_texts(ids: list[str], texts: list[bytes], min_length: int, noise: int) -> pa.StringArray:
    """Every run of Latin letters, lower-cased and with its letter deleted where the hash says so, if long enough then."""
    a = np.frombuffer(b" ".join(texts), np.uint8).copy()
    sizes = np.array([len(t) + 1 for t in texts])
    a[(a >= 65) & (a <= 90)] += 32
    lead = a == 0xC3  # of U+00C0 to U+00FF, and of nothing else
    tail = np.zeros(len(a), bool)
    tail[1:] = lead[:-1]
    letter = np.zeros(len(a) + 2, bool)
    letter[1:-1] = ((a >= 97) & (a <= 122)) | lead | tail
    starts = np.flatnonzero(letter[1:-1] & ~letter[:-2])
    ends = np.flatnonzero(letter[1:-1] & ~letter[2:]) + 1
    points = np.concatenate([[0], np.cumsum(letter[1:-1] & ~tail, dtype=np.int64)])
    length = points[ends] - points[starts]
    long = length >= min_length
    starts, ends, length = starts[long], ends[long], length[long]
    doc = np.searchsorted(np.cumsum(sizes), starts, side="right")
    prefix = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], np.uint32)
    h = _crcs(a, starts, ends - starts, prefix[doc]).astype(np.int64)
    cut = h % noise == 0
    cut_at = np.flatnonzero(letter[1:-1] & ~tail)[points[starts[cut]] + h[cut] % length[cut]]
    width = np.where(lead[cut_at], 2, 1)
    size, kept = ends - starts, np.ones(len(starts), bool)
    size[cut] -= width
    kept[cut] = length[cut] > min_length
    edge = np.zeros(len(a) + 1, np.int8)
    edge[starts[kept]] += 1
    edge[ends[kept]] -= 1
    inside = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
    inside[cut_at] = False
    inside[cut_at[width == 2] + 1] = False
    offsets = np.concatenate([[0], np.cumsum(size[kept])])
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(a[inside].tobytes()))


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
               min_count: int = MIN_COUNT, noise: int = NOISE) -> DataFrame:
    """word, n: words of all texts and how often they occur, counted in the tasks before they are shuffled."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = utf8(batch.column("text")), batch.column("id").to_pylist()
            first, size = 0, 0
            for k, t in enumerate(texts):
                size += len(t)
                if size >= CHUNK_BYTES or k == len(texts) - 1:
                    found = pc.value_counts(words_of_texts(ids[first:k + 1], texts[first:k + 1], min_length, noise))
                    yield pa.RecordBatch.from_arrays([found.field(0).cast(pa.string()), found.field(1)], ["word", "n"])
                    first, size = k + 1, 0

    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


@lru_cache(maxsize=100_000)
def _part(dimension: str, parts: int) -> int:
    return zlib.crc32(dimension.encode()) % parts


def signatures(word: str, outer: int = OUTER, inner: int = INNER, differences: int = DIFFERENCES) -> list[str]:
    """The word's PartEnum signatures: two multisets that differ in ``differences`` dimensions at most share one."""
    left_out = -(-(differences + 1) // outer) - 1
    parts: list[list[str]] = [[] for _ in range(outer * inner)]
    met: dict[str, int] = {}
    for letter in sorted(word):
        met[letter] = k = met.get(letter, 0) + 1
        dimension = f"{letter}{k}"
        parts[_part(dimension, len(parts))].append(dimension)
    content = ["".join(p) for p in parts]
    return [f"{i}/{'/'.join(f'{j}:{content[i * inner + j]}' for j in chosen)}"
            for i in range(outer) for chosen in combinations(range(inner), inner - left_out)]


def near_pairs(words: DataFrame, min_length: int = MIN_LENGTH, outer: int = OUTER, inner: int = INNER) -> DataFrame:
    """word, n, near, near_n: every pair of ``words`` (word, n; distinct) at edit distance one, once, word < near."""
    if inner < DIFFERENCES or outer < 1:
        raise ValueError("there must be more inner parts than are left out")
    bounded_batches(words.sparkSession)
    half = (min_length - 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list[str] = []
            for word in batch.column("word").to_pylist():
                ends = (f"<{word[:half]}", f">{word[len(word) - half:]}")
                keys += [f"{end}|{s}" for s in signatures(word, outer, inner) for end in ends]
            each = len(keys) // max(1, batch.num_rows)
            who = np.repeat(np.arange(batch.num_rows), each)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), batch.column("word").take(pa.array(who)),
                                              batch.column("n").take(pa.array(who))], ["key", "word", "n"])

    signed = (words.select("word", "n").mapInArrow(run, "key string, word string, n long")
              # equal hashes of different keys only bring words together that then fail the test
              .select(F.xxhash64("key").alias("key"), F.col("key").startswith("<").alias("head"),
                      F.char_length("word").cast("int").alias("length"), "word", "n"))
    a, b = signed.alias("a"), signed.alias("b").hint("shuffle_merge")
    same_head = F.substring("a.word", 1, half) == F.substring("b.word", 1, half)
    met = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.head") == F.col("b.head")) & (F.col("a.word") < F.col("b.word"))
                 & F.col("a.length").between(F.col("b.length") - 1, F.col("b.length") + 1)
                 & (F.col("a.head") | ~same_head)  # words alike at both ends meet by the first
                 & (F.levenshtein("a.word", "b.word", 1) == 1))
    return met.select("a.word", "a.n", F.col("b.word").alias("near"), F.col("b.n").alias("near_n")).distinct()


def variants(words: DataFrame, pairs: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """word, n, form, form_n, n_near for each of ``words``, from their near pairs.

    A word has as many near words as there are letters to insert, delete or
    replace, so no group is larger than that, whatever the input.
    """
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("word"), F.col("near"), F.col("near_n")),
        F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))).alias("p")).select("p.*")
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("top"))
    top_n = -F.col("top.less")
    wins = top_n >= dominance * F.col("n")
    return words.join(best.hint("shuffle_merge"), "word", "left").select(
        "word", "n", F.when(wins, F.col("top.near")).alias("form"), F.when(wins, top_n).alias("form_n"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"))


def with_roots(found: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """``found`` and root, the last form that a word's forms lead to (the word itself if it has none).

    Each form is ``dominance`` times as frequent as the word before, so chains
    are short; every round doubles the steps known.
    """
    links = land(found.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "spelling-links")
    most = found.agg(F.max("n")).first()[0] or 1
    steps = 1
    while dominance ** steps < most:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = land(links.join(on.hint("shuffle_merge"), "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-links")
        steps *= 2
    return found.join(links.hint("shuffle_merge"), "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                      min_count: int = MIN_COUNT, dominance: int = DOMINANCE, noise: int = NOISE) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of ``docs``.

    Words are runs of ASCII letters and U+00C0 to U+00FF of the whole texts,
    ASCII letters in lower case; with h the crc32 of ``<id>:<run>``, a run
    whose h is divisible by ``noise`` loses its code point number h modulo its
    length. Words of at least ``min_length`` code points that occur
    ``min_count`` times count. form is the most frequent of a word's near
    words (smallest in code-point order of equally frequent ones) if it occurs
    ``dominance`` times as often as the word.

    A null text has no words; a null id counts as the empty string in h.
    Repeated rows count each. Other columns, whatever their names, aren't
    read. An empty table gives no rows.
    """
    if min_length < 1 or min_count < 1 or dominance < 2 or noise < 1:
        raise ValueError("min_length, min_count and noise must be positive, dominance at least 2")
    words = land(vocabulary(docs, id_col, text_col, min_length, min_count, noise), "spelling-words")
    found = land(variants(words, near_pairs(words, min_length), dominance), "spelling-variants")
    return with_roots(found, dominance).select("word", "form", "root", "n", "n_near", "form_n")
