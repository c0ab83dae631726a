"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A pattern is a window of words of a benchmark item. For each pattern length a
shift table over blocks of two words tells how far the search may jump; a
block that ends some pattern has shift 0 and leads to a bucket of the
patterns with that suffix, which are compared word by word.

The benchmark is the query set: it is searched in blocks of ``block_items``
items, one pass over the documents each, so tables in a worker stay bounded
whatever the benchmark's size.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import land, map_batches, utf8

WINDOW = 10
BLOCK_ITEMS = 20_000
PASSES_PER_JOB = 4

#: Bytes to what they count as: A-Z in lower case, digits and bytes above 0x7F kept, all else a space.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
             for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Patterns:
    """Shift table and suffix buckets of one pattern length."""

    def __init__(self, length: int, windows: dict[tuple, list[str]]):
        self.length, self.block = length, min(2, length)
        self.jump = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.bucket: dict[tuple, list] = {}
        for window, items in windows.items():
            for end in range(self.block, length + 1):
                block = window[end - self.block:end]
                self.shift[block] = min(length - end, self.shift.get(block, self.jump))
            self.bucket.setdefault(window[-self.block:], []).append((list(window), items))

    def find(self, words: list[bytes], spans: list, items: set) -> None:
        length, shift, jump, bucket = self.length, self.shift.get, self.jump, self.bucket
        at, n = length - 1, len(words)
        pairs = self.block == 2
        while at < n:
            block = (words[at - 1], words[at]) if pairs else (words[at],)
            step = shift(block, jump)
            if step:
                at += step
                continue
            start = at - length + 1
            for window, owners in bucket[block]:
                if words[start] == window[0] and words[start:at + 1] == window:
                    spans.append((start, at + 1))
                    items.update(owners)
            at += 1


def compile_patterns(items: list[tuple[str, bytes]], window: int = WINDOW) -> list[Patterns]:
    by_length: dict[int, dict[tuple, list[str]]] = {}
    for item, text in items:
        words = words_of(text)
        size = min(window, len(words))
        if size:
            own = by_length.setdefault(size, {})
            for i in range(len(words) - size + 1):
                own.setdefault(tuple(words[i:i + size]), []).append(item)
    return [Patterns(n, w) for n, w in sorted(by_length.items())]


def merged(spans: list[tuple[int, int]]) -> list[int]:
    """Disjoint spans that cover the same words, as a flat list."""
    out: list[int] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def _pass(items: list[tuple[str, bytes]], window: int, carried: list[str]):
    tables: list = []

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not tables:
            tables.append(compile_patterns(items, window))
        n_words, hits, owners = [], [], []
        for text, old, had in zip(utf8(batch.column("text")), batch.column("hits").to_pylist(),
                                  batch.column("items").to_pylist()):
            words = words_of(text)
            spans, found = list(zip(old[::2], old[1::2])), set(had)
            for patterns in tables[0]:
                patterns.find(words, spans, found)
            n_words.append(len(words))
            hits.append(merged(spans))
            owners.append(sorted(found))
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in carried], pa.array(n_words, pa.int64()),
             pa.array(hits, pa.list_(pa.int32())), pa.array(owners, pa.list_(pa.string()))],
            [*carried, "n_words", "hits", "items"])

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  block_items: int = BLOCK_ITEMS, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_words, hits (word spans start, end, flat), items (ids) per row of ``docs``.

    ``keep`` names columns to carry along, as _keep0, _keep1 and so on.

    An item of fewer than ``window`` words is one pattern as a whole; an item
    without words, or a null one, matches nothing. A null or empty document has
    no words. A row with a null item_id counts as the item named "". Repeated
    rows are each judged; extra columns aren't read; empty tables give rows
    without hits, or no rows.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                         *[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)])
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema)
    schema = f"{kind}, n_words long, hits array<int>, items array<string>"
    out = source.select("*", F.lit(0).cast("long").alias("n_words"),
                      F.array().cast("array<int>").alias("hits"), F.array().cast("array<string>").alias("items"))
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                             F.col(item_text_col).alias("text")).distinct()
    n = items.count()
    blocks = max(1, -(-n // block_items))
    if blocks > 1:
        # hashed into blocks of about block_items items; each is fetched on its own
        items = land(items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks))), "benchmark")
    for b in range(blocks):
        own = items.where(F.col("block") == b) if blocks > 1 else items
        query = [(r["item"], (r["text"] or "").encode()) for r in own.select("item", "text").collect()]
        out = map_batches(out, _pass(query, window, source.columns), schema)
        if b % PASSES_PER_JOB == PASSES_PER_JOB - 1 and b + 1 < blocks:
            out = land(out, "decontaminate")
    return out.drop("text")


def contamination_report(found: DataFrame) -> DataFrame:
    """Counts per document from the spans and items of ``decontaminate``."""
    odd = F.filter("hits", lambda x, i: i % 2 == 1)
    even = F.filter("hits", lambda x, i: i % 2 == 0)
    n_hit = F.aggregate(F.arrays_zip(even.alias("a"), odd.alias("b")), F.lit(0).cast("long"),
                        lambda acc, s: acc + (s["b"] - s["a"]))
    names = F.array_sort(F.array_distinct("items"))
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size(names).cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"))
