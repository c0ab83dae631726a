"""Quality rules of a text, the main one on its repeated passages by suffix array.

The words of a text are put in suffix order by prefix doubling; the ranks of
each doubling tell how far neighbours in that order agree. A run of suffixes
whose neighbours all agree on n words is an interval of the longest common
prefix: those n words are a repeated substring, and a suffix's innermost
interval is the longest substring that starts there and occurs again. The
union of these spans contains those of all maximal repeats and nothing else.
Rules limit the share of words in spans of ``min_words`` and more, and the
longest repeat.

Texts never meet: many share one array, in which a rank includes the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import bounded_batches, utf8
from tillroll.llm.substring_dedup import words_of

#: The base rules: fewest words, and the most words (in a hundred) inside 3-word windows found again.
LEAST_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = 50, 3, 50
#: The rules on repeated passages: which count, how many words in a hundred they may cover, the longest one allowed.
MIN_WORDS, COVERED_PERCENT, LONGEST = 10, 30, 100
SYMBOLS = b"#*$%&|<>"
#: Texts are handled together up to so many bytes; a longer one alone.
CHUNK_BYTES = 2 << 20

SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "n_covered long, longest_repeat long, base_failed boolean, kept boolean")


def _starts(sorted_key: np.ndarray) -> np.ndarray:
    new = np.ones(len(sorted_key), bool)
    new[1:] = sorted_key[1:] != sorted_key[:-1]
    return new


def suffix_levels(word: np.ndarray, doc: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... words, until no two of a text are equal.

    A rank is the place of the first of its equals in suffix order.
    """
    n = len(word)
    key = doc.astype(np.int64) * (int(word.max(initial=0)) + 1) + word
    order = np.argsort(key, kind="stable")
    new = _starts(key[order])
    rank = np.empty(n, np.int32)
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
    levels, width = [rank], 1
    tied = order[~(new & np.append(new[1:], True))]
    while len(tied):
        rank = rank.copy()
        after = tied + width
        inside = after < n
        inside[inside] = doc[after[inside]] == doc[tied[inside]]
        follow = np.zeros(len(tied), np.int64)
        follow[inside] = levels[-1][after[inside]] + 1
        key = levels[-1][tied].astype(np.int64) * (n + 1) + follow
        order = np.argsort(key, kind="stable")
        tied, key = tied[order], key[order]
        new, group = _starts(key), _starts(levels[-1][tied])
        at = np.arange(len(tied))
        # the group keeps its place; inside it the new groups come one after the other
        first = np.maximum.accumulate(np.where(group, at, 0))
        offset = np.maximum.accumulate(np.where(new, at, 0)) - first
        rank[tied] = levels[-1][tied] + offset
        levels.append(rank)
        width *= 2
        tied = tied[~(new & np.append(new[1:], True))]
    return levels


def longest_repeats(word: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each word the length of the longest substring that starts there and occurs elsewhere in its text."""
    n = len(word)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    levels = suffix_levels(word, doc)
    order = np.empty(n, np.int64)
    order[levels[-1]] = np.arange(n)
    a, b = order[:-1], order[1:]
    same = np.flatnonzero(levels[0][a] == levels[0][b])
    a, b = a[same], b[same]
    prefix = np.zeros(len(a), np.int64)
    # equal ranks mean that many equal words: suffixes of one text that meet its end differ
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + prefix, b + prefix
        fits = (x < n) & (y < n)
        fits[fits] = (levels[k][x[fits]] == levels[k][y[fits]]) & (doc[x[fits]] == doc[a[fits]])
        prefix[fits] += 1 << k
    # the innermost interval of a suffix is the closer agreement with its two neighbours
    np.maximum.at(out, a, prefix)
    np.maximum.at(out, b, prefix)
    return out


def covered(length: np.ndarray, least: int) -> np.ndarray:
    """Which words lie in the union of the spans of ``least`` words and more."""
    at = np.arange(len(length))
    reach = np.maximum.accumulate(np.where(length >= least, at + length, 0)) if len(at) else at
    return reach > at


def dup_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    if b"\n" not in text:
        return 0
    lines = [x for x in text.split(b"\n") if x.split(None, 1)]
    return len(lines) - len(set(lines))


def measure(texts: list[bytes], least_words: int, window: int, repeat_percent: int,
            min_words: int, covered_percent: int, longest: int) -> list[np.ndarray]:
    """The columns of ``SCHEMA`` for texts that share one suffix array."""
    n = len(texts)
    text, sizes = b"".join(texts), np.array([len(t) for t in texts], np.int64)
    a = np.frombuffer(text, np.uint8)
    ends = np.cumsum(sizes)

    def per_text(flag: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flag)])
        return total[ends] - total[ends - sizes]

    blank = (a == 32) | ((a >= 9) & (a <= 13))
    chars = per_text(~blank & ((a & 0xC0) != 0x80))
    symbols = per_text(np.isin(a, np.frombuffer(SYMBOLS, np.uint8)))
    begin, stop, doc = words_of(text, sizes)
    offsets = np.concatenate([[0], np.cumsum(stop - begin)]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(a[~blank].tobytes())])
    word = words.dictionary_encode().indices.to_numpy()
    length = longest_repeats(word, doc)

    def in_text(weights: np.ndarray) -> np.ndarray:
        return np.bincount(doc, weights, n).astype(np.int64)

    words_in = np.bincount(doc, minlength=n)
    again, cover = in_text(covered(length, window)), in_text(covered(length, min_words))
    most = np.zeros(n, np.int64)
    np.maximum.at(most, doc, length)
    failed = (words_in < least_words) | (100 * again > repeat_percent * words_in)
    kept = ~failed & (100 * cover <= covered_percent * words_in) & (most <= longest)
    return [words_in, chars, symbols, np.array([dup_lines(t) for t in texts], np.int64), again, cover, most, failed, kept]


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS,
                  window: int = REPEAT_WINDOW, repeat_percent: int = REPEAT_PERCENT, min_words: int = MIN_WORDS,
                  covered_percent: int = COVERED_PERCENT, longest: int = LONGEST) -> DataFrame:
    """One row for each row of ``docs``: its id and the columns of ``SCHEMA``.

    Words are runs of other bytes than ASCII white space. ``n_covered`` counts
    words inside passages of ``min_words`` and more that the text repeats,
    ``longest_repeat`` the words of its longest repeated passage (copies may
    overlap). ``base_failed``: fewer than ``least_words`` words, or more than
    ``repeat_percent`` of a hundred inside ``window``-word windows that occur
    again. ``kept``: not that, at most ``covered_percent`` of a hundred words
    covered, and no repeat of more than ``longest`` words.

    A null text has no words, like an empty one: not kept. Null and repeated
    ids are rows like others. Other columns, whatever their names, aren't
    read. An empty table gives no rows. A text is handled whole by one task,
    whatever its length, with some 60 bytes of memory for each of its words.
    """
    if min(least_words, longest) < 0 or min(window, min_words) < 1:
        raise ValueError("limits must not be negative, and windows have a word at least")
    bounded_batches(docs.sparkSession)
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column("text"))
            first, size = 0, 0
            for k, t in enumerate(texts):
                size += len(t)
                if size >= CHUNK_BYTES or k == len(texts) - 1:
                    columns = measure(texts[first:k + 1], least_words, window, repeat_percent, min_words, covered_percent, longest)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id").slice(first, k + 1 - first), *map(pa.array, columns)], ["id", *names])
                    first, size = k + 1, 0

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, {SCHEMA}").withColumnRenamed("id", "doc_id")
