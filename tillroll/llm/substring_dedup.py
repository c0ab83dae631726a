"""Substring deduplication over words by recompression.

Every document's word sequence is rewritten in rounds: runs of one symbol get
a name, then pairs of a left and a right symbol do (each round deals all
symbols into left and right). Names are fingerprints of what they stand for,
so all Spark tasks give equal substrings the same names without asking each
other; away from a substring's ends its symbols are the same wherever it
occurs. For a window of words the part of its parse that depends on the
window alone is known exactly, and the longest symbol in it is its anchor.

Only windows whose anchor occurs more than once in the corpus can repeat.
Those windows, fingerprinted with 96 bits over the words' names, are brought
together; all but the earliest are removed. Whole documents that are equal are
settled first, by a 128-bit digest of the sequence of names. A word's name is
64 bits of BLAKE2b.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.blocks import NULL_ID, arrays, ask, build_blocks, buckets_of, over_blocks, split_by_bucket, with_answers
from tillroll.llm.common import digests, mix64, window_prints, word_names, worker_state

WINDOW, ROUNDS = 20, 2

U = np.uint64
#: Odd multipliers of the fingerprints.
BYTE, WORD, CHECK, PAIR = U(0x9E3779B97F4A7C55), U(0xD1342543DE82EF95), U(0xAF251AF3B0F025B5), U(0xDA942042E4DD58B5)


def _powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^0..base^n and their inverses modulo 2^64, kept for a worker's later blocks."""
    def make(n):
        inverse = U(pow(int(base), -1, 1 << 64))
        return tuple(np.concatenate([[U(1)], np.cumprod(np.full(n, b, U))]) for b in (base, inverse))

    held = worker_state(("powers", int(base)), lambda: {"at": make(1 << 16)})
    if len(held["at"][0]) <= n:
        held["at"] = make(2 * n)
    return held["at"]


def span_prints(values: np.ndarray, base: np.uint64, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprints of values[starts:ends], equal for equal spans wherever they lie.

    A polynomial modulo 2^64, so unequal long spans of a certain make have
    equal ones too: only for choosing candidates, or for a few values that are
    hashes themselves.
    """
    power, inverse = _powers(base, len(values) + 1)
    total = np.concatenate([np.zeros(1, U), np.cumsum(values * power[:len(values)])])
    return mix64((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(U))


def words_of(text: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document number of each word of texts that lie end to end."""
    a = np.frombuffer(text, np.uint8)
    inside = np.ones(len(a) + 2, bool)
    inside[1:-1] = ~((a == 32) | ((a >= 9) & (a <= 13)))
    inside[0] = inside[-1] = False
    begins, stops = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    cut = np.cumsum(sizes)[:-1]  # words end where documents do
    cut = cut[(cut > 0) & (cut < len(a))]
    both = cut[inside[cut] & inside[cut + 1]]
    begins[both] = True
    stops[both] = True
    starts, ends = np.flatnonzero(begins[:len(a)]), np.flatnonzero(stops)
    doc = np.searchsorted(np.cumsum(sizes), starts, side="right")
    return starts, ends, doc


class Parse:
    """Words of a block and, for each window, whether it has an anchor and which."""

    def __init__(self, text: bytes, sizes: np.ndarray, window: int, rounds: int):
        self.window = window
        self.starts, self.ends, self.doc = words_of(text, sizes)
        self.word = word_names(np.frombuffer(text, np.uint8), self.starts, self.ends)
        n = len(self.word)
        at = np.arange(max(0, n - window + 1))
        self.at = at[self.doc[at] == self.doc[at + window - 1]]
        self.anchor, self.sure = self._anchors(rounds)

    def _anchors(self, rounds: int) -> tuple[np.ndarray, np.ndarray]:
        name, doc, width = self.word, self.doc, np.ones(len(self.word), np.int64)
        first, last = self.at, self.at + self.window - 1
        sure = np.ones(len(first), bool)
        if not len(first):
            return np.zeros(0, U), sure
        for r in range(rounds):
            # runs
            new = np.ones(len(name), bool)
            new[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
            begin, run = np.flatnonzero(new), np.cumsum(new) - 1
            count = np.diff(np.append(begin, len(name))).astype(U)
            many = count > 1
            width = np.add.reduceat(width, begin)
            name, doc = name[begin], doc[begin]
            name[many] = mix64(name[many] ^ mix64(count[many] * PAIR))
            # pairs of a left (False) and a right (True) symbol
            right = (mix64(name + U((r + 1) * int(CHECK) % 2**64)) >> U(63)).astype(bool)
            pair = np.zeros(len(name), bool)
            pair[:-1] = ~right[:-1] & right[1:] & (doc[:-1] == doc[1:])
            head = np.ones(len(name), bool)
            head[1:] = ~pair[:-1]
            # the first and last runs may go on outside the window, and their neighbours be paired with them
            most = len(name) - 1
            a, b = run[first] + 1, run[last] - 1
            a, b = a + right[np.minimum(a, most)], b - ~right[np.maximum(b, 0)]
            sure &= a <= b
            place = np.cumsum(head) - 1
            first, last = place[np.clip(a, 0, most)], place[np.clip(b, 0, most)]
            keep = np.flatnonzero(head)
            joined = keep[pair[keep]]
            after = name.copy()
            after[joined] = mix64(name[joined] * PAIR + mix64(name[joined + 1]))
            width = np.add.reduceat(width, keep)
            name, doc = after[keep], doc[keep]
        # the longest symbol from first to last; bit 0 stays free
        rank = (np.minimum(width, 15).astype(U) << U(60)) | (mix64(name) >> U(4)) & ~U(1)
        self.rank = rank
        first, last = np.where(sure, first, 0), np.where(sure, last, 0)
        span = last - first + 1
        out = np.zeros(len(first), U)
        table, size = rank, 1
        while True:
            own = np.flatnonzero((span >= size) & (span < 2 * size))
            out[own] = np.maximum(table[first[own]], table[last[own] - size + 1])
            if not (span >= 2 * size).any():
                return out, sure
            table = np.maximum(table[:-size], table[size:])
            size *= 2

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct anchors, and whether each is met in more than one place of the block."""
        own = self.anchor[self.sure]
        if not len(own):
            return own, np.zeros(0, bool)
        apart = np.ones(len(own), bool)
        apart[1:] = own[1:] != own[:-1]
        found = np.unique(own[apart])
        place = np.minimum(np.searchsorted(found, self.rank), len(found) - 1)
        return found, np.bincount(place[found[place] == self.rank], minlength=len(found)) > 1

    def documents(self, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First word, and two fingerprints, of each document."""
        edge = np.searchsorted(self.doc, np.arange(n_docs + 1))
        return edge, *digests(self.word[a:b].tobytes() for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()))


def _ask_anchors(window: int, rounds: int, buckets: int):
    def run(block: dict) -> list[tuple]:
        ids, sizes = arrays(block["ids"], block["sizes"])
        parse = Parse(block["text"], sizes, window, rounds)
        found, many = parse.anchors()
        rows: dict[int, list] = {}
        order, met, slices = split_by_bucket(found, buckets)
        packed = found[order] | many[order].astype(U)
        for b, s in zip(met.tolist(), slices):
            rows.setdefault(b, [b"", b""])[0] = packed[s].tobytes()
        edge, one, two = parse.documents(len(ids))
        long = np.flatnonzero(np.diff(edge) >= window)
        order, met, slices = split_by_bucket(one[long], buckets)
        row = long[order]
        for b, s in zip(met.tolist(), slices):
            rows.setdefault(b, [b"", b""])[1] = np.stack(
                [one[row[s]], two[row[s]], ids[row[s]].astype(U), row[s].astype(U)]).tobytes()
        return [(b, block["block"], *r) for b, r in rows.items()]

    return run


def _answer_anchors(rows: pd.DataFrame) -> list[tuple]:
    """Bits of the anchors that occur more than once, and the documents that aren't the first of their kind."""
    parts = [np.frombuffer(x, U) for x in rows["anchors"]]
    every = np.concatenate(parts)
    many, value = (every & U(1)).astype(bool), every & ~U(1)
    found, where, count = np.unique(value, return_inverse=True, return_counts=True)
    shared = ((count > 1) | (np.bincount(where, weights=many, minlength=len(found)) > 0))[where]
    cuts = np.cumsum([len(p) for p in parts])[:-1]
    bits = [np.packbits(s).tobytes() for s in np.split(shared, cuts)]
    docs = [np.frombuffer(x, U).reshape(4, -1) for x in rows["docs"]]
    one, two, ids, row = np.concatenate(docs, axis=1)
    source = np.repeat(np.arange(len(docs)), [d.shape[1] for d in docs])
    later = later_ones(one, two, ids.astype(np.int64), source, row.astype(np.int64))
    return [(block, bucket, b, row[later & (source == k)].astype(np.int32).tobytes())
            for k, (block, bucket, b) in enumerate(zip(rows["block"], rows["bucket"], bits))]


def later_ones(one: np.ndarray, two: np.ndarray, doc: np.ndarray, source: np.ndarray, place: np.ndarray) -> np.ndarray:
    """True where (one, two) also occurs at a smaller (doc, source, place)."""
    order = np.lexsort((place, source, doc, two, one))
    again = np.zeros(len(one), bool)
    a, b = one[order], two[order]
    again[order[1:]] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    return again


def _ask_windows(window: int, rounds: int, buckets: int):
    def run(block: dict) -> list[tuple]:
        ids, sizes = arrays(block["ids"], block["sizes"])
        parse = Parse(block["text"], sizes, window, rounds)
        found, _ = parse.anchors()
        copies = np.zeros(len(ids), bool)
        shared = np.zeros(len(found), bool)
        order, met, slices = split_by_bucket(found, buckets)
        where = dict(zip(met.tolist(), slices))
        for a in block["answers"] or []:
            copies[np.frombuffer(a["docs"], np.int32)] = True
            if (s := where.get(a["bucket"])) is not None:
                shared[order[s]] = np.unpackbits(np.frombuffer(a["anchors"], np.uint8),
                                                 count=s.stop - s.start).astype(bool)
        asked = ~parse.sure
        if len(found):
            asked |= shared[np.minimum(np.searchsorted(found, parse.anchor), len(found) - 1)]
        at = parse.at[asked & ~copies[parse.doc[parse.at]]]
        one = window_prints(parse.word, window, WORD)[at]
        two = window_prints(parse.word, window, CHECK)[at] & U(0xFFFFFFFF)
        # the block's own later ones are settled here; each window goes out once
        again = later_ones(one, two, np.zeros(len(at), np.int64), np.zeros(len(at), np.int64), at)
        rows = [(-1 - block["block"], block["block"], b"", b"", b"", at[again].astype(np.uint32).tobytes(),
                 np.flatnonzero(copies).astype(np.int32).tobytes())]
        at, one, two = at[~again], one[~again], two[~again]
        doc = ids[parse.doc[at]]
        order, met, slices = split_by_bucket(one, buckets)
        for b, s in zip(met.tolist(), slices):
            o = order[s]
            rows.append((b, block["block"], one[o].tobytes(), two[o].astype(np.uint32).tobytes(), doc[o].tobytes(),
                         at[o].astype(np.uint32).tobytes(), b""))
        return rows

    return run


def _answer_windows(rows: pd.DataFrame) -> list[tuple]:
    if rows["bucket"].iloc[0] < 0:
        return list(zip(rows["block"], rows["at"], rows["copies"]))
    one, two, doc, at = (np.concatenate([np.frombuffer(x, t) for x in rows[c]])
                         for c, t in (("one", U), ("two", np.uint32), ("doc", np.int64), ("at", np.uint32)))
    sizes = [len(x) // 8 for x in rows["one"]]
    source = np.repeat(np.arange(len(sizes)), sizes)
    later = later_ones(one, two, doc, source, at)
    cuts = np.cumsum(sizes)[:-1]
    return [(block, a[again].tobytes(), b"") for block, a, again in
            zip(rows["block"], np.split(at, cuts), np.split(later, cuts)) if again.any()]


def _remove(window: int):
    def run(block: dict) -> list[tuple]:
        ids, sizes = arrays(block["ids"], block["sizes"])
        text = block["text"]
        starts, ends, doc = words_of(text, sizes)
        n = len(starts)
        change = np.zeros(n + 1, np.int64)
        copies = np.zeros(len(ids), bool)
        for a in block["answers"] or []:
            at = np.frombuffer(a["at"], np.uint32).astype(np.int64)
            np.add.at(change, at, 1)
            np.add.at(change, at + window, -1)
            copies[np.frombuffer(a["copies"], np.int32)] = True
        gone = (np.cumsum(change[:-1]) > 0) | copies[doc]
        edge = np.searchsorted(doc, np.arange(len(ids) + 1))
        limit = np.concatenate([[0], np.cumsum(sizes)])
        out = []
        for k, i in enumerate(ids.tolist()):
            a, b = edge[k], edge[k + 1]
            words = text[limit[k]:limit[k + 1]].split()
            own = gone[a:b]
            spans: list[int] = []
            if own.any():
                flip = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
                spans = flip.tolist()
                words = [w for w, g in zip(words, own.tolist()) if not g]
            out.append((None if i == NULL_ID else i, b - a, spans, b" ".join(words).decode()))
        return out

    return run


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                    rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_words, spans (of removed words: start, end, flat) and kept (text) per row.

    Words are runs of characters other than ASCII white space. A word goes if
    a window of ``window`` words over it also starts earlier: in a document
    with a smaller id or earlier in the same one, judged on the input. A null
    or empty text has no words, one of fewer than ``window`` words loses none.
    Rows with a null id come after all others; rows that share an id count as
    documents of their own, in the order of the blocks they were read in, so
    one copy stays. Other columns aren't read; an empty table gives no rows.
    Ids are integers.
    """
    if window < 4 * rounds or rounds < 1:
        raise ValueError("a window needs at least 4 words a round")
    blocks = build_blocks(docs, id_col, text_col, "substring")
    n = buckets_of(docs)
    anchors = ask(over_blocks(blocks, _ask_anchors(window, rounds, n),
                              "bucket long, block long, anchors binary, docs binary"),
                  _answer_anchors, "block long, bucket long, anchors binary, docs binary")
    windows = ask(over_blocks(with_answers(blocks, anchors), _ask_windows(window, rounds, n),
                              "bucket long, block long, one binary, two binary, doc binary, at binary, copies binary"),
                  _answer_windows, "block long, at binary, copies binary")
    return over_blocks(with_answers(blocks, windows), _remove(window),
                       "doc_id long, n_words long, spans array<int>, kept string")


def removed_words(spans: str = "spans") -> F.Column:
    """Number of words in flat spans."""
    return F.aggregate(F.transform(spans, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)),
                       F.lit(0).cast("long"), lambda acc, x: acc + x)
