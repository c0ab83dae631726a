"""Deduplication over bytes by longest-previous-factor arrays, in buckets.

A byte goes if a string of ``length`` bytes over it also starts earlier: in
terms of the longest-previous-factor array (LPF), if a start at most
``length - 1`` before it has an LPF of ``length`` or more.

Strings that can't repeat are left out first: each half of a window has a
rarest gram (a minimizer), and a window repeats only if both halves' grams
do. The windows left go, as stretches that share their minimizer, to the
bucket of that minimizer, so all copies of a string meet. A minimizer met in
more than ``hot_blocks`` blocks is dealt on by both halves' minimizers; what
follows is the same. In a bucket, stretches with the bytes of an earlier one
go first (found by digest, compared as bytes, as each block does with its own).
The rest is put in suffix order to depth ``length``; previous and next smaller
positions in that order and the common prefixes with them give the LPF of
every start, and starts with ``length`` or more are the repeats.

Only equal documents are told by a print alone (128 bits of BLAKE2b): their
bytes never meet in one place.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.blocks import NULL_ID, arrays, ask, build_blocks, buckets_of, over_blocks, split_by_bucket, with_answers
from tillroll.llm.common import digests, mix64
from tillroll.llm.substring_dedup import BYTE, U, later_ones, span_prints

LENGTH, GRAM, HOT_BLOCKS, BUCKETS_PER_PARTITION = 100, 32, 256, 4
#: A bucket is put in suffix order in parts of about so many bytes.
RANKED_BYTES = 512 << 10
NEVER = np.iinfo(np.uint64).max
#: Rounds in which all open positions jump at once, before the few left walk one by one.
JUMPS = 16


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over every ``width`` values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[:-step], out[step:]) if len(out) > step else out[:0]
        have += step
    return out


def suffix_ranks(text: np.ndarray, depth: int, at: np.ndarray) -> np.ndarray:
    """Ranks of the suffixes that start at ``at`` by their first ``depth`` bytes, by prefix doubling.

    A rank is the place of the first of its equals in suffix order. Suffixes
    that differ from all others keep theirs; only the rest is ranked again.
    """
    n = len(text)
    wide = np.concatenate([text, np.zeros(8, np.uint8)]).astype(U)
    key, width = np.zeros(n, U), min(8, depth)
    for i in range(width):
        key = (key << U(8)) | wide[i:i + n]
    order = np.argsort(key)
    place = np.arange(n, dtype=np.int64)

    def starts(own: np.ndarray) -> np.ndarray:
        new = np.ones(len(own), bool)
        new[1:] = own[1:] != own[:-1]
        return new

    new = starts(key[order])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, place, 0))
    tied = order[~(new & np.append(new[1:], True))]
    asked = np.zeros(n, bool)
    asked[at] = True
    while width < depth and len(tied):
        step = min(width, depth - width)
        width += step
        if width == depth:
            tied = tied[asked[tied]]
        after = tied + step
        follow = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        old = rank[tied]
        key = old * (n + 1) + follow
        order = np.argsort(key)
        tied, key, old = tied[order], key[order], old[order]
        new, group = starts(key), starts(old)
        first = np.maximum.accumulate(np.where(group, place[:len(tied)], 0))
        rank[tied] = old + np.maximum.accumulate(np.where(new, place[:len(tied)], 0)) - first
        tied = tied[~(new & np.append(new[1:], True))]
    return rank[at]


def common_prefixes(text: np.ndarray, at: np.ndarray, depth: int, alike: np.ndarray | None = None) -> np.ndarray:
    """Bytes, up to ``depth``, that each suffix of ``at`` shares with the one before it; ``alike`` ones share all."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(depth + 16, np.uint8)])
    wide = np.ndarray((len(padded) - 7,), ">u8", padded, strides=(1,))
    own, before = at[1:], at[:-1]
    out = np.zeros(len(at), np.int64)
    limit = np.minimum(depth, n - np.maximum(own, before))
    out[1:] = limit
    left = np.arange(len(own)) if alike is None else np.flatnonzero(~alike[1:])
    sizes = U(1) << (U(8) * np.arange(8, dtype=U))
    for width in range(0, depth, 8):
        if not len(left):
            break
        differ = wide[own[left] + width].astype(U) ^ wide[before[left] + width].astype(U)
        end = left[differ != 0]
        out[1 + end] = np.minimum(limit[end], width + 8 - np.searchsorted(sizes, differ[differ != 0], side="right"))
        left = left[differ == 0]
        left = left[limit[left] > width + 8]
    return out


def previous_factors(place: np.ndarray, common: np.ndarray, depth: int) -> np.ndarray:
    """Longest-previous-factor values, up to ``depth``, of suffixes in their order.

    ``place`` says where they start and ``common`` what each shares with the
    one before. Suffixes alike to the depth stand in the order of their places:
    each has a previous smaller position right before it, but for the first.
    For these, the nearest smaller positions before and after are looked for by
    jumps along those found so far; the smallest common prefix on the way is
    shared with them. After ``JUMPS`` rounds the few still open walk one by one,
    linear in all.
    """
    out = np.full(len(place), depth, np.int64)
    first = np.flatnonzero(common < depth)
    place, common = place[first], common[first]
    factor = np.zeros(len(first), np.int64)
    for way in (1, -1):
        p = place[::way]
        near = common if way == 1 else np.concatenate([[0], common[:0:-1]])
        to, low = np.arange(-1, len(p) - 1), near.copy()
        still = np.arange(1, len(p))
        for _ in range(JUMPS):
            still = still[to[still] >= 0]
            still = still[p[to[still]] > p[still]]
            if not len(still):
                break
            j = to[still]
            low[still], to[still] = np.minimum(low[still], low[j]), to[j]
        # from the neighbour on, in order: what one walk has passed, no later one meets
        for i in still.tolist():
            j, least, own = i - 1, near[i], p[i]
            while j >= 0 and p[j] > own:
                j, least = int(to[j]), min(least, low[j])
            to[i], low[i] = j, least
        low[to < 0] = 0
        factor = np.maximum(factor, low[::way])
    out[first] = factor
    return out


def previous_factor_array(text: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """LPF, up to ``depth``, of the suffixes that start at ``at`` (ascending), among themselves.

    Each has ``depth`` bytes left, or the text has no zero byte (the text's end counts as zeros).
    """
    rank = suffix_ranks(text, depth, at)
    order = np.argsort(rank, kind="stable")  # alike ones in the order of their places
    rank = rank[order]
    alike = np.zeros(len(at), bool)
    alike[1:] = rank[1:] == rank[:-1]
    out = np.empty(len(at), np.int64)
    out[order] = previous_factors(order, common_prefixes(text, at[order], depth, alike), depth)
    return out


def later_stretches(one: np.ndarray, two: np.ndarray, order: np.ndarray, text: bytes, begin: np.ndarray,
                    end: np.ndarray) -> np.ndarray:
    """True where the stretch text[begin:end] has the bytes of the one before it in ``order``.

    ``order`` has equal digests (one, two) side by side, the earliest first;
    only those are compared.
    """
    a, b = one[order], two[order]
    at = np.flatnonzero((a[1:] == a[:-1]) & (b[1:] == b[:-1]))
    own, before = order[at + 1], order[at]
    again = np.zeros(len(one), bool)
    again[own] = [text[i:j] == text[x:y] for i, j, x, y in
                  zip(begin[own].tolist(), end[own].tolist(), begin[before].tolist(), end[before].tolist())]
    return again


class Grams:
    """Gram fingerprints of a block and the windows' minimizers."""

    def __init__(self, text: bytes, sizes: np.ndarray, length: int, gram: int):
        a = np.frombuffer(text, np.uint8)
        n = len(a)
        self.length, self.a = length, a
        self.limit = np.concatenate([[0], np.cumsum(sizes)])
        starts = np.arange(max(0, n - gram + 1))
        left = np.repeat(self.limit[1:], sizes) - np.arange(n)  # bytes to the document's end
        h = span_prints(a.astype(U) + U(1), BYTE, starts, starts + gram)
        h[left[:len(h)] < gram] = NEVER
        half = length // 3 * 2  # the two parts of a window overlap by a third
        self.shift = length - half
        self.part = sliding(h, half - gram + 1, np.minimum)  # of the part that starts here
        m = max(0, n - length + 1)
        self.valid = left[:m] >= length
        used = np.zeros(len(self.part), bool)
        used[:m] |= self.valid
        used[self.shift:self.shift + m] |= self.valid
        best = np.where(used, self.part, U(0))
        # a gram is picked where it is the minimizer of some part that holds it
        pad = np.zeros(half - gram, U)
        picked = sliding(np.concatenate([pad, best, pad]), half - gram + 1, np.maximum)[:len(h)]
        own = h[picked == h]
        self.found, count = np.unique(own[own != NEVER], return_counts=True)
        self.many = count > 1

    def place(self, value: np.ndarray) -> np.ndarray:
        return np.minimum(np.searchsorted(self.found, value), len(self.found) - 1)


def _document_rows(text: bytes, limit: np.ndarray, ids: np.ndarray, length: int) -> tuple:
    long = np.flatnonzero(np.diff(limit) >= length)
    return *digests(text[a:b] for a, b in zip(limit[long].tolist(), limit[long + 1].tolist())), ids[long], long


def _ask_grams(length: int, gram: int, buckets: int):
    def run(block: dict) -> list[tuple]:
        ids, sizes = arrays(block["ids"], block["sizes"])
        g = Grams(block["text"], sizes, length, gram)
        rows: dict[int, list] = {}
        order, met, slices = split_by_bucket(g.found, buckets)
        for b, s in zip(met.tolist(), slices):
            o = order[s]
            rows.setdefault(b, [b"", b"", b""])[:2] = g.found[o].tobytes(), np.packbits(g.many[o]).tobytes()
        one, two, doc, row = _document_rows(block["text"], g.limit, ids, length)
        order, met, slices = split_by_bucket(one, buckets)
        for b, s in zip(met.tolist(), slices):
            o = order[s]
            rows.setdefault(b, [b"", b"", b""])[2] = np.stack(
                [one[o], two[o], doc[o].astype(U), row[o].astype(U)]).tobytes()
        return [(b, block["block"], *r) for b, r in rows.items()]

    return run


def _answer_grams(hot_blocks: int):
    def run(rows: pd.DataFrame) -> list[tuple]:
        parts = [np.frombuffer(x, U) for x in rows["grams"]]
        many = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(p))
                               for x, p in zip(rows["many"], parts)])
        found, where, count = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        shared = ((count > 1) | (np.bincount(where, weights=many, minlength=len(found)) > 0))[where]
        hot = (count > hot_blocks)[where]
        cuts = np.cumsum([len(p) for p in parts])[:-1]
        bits = [(np.packbits(s).tobytes(), np.packbits(t).tobytes() if t.any() else b"")
                for s, t in zip(np.split(shared, cuts), np.split(hot, cuts))]
        docs = [np.frombuffer(x, U).reshape(4, -1) for x in rows["docs"]]
        one, two, ids, row = np.concatenate(docs, axis=1)
        source = np.repeat(np.arange(len(docs)), [d.shape[1] for d in docs])
        later = later_ones(one, two, ids.astype(np.int64), source, row.astype(np.int64))
        return [(block, bucket, *b, row[later & (source == k)].astype(np.int32).tobytes())
                for k, (block, bucket, b) in enumerate(zip(rows["block"], rows["bucket"], bits))]

    return run


def _runs(flags: np.ndarray, apart: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of the runs of True; ``apart[i]`` cuts between i - 1 and i."""
    begin, end = flags.copy(), flags.copy()
    if len(flags):
        joined = flags[1:] & flags[:-1]
        if apart is not None:
            joined &= ~apart[1:]
        begin[1:] &= ~joined
        end[:-1] &= ~joined
    return np.flatnonzero(begin), np.flatnonzero(end)


def _ask_windows(length: int, gram: int, gram_buckets: int, buckets: int):
    def run(block: dict) -> list[tuple]:
        ids, sizes = arrays(block["ids"], block["sizes"])
        g = Grams(block["text"], sizes, length, gram)
        copies = np.zeros(len(ids), bool)
        shared, hot = np.zeros(len(g.found), bool), np.zeros(len(g.found), bool)
        order, met, slices = split_by_bucket(g.found, gram_buckets)
        where = dict(zip(met.tolist(), slices))
        for x in block["answers"] or []:
            copies[np.frombuffer(x["docs"], np.int32)] = True
            if (s := where.get(x["bucket"])) is not None:
                n = s.stop - s.start
                shared[order[s]] = np.unpackbits(np.frombuffer(x["shared"], np.uint8), count=n).astype(bool)
                if x["hot"]:
                    hot[order[s]] = np.unpackbits(np.frombuffer(x["hot"], np.uint8), count=n).astype(bool)
        m = len(g.valid)
        gone = np.repeat(copies, sizes)[:m]
        # shared-ness of each part, then of each window
        asked = g.valid & ~gone
        if len(g.found) and m:
            change = np.ones(len(g.part), bool)
            change[1:] = g.part[1:] != g.part[:-1]
            at = np.cumsum(change) - 1
            ok = g.place(g.part[change])
            part = (shared[ok] & (g.found[ok] == g.part[change]))[at]
            asked &= part[:m] & part[g.shift:g.shift + m]
        else:
            asked[:] = False
        key = np.minimum(g.part[:m], g.part[g.shift:g.shift + m])
        if hot.any():
            at = np.flatnonzero(asked)
            at = at[hot[g.place(key[at])]]
            other = np.maximum(g.part[at], g.part[g.shift + at])
            key[at] = mix64(key[at] * U(0x9E3779B97F4A7C15) + other)
        apart = np.zeros(m, bool)
        apart[1:] = key[1:] != key[:-1]
        f, e = _runs(asked, apart)
        d = np.searchsorted(g.limit, f, side="right") - 1
        text = block["text"]
        one, two = digests(text[x:y + length] for x, y in zip(f.tolist(), e.tolist()))
        two &= U(0xFFFFFFFF)
        # the block's own later copies are settled here; each string goes out once
        again = later_stretches(one, two, np.lexsort((two, one)), text, f, e + length)
        done = np.stack([f[again], e[again] - f[again] + 1]).astype(np.uint32)
        f, e, d, one, two = f[~again], e[~again], d[~again], one[~again], two[~again]
        rows = []
        order, met, slices = split_by_bucket(key[f], buckets)
        for b, s in zip(met.tolist(), slices):
            o = order[s]
            rows.append((b, block["block"], one[o].tobytes(), two[o].astype(np.uint32).tobytes(),
                         ids[d[o]].tobytes(), f[o].astype(np.uint32).tobytes(),
                         (e[o] - f[o] + 1).astype(np.uint32).tobytes(),
                         b"".join([text[x:y + length] for x, y in zip(f[o].tolist(), e[o].tolist())]),
                         (key[f[o]] >> U(8)).astype(np.uint8).tobytes()))
        rows.append((-1 - block["block"], block["block"], b"", np.flatnonzero(copies).astype(np.int32).tobytes(),
                     b"", done[0].tobytes(), done[1].tobytes(), b"", b""))
        return rows

    return run


def _answer_windows(length: int):
    def columns(rows: pd.DataFrame) -> tuple:
        out = [np.concatenate([np.frombuffer(x, t) for x in rows[c]])
               for c, t in (("one", U), ("two", np.uint32), ("doc", np.int64), ("at", np.uint32))]
        return *out, np.repeat(np.arange(len(rows)), [len(x) // 8 for x in rows["one"]])

    def repeated(text: np.ndarray, begin: np.ndarray, runs: np.ndarray, sizes: np.ndarray) -> tuple:
        """Of stretches in order, each ``runs`` starts long: those with starts met before, as stretch, first and last."""
        text = text[np.repeat(begin - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))]
        place = np.cumsum(sizes) - sizes
        start = np.repeat(place - np.cumsum(runs) + runs, runs) + np.arange(int(runs.sum()))
        known = previous_factor_array(text, start, length) >= length
        stretch = np.repeat(np.arange(len(runs)), runs)
        apart = np.zeros(len(start), bool)
        apart[1:] = stretch[1:] != stretch[:-1]
        first, last = _runs(known, apart)
        own = stretch[first]
        inside = start[first] - place[own]
        return own, inside, inside + last - first

    def run(rows: pd.DataFrame) -> list[tuple]:
        if rows["bucket"].iloc[0] < 0:
            return list(zip(rows["block"], rows["at"], rows["runs"], rows["two"]))
        out = []

        def answer(blocks: np.ndarray, source: np.ndarray, at: np.ndarray, n: np.ndarray) -> None:
            order = np.argsort(source, kind="stable")
            met, cut = np.unique(source[order], return_index=True)
            for k, o in zip(met, np.split(order, cut[1:])):
                out.append((int(blocks[k]), at[o].astype(np.uint32).tobytes(), n[o].astype(np.uint32).tobytes(), b""))

        blocks = rows["block"].to_numpy()
        one, two, doc, at, source = columns(rows)
        runs = np.concatenate([np.frombuffer(x, np.uint32) for x in rows["runs"]]).astype(np.int64)
        sizes = runs + length - 1
        begin = np.cumsum(sizes) - sizes
        joined = b"".join(rows["text"])
        text = np.frombuffer(joined, np.uint8)
        later = later_stretches(one, two, np.lexsort((at, source, doc, two, one)), joined, begin, begin + sizes)
        answer(blocks, source[later], at[later], runs[later])
        # copies of a string share their minimizer, so a bucket is ranked in parts of bounded size by its bits
        parts = min(256, 1 + len(text) // RANKED_BYTES)
        part = np.concatenate([np.frombuffer(x, np.uint8) for x in rows["part"]]) % parts
        new = np.flatnonzero(~later)
        new = new[np.lexsort((at[new], source[new], doc[new], part[new]))]  # in (document, position) order
        for own in np.split(new, np.flatnonzero(np.diff(part[new])) + 1):
            if len(own):
                k, first, last = repeated(text, begin[own], runs[own], sizes[own])
                k = own[k]
                answer(blocks, source[k], at[k] + first, last - first + 1)
        return out

    return run


def _remove(length: int):
    def run(block: dict) -> list[tuple]:
        ids, sizes = arrays(block["ids"], block["sizes"])
        text = block["text"]
        a = np.frombuffer(text, np.uint8)
        change = np.zeros(len(a) + 1, np.int64)
        copies = np.zeros(len(ids), bool)
        for x in block["answers"] or []:
            at, n = (np.frombuffer(x[c], np.uint32).astype(np.int64) for c in ("at", "runs"))
            np.add.at(change, at, 1)
            np.add.at(change, at + n - 1 + length, -1)
            copies[np.frombuffer(x["copies"], np.int32)] = True
        gone = (np.cumsum(change[:-1]) > 0) | np.repeat(copies, sizes)
        limit = np.concatenate([[0], np.cumsum(sizes)]).tolist()
        out = []
        for k, i in enumerate(ids.tolist()):
            own, kept, spans = gone[limit[k]:limit[k + 1]], text[limit[k]:limit[k + 1]], []
            if own.any():
                spans = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8))).tolist()
                kept = a[limit[k]:limit[k + 1]][~own].tobytes()
            out.append((None if i == NULL_ID else i, len(own), spans, kept))
        return out

    return run


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                 gram: int | None = None, hot_blocks: int = HOT_BLOCKS) -> DataFrame:
    """doc_id, n_bytes, spans (of removed bytes: start, end, flat) and kept (bytes) per row.

    Matches never cross documents; what starts earlier is told by the smaller
    id or, in one document, the smaller position, on the input. A null text
    is empty; one of fewer than ``length`` bytes loses nothing. Rows with a
    null id come after all others; rows that share an id count as documents
    of their own, in the order of the blocks they were read in, so one copy
    stays. Other columns aren't read; an empty table gives no rows. Ids are
    integers.
    """
    gram = gram or max(1, min(GRAM, length // 3))
    blocks = build_blocks(docs, id_col, text_col, "suffix")
    n = buckets_of(docs)
    grams = ask(over_blocks(blocks, _ask_grams(length, gram, n),
                            "bucket long, block long, grams binary, many binary, docs binary"),
                _answer_grams(hot_blocks), "block long, bucket long, shared binary, hot binary, docs binary")
    windows = ask(over_blocks(with_answers(blocks, grams), _ask_windows(length, gram, n, n * BUCKETS_PER_PARTITION),
                              "bucket long, block long, one binary, two binary, doc binary, at binary, runs binary, text binary, part binary"),
                  _answer_windows(length), "block long, at binary, runs binary, copies binary")
    return over_blocks(with_answers(blocks, windows), _remove(length),
                       "doc_id long, n_bytes long, spans array<int>, kept binary")
