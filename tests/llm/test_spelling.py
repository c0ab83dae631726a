"""Spelling variants against a plain version."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.conftest import SF_SMALL
from tests.llm.brute import ASCII_LOWER
from tillroll.llm import queries, spelling
from tillroll.llm.common import table

SCHEMA = "doc_id long, text string, word string, n int, key string"


def counted(rows, min_length=7, min_count=2):
    out = Counter()
    for i, t in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", t or ""):
            w = run.translate(ASCII_LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            out[w] += 1
    return {w: n for w, n in out.items() if len(w) >= min_length and n >= min_count}


def is_near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain(rows, near=None):
    words = counted(rows)
    near = near or {w: [v for v in words if is_near(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted(((w, form[w], root(w), n, len(near[w]), form[w] and words[form[w]]) for w, n in words.items()), key=str)


def corpus(seed, size=300):
    rng = random.Random(seed)
    letters = "abcdefgéßÀÿ"
    base = ["".join(rng.choices(letters, k=rng.choice([5, 6, 7, 8, 9, 14]))) for _ in range(40)] + ["aaaaaaaa", "abababab", "ÉCOLIERS", "z" * 200]

    def changed(w):
        k, c = rng.randrange(len(w)), rng.choice(letters)
        return rng.choice([w[:k] + c + w[k:], w[:k] + w[k + 1:], w[:k] + c + w[k + 1:]])

    words = ["chainabcd"] * 3000 + ["chainabce"] * 150 + ["chainabxe"] * 6
    for w in base:
        words += [w] * rng.choice([3, 40, 400])
        for _ in range(rng.choice([0, 3, 10])):
            v = changed(w)
            words += [v] * rng.choice([1, 2, 4, 30]) + [changed(v)] * rng.choice([0, 2])
    rng.shuffle(words)
    rows = [(k, rng.choice([" ", "-", "1", "×", "ſ "]).join(x.upper() if rng.random() < .2 else x for x in words[k::size])) for k in range(size)]
    return [*rows, (None, "nothing nothing without an identity"), (1, None), (2, ""), (3, " \t1 2 3"), (5, rows[0][1]), (5, rows[0][1])]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain_version(spark, seed):
    rows = corpus(seed)
    want = plain(rows)
    assert any(r[2] not in (r[0], r[1]) for r in want)  # some chain has two steps
    assert sorted(map(tuple, spelling.spelling_variants(frame(spark, rows)).collect()), key=str) == want


def test_empty_and_wordless_tables(spark):
    assert spelling.spelling_variants(frame(spark, [])).count() == 0
    assert spelling.spelling_variants(frame(spark, [(1, None), (2, ""), (None, "a b c")])).count() == 0


def test_long_text(spark):
    rows = [(7, "Lengthy words repeated endlessly " * 100_000 + "q" * 300_000), (8, "lenghty " * 3 + "q" * 300_000)]
    assert sorted(map(tuple, spelling.spelling_variants(frame(spark, rows)).collect()), key=str) == plain(rows)


def test_near_words_share_a_signature():
    rng = random.Random(4)
    for outer, inner in ((1, 5), (1, 3), (2, 4), (3, 2)):
        for _ in range(2000):
            w = "".join(rng.choices("abcdeé", k=rng.choice([7, 8, 12])))
            k, c = rng.randrange(len(w)), rng.choice("abcxé")
            v = rng.choice([w[:k] + c + w[k:], w[:k] + w[k + 1:], w[:k] + c + w[k + 1:]])
            assert set(spelling.signatures(w, outer, inner)) & set(spelling.signatures(v, outer, inner))


def test_crc_of_many_runs():
    rng = np.random.default_rng(2)
    text = rng.integers(0, 256, 5000).astype(np.uint8)
    starts = rng.integers(0, 4000, 300)
    sizes = rng.integers(0, 150, 300)
    before = rng.integers(0, 2**32, 300).astype(np.uint32)
    want = [zlib.crc32(text[s:s + n].tobytes(), int(b)) for s, n, b in zip(starts, sizes, before)]
    assert spelling._crcs(text, starts, sizes, before).tolist() == want


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF_SMALL, "documents").collect()]
    words = counted(rows)
    # near words meet in a deletion of either or in both words without one place
    holes = {}
    for w in words:
        for k in range(len(w)):
            holes.setdefault((k, w[:k] + w[k + 1:]), set()).add(w)
    gone = {}
    for (_, h), ws in holes.items():
        gone.setdefault(h, set()).update(ws)
    near = {w: set() for w in words}
    for ws in holes.values():
        for w in ws:
            near[w] |= {v for v in ws if is_near(w, v)}
    for w in words:
        for v in gone.get(w, ()):
            near[w].add(v)
            near[v].add(w)
    out = queries.op11_spelling_variants(spark, SF_SMALL)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, out.collect()), key=str) == plain(rows, near)
