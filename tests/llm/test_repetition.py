"""Quality rules against a plain version."""

import random
import re

import numpy as np

from tests.conftest import SF_SMALL
from tillroll.llm import queries, repetition
from tillroll.llm.common import table

SCHEMA = "doc_id string, text string, id int, n_words string, kept int"
COLUMNS = ["doc_id", *(c.split()[0] for c in repetition.SCHEMA.split(", "))]


def longest_at(w):
    """Length of the longest substring at each place that occurs elsewhere too."""
    out = [0] * len(w)
    for i in range(len(w)):
        for j in range(i):
            k = 0
            while i + k < len(w) and w[i + k] == w[j + k]:
                k += 1
            out[i], out[j] = max(out[i], k), max(out[j], k)
    return out


def plain(rows, min_words=10, percent=30, longest=100):
    out = []
    for i, t in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        at = longest_at(w)

        def inside(n):
            return len({p for k, x in enumerate(at) if x >= n for p in range(k, k + x)})

        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(w) < 50 or 100 * inside(3) > 50 * len(w)
        out.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), inside(3),
                    inside(min_words), max(at, default=0), failed,
                    not failed and 100 * inside(min_words) <= percent * len(w) and max(at, default=0) <= longest))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = [f"w{k}" for k in range(400)] + ["naïve", "日本語", "a&b", "<p>", "#", "x y", " "]
    rows = [("null", None), ("empty", ""), ("blank", " \t\r\n\x0b\x0c "), (None, "one two"), (None, None), ("one", "word"),
            ("same", "la " * 70), ("same", "la " * 70), ("lines", "a line\n\n \na line\r\na line\nb"), ("nul", "a\x00b " * 3)]
    for k in range(60):
        text = rng.choices(word, k=rng.choice([20, 49, 50, 51, 120, 260]))
        for _ in range(rng.choice([0, 0, 1, 3])):
            a = rng.randrange(len(text))
            text = text[:rng.randrange(len(text))] + text[a:a + rng.choice([2, 3, 9, 10, 11, 40, 99, 100, 101])] + text
        rows.append((f"d{k % 50}", "".join(x + rng.choice([" ", " ", "\n", "  \t"]) for x in text)))
    return rows


def result(spark, rows, **options):
    frame = spark.createDataFrame([(i, t, 7, "x", 1) for i, t in rows], SCHEMA)
    return sorted((tuple(r) for r in repetition.quality_rules(frame, **options).select(COLUMNS).collect()), key=str)


def test_against_plain_version(spark):
    rows = corpus(3)
    assert result(spark, rows) == plain(rows)
    assert result(spark, rows, min_words=3, covered_percent=5, longest=9) == plain(rows, 3, 5, 9)


def test_empty_table(spark):
    assert result(spark, []) == []


def test_texts_of_one_array_do_not_meet(monkeypatch):
    rows = [(str(k), " ".join(f"w{j}" for j in range(60))) for k in range(5)]
    columns = repetition.measure([t.encode() for _, t in rows], 50, 3, 50, 10, 30, 100)
    assert columns[6].tolist() == [0] * 5 and columns[-1].all()


def test_long_texts():
    rng = np.random.default_rng(1)
    fresh = " ".join(map(str, rng.permutation(400_000))).encode()
    copied = b" ".join([fresh, fresh[:500]])
    periodic = b"round and round " * 100_000
    columns = repetition.measure([fresh, copied, periodic], 50, 3, 50, 10, 30, 100)
    tail = len(fresh[:500].split())
    assert columns[6].tolist()[0] == 0 and columns[6].tolist()[2] == 299_997
    assert columns[6].tolist()[1] in (tail, tail - 1)
    assert columns[-1].tolist() == [True, columns[6][1] <= 100, False]


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF_SMALL, "documents").collect() if len(r["text"] or "") < 6000]
    out = queries.op12_quality_rules(spark, SF_SMALL)
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_covered"]
    assert out.columns == columns
    ids, place = {i for i, _ in rows}, [COLUMNS.index(c) for c in columns]
    have = sorted((tuple(r) for r in out.collect() if r["doc_id"] in ids), key=str)
    assert have == sorted((tuple(r[k] for k in place) for r in plain(rows)), key=str)
    assert out.count() == table(spark, SF_SMALL, "documents").count()
