"""Quality and toxicity scores against plain versions, and the columns of their queries."""
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.conftest import SF_SMALL
from tests.llm.test_dedup import frame
from tillroll.llm import quality, queries, toxicity
from tillroll.llm.common import mix64

EDGES = [(900, None), (901, ""), (902, " \n "), (903, "é"), (None, "idiot clown"), (904, "x " * 3000), (904, "one")]


def hashed(start, values):
    h = np.array([start], np.uint64)
    for v in values:
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + np.uint64(v))
    return int(h[0] >> np.uint64(64 - quality.BITS))


def plain_features(text):
    """Count of every word 1-2-gram and class 1-4-gram, one at a time."""
    tokens = quality.TOKEN.findall((text or "").encode())
    words = [zlib.crc32(t) for t in tokens]
    kinds = [quality.token_class(t) + ((1 << 20) if i > 0 and tokens[i - 1] == t else 0)
             + ((1 << 21) if i > 1 and tokens[i - 2] == t else 0) for i, t in enumerate(tokens)]
    return Counter(hashed(tag, seq[i:i + n]) for seq, tag, most in ((words, 1, 2), (kinds, 2, 4))
                   for n in range(1, most + 1) for i in range(len(seq) - n + 1))


def plain_score(text, weights):
    found = plain_features(text)
    total = sum(found.values())
    margin = float(weights[-1]) + sum(quality.SCALE * n / total * float(weights[k]) for k, n in found.items())
    return 1 / (1 + math.exp(-max(-35, min(35, margin))))


def plain_ftrl(examples, bits):
    """FTRL-proximal, one weight at a time."""
    z, n = Counter(), Counter()

    def weight(i):
        if abs(z[i]) <= quality.L1:
            return 0.0
        return -(z[i] - math.copysign(quality.L1, z[i])) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)

    order = np.random.default_rng(7)
    for _ in range(quality.EPOCHS):
        for k in order.permutation(len(examples)):
            index, value, label = examples[k]
            x = {**dict(zip(index.tolist(), value.tolist())), 1 << bits: 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-max(-35, min(35, sum(w[i] * v for i, v in x.items())))))
            for i, v in x.items():
                g = (p - label) * v
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA * w[i]
                n[i] += g * g
    return {i: weight(i) for i in z}


def texts(seed, n=60):
    rng = random.Random(seed)
    words = ["Good", "news", "bad", "1999", "!!", "BUY", "now", "\n", "naïve", "the", "the", "x1y"]
    return [(i, " ".join(rng.choices(words, k=rng.randrange(1, 50)))) for i in range(n)]


def test_ftrl_against_plain_version():
    codes = quality.Codes()
    examples = [(*quality.features(t.encode(), codes, quality.BITS), float(i % 3 == 0)) for i, t in texts(1)]
    for (index, value, _), (_, text) in zip(examples, texts(1)):
        plain = plain_features(text)
        total = sum(plain.values())
        assert dict(zip(index.tolist(), value.tolist())) == pytest.approx({k: quality.SCALE * c / total for k, c in plain.items()})
    weights = quality.ftrl(examples, quality.BITS)
    want = plain_ftrl(examples, quality.BITS)
    assert set(np.flatnonzero(weights).tolist()) <= set(want)
    assert [float(weights[i]) for i in want] == pytest.approx(list(want.values()), abs=1e-4)


def test_quality_scores_against_plain_version(spark):
    rows = texts(2) + EDGES
    weights = np.random.default_rng(3).normal(0, 0.2, (1 << quality.BITS) + 1).astype(np.float32)
    out = quality.score(frame(spark, rows), weights, threshold=0.3).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted(((r["doc_id"], r["score"]) for r in out), key=key)
    want = sorted(((i, plain_score(t, weights)) for i, t in rows), key=key)
    assert [i for i, _ in got] == [i for i, _ in want]
    assert [s for _, s in got] == pytest.approx([s for _, s in want], abs=1e-6)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in out)


def plain_weight(folded, lexicon):
    """At each place the longest entry, unless a harmless phrase lies over where it starts."""
    quiet = [(s, s + len(p)) for p in map(toxicity.fold, lexicon.exceptions) for s in range(len(folded)) if folded.startswith(p, s)]
    total = 0.0
    for s in range(len(folded)):
        found = [e for e in lexicon.weights if folded.startswith(e, s)]
        if found and not any(a <= s < b - 1 for a, b in quiet):
            total += max(0.0, lexicon.weights[max(found, key=len)])
    return total


def test_toxicity_scores_against_plain_version(spark):
    lexicon = toxicity.Lexicon({" idi": 2.0, " idiot ": 3.5, " clown": 1.7, " clown f": -1.0, " trash": 2.2, " idioms ": -2.0, " scum ": 4.0},
                               logistic=(-2.0, 0.9, 0.4, -0.1))
    rng = random.Random(5)
    words = ["idiot", "Idioms", "1d1ot", "іdіоt", "clown", "fish", "trash", "can", "tr4sh", "pond", "scum", "fine", "day", "8", "ＩＤＩＯＴ"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 30)))) for i in range(80)] + EDGES
    out = toxicity.score(frame(spark, rows), lexicon).collect()
    got = Counter((r["doc_id"], r["n_words"], round(r["weight"], 9), round(r["score"], 9), r["predicted"]) for r in out)
    want = Counter()
    for i, t in rows:
        folded = toxicity.fold(t or "")
        w, n = plain_weight(folded, lexicon), len(folded.split())
        m = max(1, n)
        margin = -2.0 + 0.9 * math.log(1 + w) + 0.4 * math.log(1 + 100 * w / m) - 0.1 * math.log(m)
        s = 1 / (1 + math.exp(-margin))
        want[i, n, round(w, 9), round(s, 9), int(s >= 0.5)] += 1
    assert got == want


@pytest.mark.parametrize("text,folded", [
    ("1d1ot", " idiot "), ("іdіоt", " idiot "), ("ＩＤＩＯＴ!", " idiot "), ("tr4sh-can", " trash can "), ("in 1999, 8 of", " in 1999 8 of "),
    ("a$$hat", " asshat "), ("", "  ")])
def test_folding(text, folded):
    assert toxicity.fold(text) == folded


@pytest.mark.parametrize("query,threshold", [("op5_quality", 0.3), ("op8_toxicity", 0.5)])
def test_queries_score_every_document(spark, query, threshold):
    ids = [r[0] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id").collect()]
    df = queries.queries()[query](spark, SF_SMALL)
    assert dict(df.select("doc_id", "held_out", "score", "predicted").dtypes) == {
        "doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    out = df.collect()
    assert sorted(r["doc_id"] for r in out) == sorted(ids)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= threshold) for r in out)
