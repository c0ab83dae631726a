"""Vector codes against a plain version."""

import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tillroll.llm import queries, vector_codes
from tillroll.llm.common import table

SCHEMA = "vec_id long, embedding array<double>, label int, id string, v string, of int, code int, vector int, error long"


def plain(rows, parts, entries, rounds, scale=256):
    """rows: (id, label, vector); the vectors' codes, errors and all entries."""
    kept = [(i, l, [math.floor(scale * x) for x in v]) for i, l, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    w = len(kept[0][2]) // parts
    cut = [[v[p * w:(p + 1) * w] for p in range(parts)] for _, _, v in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            at = [nearest(p, c[p])[1] for c in cut]
            for k in range(len(books[p])):
                own = [c[p] for c, a in zip(cut, at) if a == k]
                if own:
                    books[p][k] = [sum(col) // len(own) for col in zip(*own)]
    found = [[nearest(p, c[p]) for p in range(parts)] for c in cut]
    error = [sum(d for d, _ in f) for f in found]
    total = {}
    for (_, l, _), e in zip(kept, error):
        total[l] = total.get(l, 0) + e
    flat = ",".join(str(x) for b in books for e in b for x in e)
    return sorted(((i, "".join(f"{k:02x}" for _, k in f), e, total[l], hashlib.sha256(flat.encode()).hexdigest())
                   for (i, l, _), f, e in zip(kept, found, error)), key=str)


def result(frame, **options):
    coded, books = vector_codes.encode(frame, **options)
    out = vector_codes.with_label_error(coded).select("id", F.lower(F.hex("code")).alias("code"), "error", "label_error").collect()
    return sorted(((*r, books.digest()) for r in out), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, l, "x", "y", 1, 2, 3, 4) for i, l, v in rows], SCHEMA)


def sample(n, d, seed, grid):
    """Few distinct values, so ties, equal entries and unused entries occur."""
    rng = random.Random(seed)
    return [(rng.choice([None, k, k, k, k // 2]), rng.choice([None, 1, 1, 2]), [rng.choice(grid) for _ in range(d)]) for k in range(n)]


def test_against_plain_version(spark):
    odd = [(5, 1, None), (6, 1, [1.0, None] * 8), (7, None, [float("nan")] * 16), (8, 2, [float("inf")] * 16)]
    for seed, grid in ((1, [-0.01, 0.0, 0.004]), (2, [k / 97 for k in range(-97, 98)]), (3, [0.5]), (4, [1e5, -7.3, 0.0])):
        rows = sample(150, 16, seed, grid) + odd
        rows += rows[:20]
        assert result(frame(spark, rows), parts=4, entries=8, rounds=2) == plain(rows, 4, 8, 2)


def test_fewer_vectors_than_entries_and_other_lengths(spark):
    rows = sample(5, 16, 9, [0.0, 0.3])
    assert result(frame(spark, rows), parts=16, entries=64) == plain(rows, 16, 64, 2)
    coded, books = vector_codes.encode(frame(spark, [*rows, (99, 1, [0.1] * 7), (98, 1, [])]), parts=16)
    assert {r["id"]: r["code"] for r in coded.collect() if r["id"] in (98, 99)} == {98: None, 99: None}
    assert books.parts == 16 and books.size == 5


def test_empty_and_unusable_tables(spark):
    for rows in ([], [(1, 1, None)], [(1, 1, [float("nan")] * 16)]):
        coded, books = vector_codes.encode(frame(spark, rows))
        assert books is None and vector_codes.with_label_error(coded).count() == 0


def test_far_components_saturate(spark):
    rows = [(k, 1, [1e30 * (-1) ** k] * 16) for k in range(4)]
    coded, books = vector_codes.encode(frame(spark, rows), parts=4, entries=2)
    assert [r["error"] for r in coded.collect()] == [0] * 4
    assert abs(books.entries).max() == vector_codes.largest(16)


def test_label_totals_beyond_the_broadcast(spark, monkeypatch):
    rows = sample(60, 16, 4, [0.1, 0.2, 0.3])
    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", 0)
    assert result(frame(spark, rows), parts=4, entries=8) == plain(rows, 4, 8, 2)


def test_pruning_leaves_most_comparisons_out():
    rng = np.random.default_rng(3)
    centres = rng.integers(-10_000, 10_000, (64, 4))
    points = centres[rng.integers(0, 64, 4000)] + rng.integers(-40, 40, (4000, 4))
    books = vector_codes.Codebooks(centres[None])
    all_distances = ((points[:, None] - centres[None]) ** 2).sum(-1)
    best, distance = books.assign(points, np.zeros(4000, np.int64))
    assert (best == all_distances.argmin(1)).all() and (distance == all_distances.min(1)).all()
    assert books.rings(best, distance).mean() < 1


def test_query(spark):
    rows = [(r["vec_id"], r["label"], r["embedding"]) for r in table(spark, SF_SMALL, "embeddings").collect()]
    out = queries.op13_vector_codes(spark, SF_SMALL)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, out.collect()), key=str) == plain(rows, 16, 64, 2)
