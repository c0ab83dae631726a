import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import common, exact_dedup, near_dedup, substring_dedup, suffix_dedup
from tests.llm import brute

SCHEMA = "doc_id long, text string, block long, digest string, n int, label string"


def frame(spark, rows, partitions=3):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, 1, "x", 2, "y") for i, t in rows], SCHEMA).repartition(partitions)


def got(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def corpus(seed, docs=60, vocabulary=30):
    """Small vocabulary, shared passages, runs, copies, short and empty texts, ties and repeats."""
    rng = random.Random(seed)
    word = lambda: rng.choice("ab cd Ef gh é ñandú the of x1 zz".split()) + str(rng.randrange(vocabulary))
    passages = [[word() for _ in range(rng.randrange(20, 70))] for _ in range(4)]
    rows = []
    for i in range(docs):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            kind = rng.randrange(6)
            if kind < 2:
                parts += rng.choice(passages)[rng.randrange(5):]
            elif kind == 2:
                parts += [word()] * rng.randrange(1, 60)
            elif kind == 3:
                parts += [word(), word()] * rng.randrange(1, 40)
            else:
                parts += [word() for _ in range(rng.randrange(1, 60))]
        sep = rng.choice([" ", "\n", " \t", "\xa0", "\x0b"])
        rows.append((rng.randrange(10**6), sep.join(parts)))
    rows += [(10**6 + k, rows[k][1]) for k in range(8)]
    return rows + [(2 * 10**6, None), (2 * 10**6 + 1, ""), (2 * 10**6 + 2, "   \n"), (2 * 10**6 + 3, "one"),
                   (2 * 10**6 + 4, "One"), (2 * 10**6 + 5, None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_substring(spark, seed):
    rows = corpus(seed)
    df = substring_dedup.substring_dedup(frame(spark, rows))
    assert got(df, "doc_id", "n_words", substring_dedup.removed_words(), F.sha2("kept", 256)) == brute.substring(rows)


def test_substring_three_rounds_and_long_windows(spark):
    rows = corpus(5)
    df = substring_dedup.substring_dedup(frame(spark, rows), window=30, rounds=3)
    assert got(df, "doc_id", "n_words", substring_dedup.removed_words(), F.sha2("kept", 256)) == brute.substring(rows, 30)


def test_substring_repeated_ids_keep_one_copy(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(7, text), (7, text), (None, text), (None, "short"), (3, "other")]
    out = substring_dedup.substring_dedup(frame(spark, rows)).collect()
    assert sorted(len(r["kept"].split()) for r in out) == [0, 0, 1, 1, 40]
    assert sum(r["doc_id"] is None for r in out) == 2
    assert next(r for r in out if r["doc_id"] is None and r["n_words"] == 40)["kept"] == ""


def test_parse_is_the_same_in_other_company():
    """Windows with one content have one anchor, whatever stands around them."""
    rng = random.Random(3)
    core = [f"k{rng.randrange(40)}" for _ in range(20)]
    anchors = set()
    for _ in range(200):
        around = [f"k{rng.randrange(40)}" for _ in range(40)]
        words = around[:rng.randrange(20)] + core + around[20:20 + rng.randrange(20)]
        at = next(i for i in range(len(words)) if words[i:i + 20] == core)
        text = " ".join(words).encode()
        p = substring_dedup.Parse(text, np.array([len(text)]), 20, 2)
        k = int(np.flatnonzero(p.at == at)[0])
        anchors.add((bool(p.sure[k]), int(p.anchor[k])))
    assert len(anchors) == 1


@pytest.mark.parametrize("seed,hot", [(1, 256), (2, 0)])
def test_suffix(spark, seed, hot):
    rows = corpus(seed, docs=40)
    df = suffix_dedup.suffix_dedup(frame(spark, rows, 5), hot_blocks=hot)
    assert got(df, "doc_id", "n_bytes", substring_dedup.removed_words(), F.floor(F.size("spans") / 2),
               F.sha2("kept", 256)) == brute.suffix(rows)


def factors(text, at, depth):
    """LPF by comparing every start with every earlier one."""
    def common(i, j):
        return next((k for k in range(min(depth, len(text) - i)) if text[i + k] != text[j + k]), min(depth, len(text) - i))
    return [max([0, *(common(i, j) for j in at if j < i)]) for i in at]


def test_previous_factor_array(monkeypatch):
    rng = random.Random(4)
    for turn in range(60):
        monkeypatch.setattr(suffix_dedup, "JUMPS", turn % 3 * 8)
        t = bytes(rng.choice(b"ab\0" if turn % 2 else b"abc") for _ in range(rng.randrange(1, 80)))
        if turn % 5 == 0:
            t = b"abc" * (len(t) // 3 + 1) + t[:5]
        a = np.frombuffer(t, np.uint8)
        if 0 not in t:
            whole = np.arange(len(t))
            assert suffix_dedup.previous_factor_array(a, whole, len(t)).tolist() == factors(t, whole.tolist(), len(t))
        depth = rng.randrange(1, len(t) + 1)
        some = np.array(sorted(rng.sample(range(len(t)), rng.randrange(1, len(t) + 1))))
        some = some[some <= len(t) - depth]
        assert suffix_dedup.previous_factor_array(a, some, depth).tolist() == factors(t, some.tolist(), depth)


def test_previous_factors_of_long_ascents_take_linear_time():
    n = 60_000  # ascents that a jump at a time would walk again and again
    place = np.concatenate([np.arange(1, n) * 2, np.arange(n)[::-1] * 2 + 1, [0]])
    common = np.ones(len(place), np.int64)
    common[0] = 0
    begin = time.perf_counter()
    factor = suffix_dedup.previous_factors(place, common, 100)
    assert time.perf_counter() - begin < 5
    assert (factor == (place > 0)).all()


def test_stretches_with_equal_digests_are_compared():
    text = b"abcabdabc"
    same = np.zeros(3, np.uint64)
    begin = np.array([0, 3, 6])
    order = np.arange(3)
    assert suffix_dedup.later_stretches(same, same, order, text, begin, begin + 3).tolist() == [False, False, False]
    assert suffix_dedup.later_stretches(same, same, np.array([0, 2, 1]), text, begin, begin + 3).tolist() == [False, False, True]


def test_suffix_ranks_follow_suffix_order():
    rng = np.random.default_rng(1)
    t = rng.integers(97, 99, 300).astype(np.uint8)
    at = np.arange(200)
    ranks = suffix_dedup.suffix_ranks(t, 100, at)
    keys = [t[i:i + 100].tobytes() for i in at]
    assert [r for _, r in sorted(zip(keys, ranks.tolist()))] == sorted(ranks.tolist())
    assert all((keys[i] == keys[j]) == (ranks[i] == ranks[j]) for i in at for j in at[:20])


@pytest.mark.parametrize("share,salts", [(1e-4, 64), (0.9, 3)])
def test_exact(spark, share, salts):
    rows = corpus(1) + [(5, "hot copy")] * 3 + [(100 + k, "hot copy") for k in range(200)] + [
        (None, "hot copy"), (None, "only null ids"), (None, "only null ids")]
    df = exact_dedup.exact_dedup(frame(spark, rows), hot_share=share, salts=salts)
    assert got(df, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute.exact(rows)


def edits(seed):
    """Groups of near copies around the threshold."""
    rng = random.Random(seed)
    rows = []
    for g in range(6):
        base = [f"g{g}w{rng.randrange(200)}" for _ in range(rng.choice([3, 8, 30, 80, 200]))]
        for _ in range(14):
            own = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 20 + 1)):
                own[rng.randrange(len(own))] = rng.choice(["NEW", f"x{rng.randrange(99)}"])
            rows.append((rng.randrange(10**6), rng.choice([" ", "\n"]).join(own)))
    return rows + [(10**6, rows[0][1].upper()), (10**6 + 1, None), (10**6 + 2, ""), (10**6 + 3, None)]


@pytest.mark.parametrize("tile", [4096, 8])
def test_near(spark, monkeypatch, tile):
    monkeypatch.setattr(near_dedup, "TILE", tile)
    rows = edits(tile)
    df = near_dedup.near_dedup(frame(spark, rows))
    assert got(df, "doc_id", "n_shingles", "component_id", "kept") == brute.near(rows)


def test_near_null_and_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(9, text), (9, text), (None, text), (4, text + " more"), (None, "alone it stands here now"), (2, None)]
    out = got(near_dedup.near_dedup(frame(spark, rows)), "doc_id", "component_id", "kept")
    assert out == sorted([(9, 4, False)] * 2 + [(None, 4, False), (4, 4, True), (None, None, True), (2, 2, True)], key=str)


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 2**63, 400).astype(np.uint64), rng.integers(0, 2**63, 300).astype(np.uint64)
    reg = lambda x: near_dedup.registers(x, np.array([0, len(x)]))[0]
    assert (near_dedup.merge_registers(reg(a), reg(b)) == reg(np.concatenate([a, b]))).all()
    same, other = reg(np.concatenate([a[:350], b[:40]])), reg(np.concatenate([a[:150], b[:240]]))
    assert near_dedup.plausible(reg(a), 400, np.stack([same, other]), np.array([390.0, 390.0])).tolist() == [True, False]


@pytest.mark.parametrize("share", [1.0, 0.9, 0.8, 0.75])
def test_judging_loses_a_link_less_often_than_the_bands(share):
    """Over every outcome of the registers of two sets, sizes 1 : share, at the threshold itself."""
    m, j = near_dedup.BANDS * near_dedup.ROWS, near_dedup.PERCENT / 100
    u, v = 1 / (1 + share), share / (1 + share)
    part = lambda x: -np.log1p(-max(0.0, x) * (near_dedup.BASE - 1) / near_dedup.BASE) / np.log(near_dedup.BASE)
    p, q = part(u - v * j), part(v - u * j)
    log = np.concatenate([[0], np.cumsum(np.log(np.arange(1, m + 1)))])  # of factorials
    equal, more = (x.ravel() for x in np.mgrid[0:m + 1, 0:m + 1])
    less = m - equal - more
    equal, more, less = (x[less >= 0] for x in (equal, more, less))
    with np.errstate(divide="ignore", invalid="ignore"):
        terms = [np.where(k > 0, k * np.log(x), 0) for k, x in ((equal, 1 - p - q), (more, p), (less, q))]
    chance = np.exp(log[m] - log[equal] - log[more] - log[less] + sum(terms))
    assert chance.sum() == pytest.approx(1)
    at = np.arange(m)
    many = np.where(at < equal[:, None], 100, np.where(at < (equal + more)[:, None], 99, 101)).astype(np.uint16)
    kept = near_dedup.plausible(np.full(m, 100, np.uint16), 1e6, many, np.full(len(many), share * 1e6))
    assert chance[~kept].sum() < 2e-8


@pytest.mark.parametrize("operator", [substring_dedup.substring_dedup, suffix_dedup.suffix_dedup,
                                      exact_dedup.exact_dedup, near_dedup.near_dedup])
def test_empty_tables_and_long_text(spark, operator):
    assert operator(frame(spark, [])).count() == 0
    long = " ".join(f"w{i % 5000}" for i in range(60_000))
    assert operator(frame(spark, [(1, long), (2, None), (3, "")], 1)).count() == 3


def thue_morse(n, zero, one):
    """zero and one in the order that makes sums with powers of any odd number vanish modulo 2^64."""
    return [one if bin(k).count("1") % 2 else zero for k in range(n)]


def structured_pairs():
    """Unequal texts that polynomials modulo 2^64 can't tell apart: bytes, one long word, and words."""
    rng = random.Random(12)
    mine, other = [], []
    for t in thue_morse(1024, 0, 1):
        a, b = rng.sample("abcdefghijklmnopqrstuvwxyz", 2)
        mine.append(a if t else chr(ord(a) + (1 if a != "z" else -1)))
        other.append(chr(ord(a) + (1 if a != "z" else -1)) if t else a)
    ab, ba = thue_morse(2048, "a", "b"), thue_morse(2048, "b", "a")
    head = " ".join(f"w{k}" for k in range(19))
    return [(1, "".join(thue_morse(1024, "a", "b"))), (2, "".join(thue_morse(1024, "b", "a"))),
            (3, f"{head} {''.join(ab[:1024])}"), (4, f"{head} {''.join(ba[:1024])}"),
            (5, " ".join(ab)), (6, " ".join(ba)), (7, "".join(mine)), (8, "".join(other)),
            (9, " ".join(x + "x" for x in ab[:1024])), (10, " ".join(x + "x" for x in ba[:1024]))]


def test_structured_texts(spark):
    rows = structured_pairs()
    assert got(substring_dedup.substring_dedup(frame(spark, rows)).select(
        "doc_id", "n_words", substring_dedup.removed_words().alias("r"), F.sha2("kept", 256).alias("s")),
        "doc_id", "n_words", "r", "s") == brute.substring(rows)
    assert got(suffix_dedup.suffix_dedup(frame(spark, rows)).select(
        "doc_id", "n_bytes", substring_dedup.removed_words().alias("r"), F.floor(F.size("spans") / 2).alias("n"), F.sha2("kept", 256).alias("s")),
        "doc_id", "n_bytes", "r", "n", "s") == brute.suffix(rows)
    assert got(near_dedup.near_dedup(frame(spark, rows)), "doc_id", "n_shingles", "component_id", "kept") == brute.near(rows)


def test_window_prints_tell_windows_apart():
    values = np.array([b for t in structured_pairs() for b in t[1].encode()], np.uint64)
    for width in (1, 2, 3, 8, 9, 20, 31, 100, 127, 128):
        prints = common.window_prints(values, width, np.uint64(7))
        windows = {}
        for k, p in enumerate(prints.tolist()):
            windows.setdefault(p, set()).add(values[k:k + width].tobytes())
        assert len(prints) == len(values) - width + 1
        assert all(len(w) == 1 for w in windows.values())
        assert len(windows) == len({values[k:k + width].tobytes() for k in range(len(prints))})
    assert len(common.window_prints(values[:5].astype(np.uint64), 20, np.uint64(1))) == 0
