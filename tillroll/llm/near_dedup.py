"""Near-duplicate documents by SetSketch registers.

A document is the set of its word shingles. Each of ``m`` registers keeps the
smallest of the elements' exponentially distributed hashes, on a logarithmic
scale of base ``BASE`` and truncated to 16 bits; registers merge by maximum,
and two sets' registers are equal with a probability near their Jaccard
similarity. Documents that agree in all registers of a band meet.

Of the documents that meet, pairs are judged by the joint likelihood of their
registers and known sizes; those for which the wanted similarity isn't six
standard deviations off are verified on the full shingle sets. First every
document of a bucket is held against one of them. Once the links found have
been joined into components, only pairs across components are left, and all
of those are judged. Equal sets are one node from the start.

A pair that fails to meet or is judged away is not looked at again: the
registers are fixed. At similarity 0.75, with independent registers, no band
holds it with probability 2.5e-7 and judging loses it with at most 1.3e-8 (sum
over all register outcomes, sizes 1 : 1 to 3 : 4), so a link is missed with
at most 2.6e-7, and less the more similar the pair is.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.blocks import NULL_ID, ROW_BITS, arrays, ask, build_blocks, buckets_of, over_blocks, with_answers
from tillroll.llm.common import land, mix64, word_names
from tillroll.llm.components import components
from tillroll.llm.substring_dedup import CHECK, U, WORD, span_prints, words_of

SHINGLE, PERCENT = 5, 75
#: 40 bands of 4 registers: at similarity 0.75 a pair meets in none with probability (1 - 0.75^4)^40 = 2.5e-7.
BANDS, ROWS, BASE = 40, 4, 1.001
#: Largest register scale; a set's smallest exponential is at most about this.
SCALE = 64.0
#: Members of one bucket that are handled together; a larger bucket is split.
TILE = 4096
#: Pairs whose registers are compared at once.
JUDGED = 1 << 14
#: Bytes of shingle sets that one verification task should hold.
SET_BYTES = 32 << 20

_RNG = np.random.default_rng(20)
_A = _RNG.integers(1, 1 << 31, BANDS * ROWS).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_B = _RNG.integers(0, 1 << 32, BANDS * ROWS).astype(np.uint32)


def shingle_sets(text: bytes, sizes: np.ndarray, shingle: int, wanted: np.ndarray | None = None
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle fingerprints of the texts that lie end to end, sorted by document, and where each begins."""
    starts, ends, doc = words_of(text, sizes)
    word = word_names(np.frombuffer(text, np.uint8), starts, ends)
    edge = np.searchsorted(doc, np.arange(len(sizes) + 1))
    n = np.diff(edge)
    length = np.minimum(n, shingle)
    count = np.where(n > 0, n - length + 1, 0)
    if wanted is not None:
        count = np.where(wanted, count, 0)
    owner = np.repeat(np.arange(len(sizes)), count)
    at = np.repeat(edge[:-1] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
    print_ = span_prints(word, WORD, at, at + length[owner])
    order = np.lexsort((print_, owner))
    print_, owner = print_[order], owner[order]
    new = np.ones(len(owner), bool)
    new[1:] = (print_[1:] != print_[:-1]) | (owner[1:] != owner[:-1])
    print_, owner = print_[new], owner[new]
    return print_, np.searchsorted(owner, np.arange(len(sizes) + 1))


def registers(prints: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """SetSketch registers (documents x m, uint16) of non-empty sets."""
    begin = edge[:-1]
    h = (mix64(prints) >> U(32)).astype(np.uint32)
    out = np.empty((len(begin), len(_A)), np.uint32)
    for i in range(len(_A)):
        out[:, i] = np.minimum.reduceat(h * _A[i] + _B[i], begin)
    x = -np.log1p(-(out + 0.5) / 2.0 ** 32)  # the smallest of exponentials
    return np.clip(np.floor(1 - np.log(x / SCALE) / np.log(BASE)), 0, 65535).astype(np.uint16)


def merge_registers(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(a, b)


def plausible(one: np.ndarray, n_one: np.ndarray | float, many: np.ndarray, n_many: np.ndarray, percent: int = PERCENT,
              deviations: float = 6.0) -> np.ndarray:
    """Rows of ``many`` whose joint likelihood with ``one`` (one set's registers, or a set's for each row) doesn't
    rule the similarity ``percent`` out."""
    m = many.shape[1]
    j0 = percent / 100
    out = (many == one).sum(axis=1) >= m * max(0.0, j0 - 6 * np.sqrt(j0 * (1 - j0) / m))
    out &= 100 * np.minimum(n_one, n_many) >= percent * np.maximum(n_one, n_many)
    k = np.flatnonzero(out)
    if not len(k):
        return out
    one, n_one = np.broadcast_to(one, many.shape)[k], np.broadcast_to(n_one, n_many.shape)[k]
    more, less = (many[k] < one).sum(axis=1), (many[k] > one).sum(axis=1)
    u = n_one / (n_one + n_many[k])
    v = 1 - u

    def part(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j):
        p, q = part(u - v * j), part(v - u * j)
        e = 1e-12
        return (more * np.log(p + e) + less * np.log(q + e) + (m - more - less) * np.log(np.maximum(1 - p - q, e)))

    at = likelihood(j0)
    best = np.max([likelihood(np.full(len(k), j)) for j in np.linspace(0.3, j0, 19)], axis=0)
    out[k] = best - at <= deviations ** 2 / 2
    return out


def _sketch(shingle: int, digests: bool):
    def run(block: dict) -> list[tuple]:
        ids, sizes = arrays(block["ids"], block["sizes"])
        limit = np.concatenate([[0], np.cumsum(sizes)]).tolist()
        prints, edge = shingle_sets(block["text"].lower(), sizes, shingle)
        n = np.diff(edge)
        total = [np.concatenate([np.zeros(1, U), np.cumsum(mix64(prints ^ b))]) for b in (WORD, CHECK)]
        one, two = (mix64(t[edge[1:]] - t[edge[:-1]] + n.astype(U)).astype(np.int64) for t in total)
        full = np.flatnonzero(n)
        reg = registers(prints, np.append(edge[:-1][full], edge[-1])) if len(full) else np.zeros((0, len(_A)), np.uint16)
        band = reg.reshape(-1, BANDS, ROWS).astype(U)
        key = np.zeros(band.shape[:2], U)
        for r in range(ROWS):
            key = mix64(key * WORD + band[:, :, r] + U(1))
        key = mix64(key + np.arange(1, BANDS + 1, dtype=U) * CHECK).astype(np.int64)
        where = dict(zip(full.tolist(), range(len(full))))
        out = []
        for k, i in enumerate(ids.tolist()):
            w = where.get(k)
            out.append((None if i == NULL_ID else i, (block["block"] << ROW_BITS) | k, int(n[k]), int(one[k]), int(two[k]),
                        reg[w].tobytes() if w is not None else b"", key[w].tolist() if w is not None else [],
                        *[hashlib.sha256(block["text"][limit[k]:limit[k + 1]]).hexdigest()] * digests))
        return out

    return run


def _pairs(tiles: int, chunk_has_top: bool, percent: int):
    """Pairs of one chunk's buckets that must be verified, by verification bucket, and the sets that needs."""
    def run(rows: pd.DataFrame) -> list[tuple]:
        rows = rows.sort_values(["key", "tile", "node"], kind="stable")
        reg = np.frombuffer(b"".join(rows["reg"]), np.uint16).reshape(len(rows), -1)
        node, comp, n = (rows[c].to_numpy(np.int64) for c in ("node", "comp", "n"))
        key, tile, band = (rows[c].to_numpy(np.int64) for c in ("key", "tile", "band"))
        outlier, home = rows["outlier"].to_numpy(bool), rows["home"].to_numpy(np.int64)
        new = np.ones(len(rows), bool)
        new[1:] = (key[1:] != key[:-1]) | (tile[1:] != tile[:-1])
        cut = [*np.flatnonzero(new).tolist(), len(rows)]
        left, right = [], []
        word = reg.view(U)  # a band's four registers

        def judge(i: np.ndarray, j: np.ndarray) -> None:
            for at in range(0, len(i), JUDGED):
                x, y = i[at:at + JUDGED], j[at:at + JUDGED]
                # a pair that meets in several bands goes out from the first
                first = (word[x] == word[y]).argmax(axis=1) == band[x]
                x, y = x[first], y[first]
                if len(x):
                    likely = plausible(reg[x], n[x].astype(float), reg[y], n[y].astype(float), percent)
                    x, y = x[likely], y[likely]
                left.append(np.minimum(node[x], node[y]))
                right.append(np.maximum(node[x], node[y]))

        if not chunk_has_top:  # the first against the rest
            size = np.diff(cut)
            rest = np.arange(len(rows))
            i = np.repeat(cut[:-1], size)
            judge(i[rest != i], rest[rest != i])
        else:
            ones, others, waiting = [], [], 0
            for s, e in zip(cut[:-1], cut[1:]):
                if e - s < 2:
                    continue
                every = np.arange(s, e)
                for i in np.flatnonzero(outlier[s:e]) + s:
                    other = every[comp[s:e] != comp[i]]
                    # two outliers meet in every tile; the smaller one's home counts
                    twice = outlier[other]
                    low = np.where(node[other] < node[i], home[other], home[i])
                    other = other[~twice | ((low == tile[s]) & (other > i))]
                    ones.append(np.full(len(other), i))
                    others.append(other)
                    waiting += len(other)
                    if waiting >= JUDGED:
                        judge(np.concatenate(ones), np.concatenate(others))
                        ones, others, waiting = [], [], 0
            if waiting:
                judge(np.concatenate(ones), np.concatenate(others))
        if not left or not (total := sum(map(len, left))):
            return []
        a, b = np.concatenate(left), np.concatenate(right)
        ta, tb = (mix64(x.astype(U)) % U(tiles) for x in (a, b))
        bucket = (np.minimum(ta, tb) * U(tiles) + np.maximum(ta, tb)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        a, b, bucket = a[order], b[order], bucket[order]
        met, first = np.unique(bucket, return_index=True)
        out = []
        for k, s, e in zip(met.tolist(), first.tolist(), [*first[1:].tolist(), total]):
            out.append((k, -1, a[s:e].tobytes(), b[s:e].tobytes()))
            nodes = np.unique(np.concatenate([a[s:e], b[s:e]]))
            block = nodes >> ROW_BITS
            for x, part in zip(np.unique(block).tolist(),
                               np.split(nodes, np.unique(block, return_index=True)[1][1:])):
                out.append((k, x, (part & ((1 << ROW_BITS) - 1)).astype(np.int32).tobytes(), b""))
        return out

    return run


def _send_sets(shingle: int):
    def run(block: dict) -> list[tuple]:
        if not block["answers"]:
            return []
        _, sizes = arrays(block["ids"], block["sizes"])
        asked: dict[int, set] = {}
        for x in block["answers"]:
            asked.setdefault(x["bucket"], set()).update(np.frombuffer(x["a"], np.int32).tolist())
        wanted = np.zeros(len(sizes), bool)
        wanted[list(set().union(*asked.values()))] = True
        prints, edge = shingle_sets(block["text"].lower(), sizes, shingle, wanted)
        out = []
        for bucket, rows in asked.items():
            rows = sorted(rows)
            out.append((bucket, block["block"], (np.array(rows, np.int64) | (block["block"] << ROW_BITS)).tobytes(),
                        np.array([edge[r + 1] - edge[r] for r in rows], np.int64).tobytes(),
                        b"".join(prints[edge[r]:edge[r + 1]].tobytes() for r in rows)))
        return out

    return run


def _verify(percent: int):
    def run(rows: pd.DataFrame) -> list[tuple]:
        sets: dict[int, np.ndarray] = {}
        lefts, rights = [], []
        for block, a, b, prints in zip(rows["block"], rows["a"], rows["b"], rows["prints"]):
            if block < 0:
                lefts.append(np.frombuffer(a, np.int64))
                rights.append(np.frombuffer(b, np.int64))
                continue
            size = np.frombuffer(b, np.int64)
            for node, own in zip(np.frombuffer(a, np.int64).tolist(),
                                 np.split(np.frombuffer(prints, U), np.cumsum(size)[:-1])):
                sets[node] = own
        if not lefts:
            return []
        a, b = np.concatenate(lefts), np.concatenate(rights)
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
        met, first = np.unique(a, return_index=True)
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            return x

        for k, s, e in zip(met.tolist(), first.tolist(), [*first[1:].tolist(), len(a)]):
            own, others = sets[k], b[s:e].tolist()
            for at in range(0, len(others), 256):
                part = others[at:at + 256]
                size = np.array([len(sets[o]) for o in part])
                every = np.concatenate([sets[o] for o in part])
                hit = own[np.minimum(np.searchsorted(own, every), len(own) - 1)] == every
                both = np.add.reduceat(hit, np.cumsum(size) - size, dtype=np.int64)
                linked = 100 * both >= percent * (len(own) + size - both)
                for o in np.array(part)[linked].tolist():
                    x, y = find(k), find(o)
                    if x != y:
                        parent[max(x, y)] = min(x, y)
        # the links' components in this bucket, as a star each
        return [(find(x), x) for x in list(parent) if find(x) != x]

    return run


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
               percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id linked, over any steps), kept per row.

    A-Z count as a-z; words are runs without ASCII white space. A text of
    fewer than ``shingle`` words is one shingle; one without words, or null,
    is linked with nothing. Two rows are linked if their sets' intersection
    is at least ``percent`` of the union. Rows that share an id and are kept
    are all marked kept. A row with a null id has a null component_id, and is
    kept, unless it is linked with an id. Other columns aren't read; an
    empty table gives no rows. Ids are integers.
    """
    return _linked(docs, id_col, text_col, shingle, percent).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    percent: int = PERCENT) -> DataFrame:
    """doc_id, text_sha256 of one text of each component, as ``near_dedup`` links them.

    It has the smallest id, a null one only where no row has an id, and of
    those texts the smallest digest. A null text counts as empty; each text
    without words is a component of its own.
    """
    rows = _linked(docs, id_col, text_col, shingle, percent, digests=True)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "digest")).alias("first")
    return rows.groupBy("comp").agg(first).select(
        "first.doc_id", F.col("first.digest").alias("text_sha256")).distinct()


def _linked(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, digests: bool = False
            ) -> DataFrame:
    """doc_id, n, comp (a node of the component), component_id and, if asked for, the text's digest per row."""
    own = ["digest"] * digests
    blocks = build_blocks(docs, id_col, text_col, "near")
    chunks = buckets_of(docs)
    sketches = land(over_blocks(blocks, _sketch(shingle, digests),
                                "doc_id long, node long, n long, one long, two long, reg binary, bands array<long>"
                                + ", digest string" * digests),
                    "sketches")
    classes = land(sketches.where("n > 0").groupBy("one", "two", "n").agg(
        F.min("node").alias("node"), F.min("doc_id").alias("first_id")), "classes")
    nodes = sketches.select("node", "n", "reg", "bands").join(classes.select("node"), "node")
    met = land(nodes.select("node", "n", F.posexplode("bands").alias("band", "key")), "bands")
    many = met.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    members = land(met.join(many, "key"), "members")
    regs = land(sketches.select("node", "n", "reg").join(members.select("node").distinct(), "node"), "registers")

    links = None
    for last in (False, True):
        if links is None:
            now = members.withColumn("comp", F.col("node"))
        else:
            label = components(links)
            now = members.join(label, "node", "left").withColumn("comp", F.coalesce("label", "node")).drop("label")
        parts = F.ceil(F.col("size") / TILE).cast("int")
        home = F.pmod(F.xxhash64("node", "key"), parts.cast("long"))
        if last:
            now = land(now, "members")
            per = now.groupBy("key", "comp").agg(F.count("*").alias("of")).groupBy("key").agg(
                F.max_by("comp", F.struct("of", "comp")).alias("top"), F.count("*").alias("comps")).where("comps > 1")
            # the largest component's members stay in their tile, the others go to all
            now = now.join(per, "key").withColumn("outlier", F.col("comp") != F.col("top")).withColumn("home", home)
            now = now.withColumn("tile", F.explode(F.when(F.col("outlier"), F.sequence(F.lit(0), parts - 1)).otherwise(
                F.array(F.col("home").cast("int")))))
        else:
            now = now.withColumn("outlier", F.lit(True)).withColumn("home", home).withColumn("tile", home)
        asked = now.join(regs, ["node", "n"]).select(
            F.pmod(F.xxhash64("key", "tile"), F.lit(chunks)).alias("bucket"), F.lit(0).alias("block"), "key",
            F.col("tile").cast("long").alias("tile"), "node", "n", "comp", "outlier", "home", F.col("band").cast("long").alias("band"), "reg")
        held = regs.agg(F.sum("n")).first()[0] or 0
        tiles = max(4, -(-16 * held // SET_BYTES))
        pairs = land(ask(asked, _pairs(tiles, last, percent), "bucket long, block long, a binary, b binary"), "pairs")
        sets = over_blocks(with_answers(blocks, pairs.where("block >= 0").select("block", "bucket", "a")),
                           _send_sets(shingle), "bucket long, block long, a binary, b binary, prints binary")
        found = land(ask(pairs.where("block < 0").withColumn("prints", F.lit(b"")).unionByName(sets),
                         _verify(percent), "a long, b long"), "links")
        links = found if links is None else links.unionByName(found)
    label = components(links)
    whole = classes.join(label, "node", "left").withColumn("comp", F.coalesce("label", "node"))
    lowest = whole.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    whole = whole.join(lowest, "comp").select("one", "two", "n", "comp", "component_id")
    return (sketches.where("n > 0").select("doc_id", "n", "one", "two", *own).join(whole, ["one", "two", "n"])
            .select("doc_id", "n", "comp", "component_id", *own)
            .unionByName(sketches.where("n = 0").select("doc_id", "n", F.col("node").alias("comp"),
                                                        F.col("doc_id").alias("component_id"), *own)))
