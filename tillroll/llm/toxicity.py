"""Toxicity by a weighted lexicon matched with an Aho-Corasick automaton.

Texts are folded first: lower case, homoglyphs to the letters they pass for,
digits and signs inside words to the letters they stand for. The lexicon
holds word beginnings and whole words, each weighted with its log odds in
labelled rows; of the entries that match one word the longest decides, so a
longer harmless form is an exception to a shorter toxic one. Exception
phrases silence every match inside them. The sum of weights is normalised by
the text's length and goes through a logistic function fitted on the same
rows.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import land, map_batches, utf8

#: Lexicon and logistic function are fitted on at most so many labelled rows (smallest hash of doc_id).
MAX_TRAIN_ROWS = 10_000
MIN_DOCS, MIN_WEIGHT = 4, 1.6
SHORTEST, LONGEST = 3, 10

# Characters that pass for Latin letters.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "к": "k",
    "м": "m", "т": "t", "н": "h", "в": "b", "ԁ": "d", "ӏ": "l", "α": "a", "ο": "o", "ι": "i", "ν": "v", "κ": "k",
    "τ": "t", "ρ": "p", "υ": "u", "ε": "e", "ı": "i", "ⅼ": "l", "ո": "n", "ս": "u",
}
# Digits and signs that stand for letters inside words.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
# Harmless phrases.
EXCEPTIONS = ("clown fish", "clown car", "class clown", "trash can", "trash bin", "sore loser", "pond scum")

_FULL_WIDTH = {chr(0xFF21 + i): chr(97 + i) for i in range(26)} | {chr(0xFF41 + i): chr(97 + i) for i in range(26)}
_GLYPHS = str.maketrans(HOMOGLYPHS | _FULL_WIDTH)
_GLYPH = re.compile("[" + "".join(HOMOGLYPHS | _FULL_WIDTH) + "]")
_SIGNS = "".join(SUBSTITUTES)
_DISGUISED = re.compile(rf"[^\W\d_]+[{re.escape(_SIGNS)}]+(?=[^\W\d_])|(?<![\w])[{re.escape(_SIGNS)}]+(?=[^\W\d_])")
_SIGN = str.maketrans(SUBSTITUTES)
_BETWEEN = re.compile(r"[\W_]+")


def fold(text: str) -> str:
    """The text's words in folded form, each between single spaces."""
    text = text.lower()
    if _GLYPH.search(text):
        text = text.translate(_GLYPHS)
    text = _DISGUISED.sub(lambda m: m[0].translate(_SIGN), text)
    return " " + _BETWEEN.sub(" ", text).strip() + " "


def entries_of(folded: str) -> set[str]:
    """Every lexicon entry that could match: word beginnings (" abc") and whole words (" abc ")."""
    out = set()
    for word in set(folded.split()):
        n = len(word)
        out.add(f" {word} ")
        for k in range(SHORTEST, min(n, LONGEST) + 1):
            out.add(" " + word[:k])
    return out


@dataclass
class Lexicon:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    #: intercept, log of summed weight, log of weight per 100 words, log of length
    logistic: tuple[float, ...] = (-4.0, 1.0, 1.0, 0.0)

    def automaton(self):
        a = ahocorasick.Automaton()
        for e, w in self.weights.items():
            a.add_word(e, (len(e), w))
        for phrase in self.exceptions:
            a.add_word(e := fold(phrase), (len(e), None))
        if len(a):
            a.make_automaton()
        return a


def matched_weight(folded: str, automaton) -> float:
    """Sum of the deciding entries' weights over the words."""
    if not len(automaton):
        return 0.0
    at: dict[int, tuple[int, float]] = {}
    quiet: list[tuple[int, int]] = []
    for end, (size, weight) in automaton.iter(folded):
        start = end - size + 1
        if weight is None:
            quiet.append((start, end))
        elif start not in at or size > at[start][0]:
            at[start] = (size, weight)
    quiet.sort()
    begins, reach = [a for a, _ in quiet], list(accumulate((b for _, b in quiet), max))

    def silenced(s: int) -> bool:
        k = bisect_right(begins, s) - 1
        return k >= 0 and reach[k] > s

    return sum(max(0.0, w) for s, (_, w) in at.items() if not silenced(s))


def measures(weight: float, words: int) -> tuple[float, float, float, float]:
    n = max(1, words)
    return 1.0, float(np.log1p(weight)), float(np.log1p(100 * weight / n)), float(np.log(n))


def logistic_fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, ...]:
    """Coefficients of a logistic regression; the first column of ``x`` is 1.

    Newton steps on standardised columns with a small ridge, each halved
    until it lowers the loss: the measures hang together closely, and whole
    steps may swing instead of settling.
    """
    middle, spread = x[:, 1:].mean(axis=0), x[:, 1:].std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x[:, 1:] - middle) / spread])

    def loss(b: np.ndarray) -> float:
        margin = z @ b
        return float(np.logaddexp(0, margin).sum() - y @ margin + ridge * b @ b / 2)

    b = np.zeros(z.shape[1])
    now = loss(b)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(b))
        step, size = np.linalg.solve(h, z.T @ (y - p) - ridge * b), 1.0
        while size > 1e-6 and loss(b + size * step) > now:
            size /= 2
        b = b + size * step
        before, now = now, loss(b)
        if before - now < 1e-9:
            break
    w = b[1:] / spread
    return float(b[0] - w @ middle), *map(float, w)


def choose_entries(found: list[tuple[str, int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Weighted lexicon from (entry, toxic rows with it, clean rows with it).

    A longer entry is kept only where its weight differs from that of the
    entry it would overrule.
    """
    out: dict[str, float] = {}
    for entry, t, c in sorted(found, key=lambda r: (len(r[0]), r[0])):
        weight = float(np.log((t + 0.5) / (toxic + 1)) - np.log((c + 0.5) / (clean + 1)))
        above = next((out[entry[:k]] for k in range(len(entry) - 1, SHORTEST, -1) if entry[:k] in out), None)
        if above is None:
            if t >= MIN_DOCS and weight >= MIN_WEIGHT:
                out[entry] = weight
        elif t + c >= MIN_DOCS and abs(weight - above) > 0.7:
            out[entry] = weight
    return out


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
        text_col: str = "text", max_rows: int = MAX_TRAIN_ROWS) -> Lexicon:
    """Lexicon and logistic function from at most ``max_rows`` labelled rows.

    Rows with a null id or label are left out; of an id labelled more than
    once the largest label counts. Without toxic rows the lexicon is empty
    and every score low. Every entry that two toxic rows hold is looked at, so
    ``max_rows`` alone bounds the lexicon.
    """
    known = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
             .dropna().groupBy("doc_id").agg(F.max("label").alias("label"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    sample = land(docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
                  .join(F.broadcast(known), "doc_id"), "toxicity-sample")

    def counted(only: frozenset | None):
        def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            n: Counter = Counter()
            for text in utf8(batch.column("text")):
                own = entries_of(fold(text.decode()))
                n.update(own if only is None else own & only)
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())],
                                             ["entry", "rows"])
        return run

    def counts(label: int, only: frozenset | None) -> DataFrame:
        own = sample.where(F.col("label") == label).repartition(8, "doc_id")
        return map_batches(own, counted(only), "entry string, rows long").groupBy("entry").agg(F.sum("rows").alias("rows"))

    total = dict(sample.groupBy("label").count().collect())
    toxic = {r["entry"]: r["rows"] for r in counts(1, None).where(F.col("rows") >= 2)
             .collect()}
    if not toxic:
        return Lexicon()
    clean = dict(counts(0, frozenset(toxic)).collect())
    model = Lexicon(choose_entries([(e, t, clean.get(e, 0)) for e, t in toxic.items()],
                                   total.get(1, 0), total.get(0, 0)))

    def rates(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        a = model.automaton()
        folded = [fold(t.decode()) for t in utf8(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("label"), pa.array([matched_weight(f, a) for f in folded]),
             pa.array([f.count(" ") - 1 for f in folded], pa.int64())], ["label", "weight", "words"])

    rows: pd.DataFrame = map_batches(sample, rates, "label int, weight double, words long").toPandas()
    x = np.array([measures(w, n) for w, n in zip(rows["weight"], rows["words"])])
    model.logistic = logistic_fit(x, rows["label"].to_numpy(float))
    return model


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = 0.5) -> DataFrame:
    """doc_id, n_words, weight (matched), score and predicted for every row.

    A null or empty text matches nothing. Repeated rows are each scored,
    extra columns aren't read, an empty table gives no rows. The lexicon,
    bounded by the rows it was fitted on, travels with the tasks.
    """
    memory: list = []

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if not memory:
            memory.append(lexicon.automaton())
        b, words, weights, scores = lexicon.logistic, [], [], []
        for text in utf8(batch.column("text")):
            folded = fold(text.decode())
            n = len(folded.split())
            w = matched_weight(folded, memory[0])
            margin = sum(p * q for p, q in zip(b, measures(w, n)))
            words.append(n)
            weights.append(w)
            scores.append(1 / (1 + np.exp(-min(35.0, max(-35.0, margin)))))
        scores = np.array(scores)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(words, pa.int64()), pa.array(weights, pa.float64()), pa.array(scores),
             pa.array((scores >= threshold).astype(np.int32))],
            ["doc_id", "n_words", "weight", "score", "predicted"])

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_batches(rows, run, f"doc_id {id_type}, n_words long, weight double, score double, predicted int")
