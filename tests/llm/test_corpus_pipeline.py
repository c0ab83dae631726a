"""The corpus pipeline on small tables."""

import random
import zlib

import numpy as np

import corpus_pipeline
from tests.llm import brute
from tests.llm.test_dedup import corpus, edits, frame, got
from tillroll.llm import quality
from tillroll.llm.common import held_out
from tillroll.llm.queries import tokenizer_file


def test_near_copies_with_null_and_repeated_ids(spark):
    text = lambda name, more="": " ".join(f"{name}{i}" for i in range(40)) + more
    rows = [(None, text("a")), (None, text("a", " x")), (None, text("a", " y")),  # a group without ids: one stays
            (None, text("b")), (4, text("b", " x")),  # linked with an id, which stays
            (None, text("c")),  # alone
            (7, text("d", " x")), (3, text("d")), (7, text("e")),  # 7 goes with one text and stays with the other
            (9, text("f")), (9, text("f", " x")),  # one id, two texts of a group: one stays
            (5, text("g")), (5, text("g")),  # id and text repeated: they go together
            (None, None), (8, ""), (None, " ")]  # linked with nothing
    out = got(corpus_pipeline.near_copies(spark, frame(spark, rows), ""), "doc_id", "text")
    in_group = lambda at: [r for r in out if r in rows[at]]
    assert len(in_group(slice(0, 3))) == 1
    assert len(in_group(slice(9, 11))) == 1
    sure = [rows[k] for k in (4, 5, 7, 8, 11, 12, 13, 14, 15)]
    assert out == sorted(in_group(slice(0, 3)) + in_group(slice(9, 11)) + sure, key=str)


def test_run_against_brute_force(spark, tmp_path):
    import tokenizers

    rng = random.Random(11)
    rows = dict(corpus(11) + [(3 * 10**6 + k, t) for k, (_, t) in enumerate(edits(11))])  # one row an id
    rows |= {4 * 10**6 + k: " ".join(f"long{k}" for k in range(6000)) for k in range(2)}
    for k in range(120):
        words = [f"n{rng.randrange(60)}" for _ in range(30)]
        rows[5 * 10**6 + k] = " ".join([*words, *["good" if k % 2 else "bad"] * 5])
    texts = [t.split() for t in rows.values() if t and len(t.split()) > 30]
    items = [("none", None), *((f"c{k}", " ".join(rng.choice(texts)[8:20])) for k in range(4))]
    labels = [(5 * 10**6 + k, k % 2) for k in range(120)]
    for name, df in (("documents", frame(spark, list(rows.items()))),
                     ("benchmark", spark.createDataFrame(items, "item_id string, text string")),
                     ("labels", spark.createDataFrame(labels, "doc_id long, quality int"))):
        df.write.parquet(f"{tmp_path}/{name}.parquet")

    docs, known = (spark.read.parquet(f"{tmp_path}/{name}.parquet") for name in ("documents", "labels"))
    scored = quality.score(docs, quality.fit(docs, known.where(~held_out("doc_id"))), threshold=0.3)
    left = {r["doc_id"] for r in scored.where("predicted = 1").collect()}
    counts = [len(rows), len(left)]
    for kept in (lambda have: {r[0] for r in brute.exact(have) if r[3]},
                 lambda have: {r[0] for r in brute.near(have) if r[3]},
                 lambda have: {r[0] for r in brute.contamination(have, items) if not r[5]}):
        left = kept([(i, rows[i]) for i in left])
        counts.append(len(left))
    assert sorted(set(counts), reverse=True) == counts and left  # every stage takes something away

    encode = tokenizers.Tokenizer.from_file(tokenizer_file()).encode
    want = []
    for i in left:
        ids = [*encode(rows[i] or "", add_special_tokens=False).ids, 1]
        for p, s in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[s:s + 4096], "<u4")
            want.append((i, p, s, len(part), zlib.crc32(part.tobytes())))
    out = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    have = out[["doc_id", "piece", "start", "length", "ids_crc32"]].astype("int64")
    assert sorted(have.itertuples(index=False, name=None)) == sorted(want)
    for _, held in out.sort_values("offset").groupby("sequence_id"):
        assert held["length"].sum() <= 4096
        assert held["offset"].tolist() == [0, *held["length"].cumsum().tolist()[:-1]]
    assert out["sequence_id"].nunique() <= -(-out["length"].sum() // 4096) + 1
