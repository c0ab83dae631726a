"""Decontamination, packing, classifiers, token files, page text and the entry's queries on small tables:
nulls, empty and long texts, ties, repeated rows, empty tables, extra columns with clashing names."""

import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from tests.llm import brute
from tests.llm.test_dedup import SCHEMA, corpus, frame, got
from tillroll.llm import decontaminate, exact_dedup, html_text, packing, quality, token_files, toxicity
from tillroll.llm.queries import tokenizer_file

ROWS = [(1, "a short text"), (1, "a short text"), (2, None), (3, ""), (4, " \t\n"), (5, "word " * 9000), (None, "no id here")]


def test_decontaminate_against_brute_force(spark):
    rows = [r for r in corpus(5) if r[0] is not None] + [r for r in ROWS if r[0] is not None]
    rng = random.Random(5)
    texts = [t.split() for _, t in rows if t and len(t.split()) > 30]
    items = [("b1", None), ("b2", ""), ("b3", "short Text"), ("b4", "never to be found in any of the texts at all")]
    for k in range(8):
        words = rng.choice(texts)
        at = rng.randrange(len(words) - 15)
        items.append((f"c{k}", " ".join(words[at:at + rng.choice([3, 10, 14])]).upper()))
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id string, text string, doc_id int")
    report = decontaminate.contamination_report(decontaminate.decontaminate(frame(spark, rows), bench))
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert got(report, *columns) == brute.contamination(rows, items)


def test_packing_round_trip(spark):
    import tokenizers

    rows = [r for r in ROWS if r[0] != 1] + [(1, "a short text")] + [(10 + i, "more words " * (i * 37)) for i in range(40)]
    out = packing.pack(packing.tokenize_pieces(frame(spark, rows), tokenizer_file())).toPandas()
    encode = tokenizers.Tokenizer.from_file(tokenizer_file()).encode
    want = []
    for i, t in rows:
        ids = [*encode(t or "", add_special_tokens=False).ids, 1]
        for p, s in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[s:s + 4096], "<u4")
            want.append((i or 0, p, s, len(part), zlib.crc32(part.tobytes())))
    have = out[["doc_id", "piece", "start", "length", "ids_crc32"]].fillna(0).astype("int64")
    assert sorted(have.itertuples(index=False, name=None)) == sorted(want)
    for _, held in out.sort_values("offset").groupby("sequence_id"):
        assert held["length"].sum() <= 4096
        assert held["offset"].tolist() == [0, *held["length"].cumsum().tolist()[:-1]]
    assert out["sequence_id"].nunique() <= -(-out["length"].sum() // 4096) + 1


@pytest.mark.parametrize("operator,label,words", [(quality, "quality", ("good", "bad")), (toxicity, "toxic", ("idiot", "friend"))])
def test_classifiers(spark, operator, label, words):
    rng = random.Random(7)
    filler = [f"filler{k}" for k in range(50)]
    rows = [(i, " ".join([*rng.choices(filler, k=30), words[i % 2], words[i % 2]])) for i in range(200)]
    truth = [(i, 1 - i % 2) for i in range(200)]
    labels = spark.createDataFrame([*truth, (None, 1), (3000, None)], f"doc_id long, {label} int")
    model = operator.fit(frame(spark, rows + ROWS), labels.where("doc_id < 150 or doc_id is null"))
    scored = operator.score(frame(spark, rows + ROWS), model, threshold=0.5).collect()
    assert len(scored) == len(rows) + len(ROWS)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in scored)
    # ids that only the classifier's rows use, unseen in training
    assert {(r["doc_id"], r["predicted"]) for r in scored if (r["doc_id"] or 0) >= 150} == set(truth[150:])


def test_token_counts(spark):
    import tokenizers

    folder = token_files.token_folder(spark)
    written = token_files.write_token_files(frame(spark, ROWS), tokenizer_file(), 49407, folder)
    counted = token_files.count_tokens(spark, folder, 49407, block_bytes=64)
    counted = counted.withColumn("file", F.element_at(F.split("path", "/"), -1))
    have = written.join(counted, ["file", "ordinal"]).select("doc_id", "n_tokens").collect()
    encode = tokenizers.Tokenizer.from_file(tokenizer_file()).encode
    sizes = sorted((i or 0, len(encode(t or "", add_special_tokens=False).ids)) for i, t in ROWS)
    have = sorted((r["doc_id"] or 0, r["n_tokens"]) for r in have)
    closing = have[[i for i, _ in have].index(2)][1]  # what the empty text counts: its end or nothing
    assert have == [(i, n + closing) for i, n in sizes]


def test_page_text(spark):
    article = "<article><h1>The title</h1><p>It is a long paragraph of the article, and it has many of the words.</p></article>"
    pages = [(1, "u", f"<html><nav><a href='/x'>Home</a></nav>{article}<footer>&copy; x</footer><script>var a</script></html>"),
             (1, "u", None), (2, None, ""), (3, "u", "<p>Fish &amp; chips,\n &#233;t&eacute; are the things that we have and like to eat in the sun.")]
    df = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, text string")
    have = got(html_text.extract(df), "page_id", "url", "text", "n_chars")
    assert [r[2] for r in have] == [
        "", "The title\nIt is a long paragraph of the article, and it has many of the words.", "",
        "Fish & chips, été are the things that we have and like to eat in the sun."]
    assert all(r[3] == len(r[2]) for r in have)
    assert html_text.extract(df.limit(0)).count() == 0


LONG = "It is a long paragraph of the article, and it has many of the words that we have and like to read in the sun."
ARTICLE = f"<article><h1>The title</h1><p>{LONG}</p></article>"


@pytest.mark.parametrize("page", [
    f'<body><div class="content has-sidebar">{ARTICLE}</div></body>',
    f'<body><div class="no-sidebar">{ARTICLE}</div><div class="sidebar">{LONG}</div></body>',
    f'<body><div id="widget"><div class="content">{ARTICLE}</div></div></body>',
    f'<body><form action="/x"><div class="notice">{ARTICLE}</div></form></body>',
    f"<html><head><title>x</title><meta charset=utf-8><body>{ARTICLE}</body></html>",
    f"<html><head><title>x</title><link rel=y>{ARTICLE}</html>",
    f'<input list=l><datalist id=l><option value=a><option value=b></datalist>{ARTICLE}',
    f"<div><option value=a></div>{ARTICLE}",
    f"<script>for(i=0;i<n;i++){{}}</script>{ARTICLE}",
    f'<article><p class="notice">Notice<h1>The title</h1><p>{LONG}</article>',
])
def test_page_text_keeps_the_article(page):
    assert html_text.main_text(page) == f"The title\n{LONG}"


def test_page_text_keeps_runs_of_middling_blocks():
    near = ["It is a paragraph of the page, and it is not as long as the others are.",
            "It has a second one that is by and large as long as the first one was."]
    assert all(html_text.SHORT <= len(t) < html_text.LONG for t in near)
    links = "<ul><li><a href=/a>Home</a><li><a href=/b>About us</a></ul>"
    body = "".join(f"<p>{t}</p>" for t in near)
    assert html_text.main_text(f"{links}{body}{links}") == "\n".join(near)
    assert html_text.main_text(f"{links}<p>{near[0]}</p>{links}") == near[0]
    good = f"{LONG} {LONG}"
    assert html_text.main_text(f"<p>{good}</p>{links}{body}{links}") == "\n".join([good, *near])
    assert html_text.main_text(f"<p>{good}</p>{links}<p>{near[0]}</p>{links}") == good
    assert html_text.main_text(f"{links}<div class=cookie-notice>{body}</div>{links}") == ""


@pytest.mark.parametrize("wrapper", ["sidebar", "site-footer", "widget-2", "comment_list", "x share-buttons"])
def test_page_text_leaves_out_marked_containers(wrapper):
    assert html_text.main_text(f'<article><p>{LONG}</p><div class="{wrapper}"><p>{LONG} Twice.</p></div></article>') == LONG
    assert html_text.main_text(f'<article><p>{LONG}</p><ol class="{wrapper}"><article>{LONG} Twice.</article></ol></article>') == LONG


POST = f"{LONG} {LONG}"


@pytest.mark.parametrize("rest", [
    f'<div id="comments" class="comments-area"><ol><li><article class="comment-body"><p>{POST} {POST}</p></article></ol></div>',
    f'<section><article class="comment"><p>{POST} {POST}</p></article></section>',
    f'<div class="sidebar"><article class="widget"><p>{LONG}</p></article></div>',
    f'<form class="newsletter"><article><p>{LONG}</p></article></form>',
    f'<div class="post-comments"><p>{POST}</p></div>',
    f'<section id="reader_comments"><p>{POST}</p></section>',
])
def test_page_text_leaves_out_articles_that_are_not_the_post(rest):
    assert html_text.main_text(f"<body><article><p>{POST}</p></article>{rest}</body>") == POST
    assert html_text.main_text(f"<body>{rest}<article><p>{POST}</p></article></body>") == POST
    assert html_text.main_text(f"<body><main><p>{POST}</p>{rest}</main></body>") == POST


def test_page_text_inside_the_article_leaves_out_comments():
    for name in ("post-comments", "comments-wrapper", "article-comment-list", "disqus_thread"):
        assert html_text.main_text(f'<article><p>{POST}</p><div class="{name}"><p>{LONG}</p></div></article>') == POST
    for name in ("no-comments", "has-comments", "comments-open", "commentary"):
        assert html_text.main_text(f'<article><div class="{name}"><p>{POST}</p></div></article>') == POST


def test_page_text_outside_a_teaser():
    body = f"<div id=content><p>{POST}</p><p>{POST} Two.</p><p>{POST} Three.</p></div>"
    want = "\n".join([POST, f"{POST} Two.", f"{POST} Three."])
    teaser = "<article><h3><a href=/x>More to read</a></h3><p>It is a teaser.</p></article>"
    assert html_text.main_text(f"<body>{body}{teaser}</body>") == want
    assert html_text.main_text(f"<body>{teaser}{body}</body>") == want
    # text of a like size beside the article doesn't replace it
    assert html_text.main_text(f"<body><div><p>{POST}</p></div><article><p>{POST} Own.</p></article></body>") == f"{POST} Own."


def test_page_text_marked_container_of_the_largest_article():
    page = f'<body><div class="content sidebar"><article><p>{POST} {POST}</p><nav>Up</nav></article></div><article><p>{LONG}</p></article></body>'
    assert html_text.main_text(page) == f"{POST} {POST}\n{LONG}"
    assert html_text.main_text(f'<div class="comments"><article><p>{POST}</p></article></div>') == POST


def test_page_text_of_deep_pages_takes_linear_time():
    def seconds(n):
        page = "<div>" * n + f"<p>{LONG}</p>" + "</section></div>" * n
        at = time.perf_counter()
        assert html_text.main_text(f"<article>{page}</article>") == LONG
        return time.perf_counter() - at
    seconds(100)
    assert seconds(50_000) < 30 * max(0.05, seconds(5_000))


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    bench = spark.createDataFrame([], "item_id string, text string")
    assert decontaminate.decontaminate(none, bench).count() == 0
    assert packing.pack(packing.tokenize_pieces(none, tokenizer_file())).count() == 0
    assert exact_dedup.exact_dedup(none).count() == 0
    for operator, label in ((quality, "quality"), (toxicity, "toxic")):
        labels = spark.createDataFrame([], f"doc_id long, {label} int")
        assert operator.score(none, operator.fit(none, labels)).count() == 0


def test_entry_registers_the_queries():
    names = list(__spark_entry__.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names


@pytest.mark.parametrize("words", [40, 20_000])
def test_logistic_fit_settles_on_close_measures(words):
    """Rows of one length, and of lengths far apart: the fit must separate what the weights separate."""
    random_ = np.random.default_rng(3)
    toxic = random_.random(3000) < 0.1
    n = random_.integers(30, words, len(toxic))
    weight = np.where(toxic, random_.integers(2, 6, len(toxic)) * 4.3, (random_.random(len(toxic)) < 0.01) * 1.7)
    x = np.array([toxicity.measures(w, k) for w, k in zip(weight, n)])
    found = x @ np.array(toxicity.logistic_fit(x, toxic.astype(float))) >= 0
    assert (found == toxic).mean() > 0.99


def test_quality_keeps_ngrams_across_pieces(monkeypatch):
    rng = random.Random(3)
    text = " ".join(rng.choice(["a", "Bc", "12", "!!", "a a", "\n"]) for _ in range(4000)).encode()
    whole = quality.features(text, quality.Codes(), 12)
    monkeypatch.setattr(quality, "PIECE", 50)
    parts = quality.features(text, quality.Codes(), 12)
    assert (whole[0] == parts[0]).all() and np.allclose(whole[1], parts[1])


def test_exception_phrases_silence_what_starts_in_them():
    import ahocorasick

    automaton = ahocorasick.Automaton()
    rng = random.Random(5)
    entries = {"".join(rng.choices("ab", k=n)): (w if w else None) for n in (1, 2, 3, 4, 5) for w in (0, 1.0, -0.5, 2.0) for _ in range(2)}
    for e, w in entries.items():
        automaton.add_word(e, (len(e), w))
    automaton.make_automaton()
    for _ in range(50):
        text = "".join(rng.choices("abc", k=60))
        found = [(s, e, w) for e, w in entries.items() for s in range(60) if text.startswith(e, s)]
        longest = {s: max((x for x in found if x[0] == s and x[2] is not None), key=lambda x: len(x[1]), default=None) for s in range(60)}
        # a phrase's own last letter isn't inside it, as the operator has it
        quiet = [(s, s + len(e) - 1) for s, e, w in found if w is None]
        want = sum(max(0.0, x[2]) for s, x in longest.items() if x and not any(a <= s < b for a, b in quiet))
        assert toxicity.matched_weight(text, automaton) == pytest.approx(want)


def test_token_cache_that_overflows(monkeypatch):
    import tokenizers

    from tillroll.llm import tokens

    monkeypatch.setattr(tokens, "MOST_WORDS", 40)
    encoder = tokens.WordTokens(tokenizer_file())
    plain = tokenizers.Tokenizer.from_file(tokenizer_file()).encode
    rng = random.Random(6)
    for _ in range(6):
        texts = [" ".join(f"word{rng.randrange(60)}" for _ in range(rng.randrange(12))) for _ in range(8)] + ["", " "]
        got_ids = [ids.tolist() for ids in encoder.encode([t.encode() for t in texts])]
        assert got_ids == [plain(t, add_special_tokens=False).ids for t in texts]


def test_token_cache_keeps_words_that_come_again():
    """Many rare words don't fill a worker's memory, nor push out the words that every batch has."""
    from tillroll.llm import tokens

    asked = []

    class Asked(tokens.WordTokens):
        def ids_of(self, words):
            asked.extend(words)
            return super().ids_of(words)

    encoder = Asked(tokenizer_file())
    often = ["the", "house", "on", "hills."]
    rng = random.Random(8)
    rare = ["".join(rng.choices("abcdefghijklmnop", k=9)) for _ in range(450_000)]
    want = None
    for at in range(0, len(rare), 45_000):
        found = encoder.encode([" ".join(often).encode(), " ".join(rare[at:at + 45_000]).encode()])
        want = want or found[0].tolist()
        assert found[0].tolist() == want
        assert len(encoder.code) <= 400_000 and len(encoder.units) <= 400_000
    assert [asked.count(w.encode()) for w in often] == [1] * 4
    assert tokens.WordTokens(tokenizer_file()).encode([" ".join(often).encode()])[0].tolist() == want


def test_tokens_of_a_batch_in_parts():
    """A batch's words aren't held all at once; its texts keep their places."""
    import tracemalloc

    from tillroll.llm import tokens

    encoder = tokens.WordTokens(tokenizer_file())
    texts = [b"", *[b"abcdefghi %d " % k * 40_000 for k in range(24)], b"last"]  # 11 MB
    want = [encoder.encode([t])[0].tolist() for t in texts]
    tracemalloc.start()
    found = encoder.encode(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [ids.tolist() for ids in found] == want
    assert peak < 130 << 20


def test_tokens_of_marked_words():
    """Words with marks, digits and letters of all kinds have the tokenizer's own ids, and a batch looks each word up once."""
    import tokenizers

    from tillroll.llm import tokens

    class Counted(tokens.Known):
        lookups = 0

        def __getitem__(self, word):
            Counted.lookups += 1
            return super().__getitem__(word)

    encoder = tokens.WordTokens(tokenizer_file())
    plain = tokenizers.Tokenizer.from_file(tokenizer_file()).encode
    rng = random.Random(7)
    pieces = ["Word", "tion", "Straße", "ß", "ÉÊ", "ÿ", "über", "7", "2024", ",", ".", "&&&", "###", "'s", "'", "don't", "\u0301", "×", "÷", "ª",
              "日本", "İ", "Σ", "\u00a0", "\u2028", "<|endoftext|>", "<|", "|>", "(x)", "_", "~", "\x7f", "\x1c", "\x85", "ﬁ", "½", "ⅷ", "\U0001f600"]
    words = ["".join(rng.choices(pieces, k=rng.choice([1, 1, 2, 3, 5]))) for _ in range(4000)]
    texts = [" ".join(rng.choices(words, k=rng.randrange(40))) for _ in range(600)]
    want = [plain(t, add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in encoder.encode([t.encode() for t in texts])] == want
    encoder.code = Counted(encoder.code)
    assert [ids.tolist() for ids in encoder.encode([t.encode() for t in texts])] == want
    assert 0 < Counted.lookups <= len({w for t in texts for w in t.encode().split()})


def test_token_folders_that_no_worker_can_open():
    with pytest.raises(ValueError, match="viewstore"):
        token_files.open_store("viewstore://somewhere/tokens")
