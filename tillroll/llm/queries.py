"""The operators' queries over the test tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import (decontaminate, exact_dedup, html_text, near_dedup, packing, quality, repetition, spelling, substring_dedup,
                          suffix_dedup, token_files, toxicity, vector_codes)
from tillroll.llm.common import held_out, table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", substring_dedup.removed_words().alias("n_removed"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(
        decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """Path of a public tokenizer, as installed on every machine of the cluster."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenize_pieces(table(spark, sf_dir, "documents"), tokenizer_file())
    return packing.pack(pieces)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    weights = quality.fit(docs, labels.where(~held_out("doc_id")))
    return quality.score(docs, weights, threshold=0.3).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", substring_dedup.removed_words().alias("n_removed"),
        F.floor(F.size("spans") / 2).alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    lexicon = toxicity.fit(docs, labels.where(~held_out("doc_id")))
    return toxicity.score(docs, lexicon, threshold=0.5).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens: documents as flat token files, counted by a scan of those files."""
    end_id, folder = 49407, token_files.token_folder(spark)
    written = token_files.write_token_files(table(spark, sf_dir, "documents"), tokenizer_file(), end_id, folder)
    counted = token_files.count_tokens(spark, folder, end_id).withColumn("file", F.element_at(F.split("path", "/"), -1))
    # both sides have a row for each document: never a broadcast, however well the manifest compresses
    return written.join(counted.hint("shuffle_merge"), ["file", "ordinal"]).select("doc_id", "n_tokens", "file", "ordinal", "start")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_covered")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.encode(table(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_error(coded).select(
        F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(books.digest() if books else None).cast("string").alias("codebooks_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_substring_dedup, op2_near_dedup, op3_decontaminate, op4_pack, op5_quality, op6_suffix_dedup, op7_exact_dedup, op8_toxicity,
                                    op9_token_counts, op10_html_text, op11_spelling_variants,
                                    op12_quality_rules, op13_vector_codes)}


_DIGEST = "sha256(coalesce(text, ''))"


def _rules_sql(min_words: int = repetition.MIN_WORDS, percent: int = repetition.COVERED_PERCENT,
               longest: int = repetition.LONGEST) -> str:
    """Repeats as windows that a text holds more than once: a repeat above the limit is a window of one word more."""
    def again(k: int, words: str = "words") -> str:
        return f"""
        twice{k} AS (SELECT r, pos FROM (SELECT r, pos, count(*) OVER (PARTITION BY r, gram) AS n FROM (
                       SELECT r, pos, w[pos:pos + {k - 1}] AS gram FROM (SELECT r, w, unnest(range(1, len(w) - {k - 2})) AS pos FROM {words})))
                     WHERE n > 1),
        inside{k} AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(pos, pos + {k})) AS p FROM twice{k}) GROUP BY r)"""

    blank = r"\x20\x09-\x0D"
    return f"""
        WITH words AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
                                        regexp_extract_all(coalesce(text, ''), '[^{blank}]+') AS w FROM documents),{again(3)},{again(min_words)},
        repeating AS (SELECT * FROM words WHERE r IN (SELECT r FROM inside{min_words})),{again(longest + 1, "repeating")},
        base AS (SELECT w.*, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(a.n, 0) AS n_repeat_words, coalesce(b.n, 0) AS n_covered,
                        l.r IS NULL AS short_repeats,
                        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{blank}]')) AS lines
                 FROM words w LEFT JOIN inside3 a ON a.r = w.r LEFT JOIN inside{min_words} b ON b.r = w.r LEFT JOIN inside{longest + 1} l ON l.r = w.r)
        SELECT doc_id, n_words, CAST(length(regexp_replace(t, '[{blank}]', '', 'g')) AS BIGINT) AS word_chars,
               CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
               CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, n_repeat_words, n_covered,
               n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
               AND 100 * n_covered <= {percent} * n_words AND short_repeats AS kept
        FROM base"""


def _codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Every part against every entry of its codebook, round after round."""
    steps = [f"""
        kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
                 FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        cut AS (SELECT vec_id, label, p, v[CAST(p * len(v) // {parts} + 1 AS BIGINT):CAST((p + 1) * len(v) // {parts} AS BIGINT)] AS x
                FROM kept, range({parts}) t(p)),
        book0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS k, x AS e FROM cut QUALIFY k < {entries})"""]
    for r in range(rounds + 1):
        steps.append(f"""
        near{r} AS (SELECT vec_id, label, p, x, min({{'d': d, 'k': k}}) AS best FROM (
                      SELECT vec_id, label, c.p, x, k, CAST(list_sum(list_transform(list_zip(x, e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
                      FROM cut c JOIN book{r} b ON c.p = b.p) GROUP BY ALL)""")
        if r < rounds:
            steps.append(f"""
        mean{r} AS (SELECT p, k, list(m ORDER BY i) AS e FROM (
                      SELECT p, k, i, CAST(floor(CAST(sum(y) AS DOUBLE) / count(*)) AS BIGINT) AS m FROM (
                        SELECT p, best.k AS k, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM near{r}) GROUP BY p, k, i) GROUP BY p, k),
        book{r + 1} AS (SELECT b.p, b.k, coalesce(m.e, b.e) AS e FROM book{r} b LEFT JOIN mean{r} m ON b.p = m.p AND b.k = m.k)""")
    steps.append(f"""
        sums AS (SELECT vec_id, label, string_agg(format('{{:02x}}', best.k), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
                 FROM near{rounds} GROUP BY vec_id, label),
        flat AS (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY p, k)) AS digest FROM book{rounds})""")
    return f"""WITH {",".join(steps)}
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256
        FROM sums, flat"""


_SQL = {
    "op12_quality_rules": _rules_sql(),
    "op13_vector_codes": _codes_sql(),
    "op7_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, {_DIGEST} AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
