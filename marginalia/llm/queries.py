"""Registered queries of this sub-package: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bwt_repeats, direct_codes, fertility, html_blocks, length_histogram, line_spread, ngram_join, pigeonhole,
               secret_markov, soft_mixing, string_kernel_lang, token_alignment, whitening)
from .common import table

# Target shares of the mixing query.
MIX = {"clean": 0.85, "low": 0.15, "toxic": 0.0}


def op1_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract_main_text(table(spark, sf_dir, "pages"))


def op2_fertility_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = fertility.fertility_rules(table(spark, sf_dir, "documents"))
    return rules.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                        "kept", "reasons", "piece_chars", "byte_chars", "fallback_share", "entropy")


def op3_direct_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return direct_codes.token_codes(table(spark, sf_dir, "documents"))


def op4_secret_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_markov.scan_secrets(table(spark, sf_dir, "documents")).drop("base", "added")


def op5_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_spread.remove_boilerplate(table(spark, sf_dir, "documents"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return string_kernel_lang.identify_language(table(spark, sf_dir, "documents"))


def op8_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = soft_mixing.quality_domains(table(spark, sf_dir, "labels"))
    rates = soft_mixing.mix(table(spark, sf_dir, "documents"), labelled, MIX)
    return rates.select("doc_id", "n_tokens", *[rates["p"][k].alias(f"p_{d}") for k, d in enumerate(MIX)], "rate")


def op9_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pigeonhole.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_histogram.length_histogram(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    # beyond 64 bits there is no long to hold it
    return found.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment_scores(table(spark, sf_dir, "documents"))


def op13_bwt_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bwt_repeats.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda s, x: s + x)
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_html_blocks, op2_fertility_rules, op3_direct_codes, op4_secret_markov, op5_line_spread,
                            op6_ngram_join, op7_string_kernel, op8_soft_mixing, op9_pigeonhole, op10_length_histogram,
                            op11_whitening, op12_token_alignment, op13_bwt_repeats)}

ORACLES: dict[str, str] = {
    "op5_line_spread": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, text FROM documents),
l AS (SELECT rid, doc_id, coalesce(source, '') AS site, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS ord FROM d),
k AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS own FROM l),
wide AS (SELECT own, min(doc_id) AS first_doc FROM k WHERE own <> '' GROUP BY own
         HAVING count(DISTINCT site) >= {line_spread.MIN_SITES}),
m AS (SELECT k.rid, k.line, k.ord, wide.own IS NOT NULL AND k.doc_id IS DISTINCT FROM wide.first_doc AS gone
      FROM k LEFT JOIN wide ON k.own = wide.own),
r AS (SELECT rid, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
             coalesce(string_agg(line, chr(10) ORDER BY ord) FILTER (WHERE NOT gone), '') AS rest FROM m GROUP BY rid)
SELECT d.doc_id, d.source, CASE WHEN d.text IS NULL THEN NULL ELSE r.rest END AS text,
       coalesce(r.n_lines, 0) AS n_lines, coalesce(r.n_removed, 0) AS n_removed
FROM d LEFT JOIN r ON d.rid = r.rid""",
    "op13_bwt_repeats": """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS b FROM documents),
h AS (SELECT rid, doc_id, hex(b) AS x, octet_length(b) AS n FROM d),
w AS (SELECT rid, doc_id, pos, substr(x, 2 * pos + 1, 100) AS s FROM (SELECT *, unnest(range(n - 49)) AS pos FROM h WHERE n >= 50)),
f AS (SELECT s, min(doc_id) AS first_doc FROM w GROUP BY s HAVING min(doc_id) <> max(doc_id)),
g AS (SELECT rid, pos FROM w JOIN f ON w.s = f.s WHERE doc_id > first_doc),
m AS (SELECT rid, pos, coalesce(pos > 50 + lag(pos) OVER (PARTITION BY rid ORDER BY pos), true) AS new FROM g),
r AS (SELECT rid, pos, sum(new::int) OVER (PARTITION BY rid ORDER BY pos) AS run FROM m),
spans AS (SELECT rid, min(pos) AS a, max(pos) + 50 AS e FROM r GROUP BY rid, run),
gaps AS (SELECT rid, coalesce(lag(e) OVER (PARTITION BY rid ORDER BY a), 0) AS a, a AS e FROM spans
         UNION ALL SELECT h.rid, coalesce(max(spans.e), 0), max(h.n) FROM h LEFT JOIN spans ON h.rid = spans.rid GROUP BY h.rid),
kept AS (SELECT h.rid, string_agg(substr(x, 2 * a + 1, 2 * (e - a)), '' ORDER BY a) AS x FROM h JOIN gaps ON h.rid = gaps.rid GROUP BY h.rid),
totals AS (SELECT rid, sum(e - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY rid)
SELECT h.doc_id, h.n::bigint AS n_bytes, coalesce(n_removed, 0)::bigint AS n_removed, coalesce(n_spans, 0)::bigint AS n_spans,
       sha256(unhex(kept.x)) AS kept_sha256
FROM h JOIN kept ON h.rid = kept.rid LEFT JOIN totals ON h.rid = totals.rid""",
}
