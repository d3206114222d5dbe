"""A corpus pipeline of five stages over ``documents``.

Quality rules, one document of each near-duplicate group, benchmark
decontamination, mixing to target weights, token ids as directly addressable
codes. Each stage reads what the one before it wrote. All but the last return
the columns of documents as they are; nulls, repeated rows, empty tables and
extra columns are handled as each operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marginalia.llm import direct_codes, fertility, ngram_join, pigeonhole, soft_mixing
from marginalia.llm.common import materialize, table

# Domains of the mix; those in UNWANTED get no weight, the others the share they have.
DOMAINS, UNWANTED = ["clean", "low", "toxic"], {"toxic"}


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the fertility bands reject go."""
    return fertility.keep_fertile(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of 5-word shingle sets of similarity 0.8 or more stays: the least doc_id."""
    return ngram_join.keep_one(docs, size=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within its error budget go."""
    return pigeonhole.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing without repetition: unwanted domains get no tokens, the others keep theirs.

    Rates of documents in wanted domains end at one or above, so these
    documents stay; a document of rate r below one stays if a hash of it in
    [0, 1) is at least 1 - r.
    """
    labelled = soft_mixing.quality_domains(table(spark, sf_dir, "labels"))
    members = soft_mixing.memberships(docs, labelled, DOMAINS)
    totals = soft_mixing.own_totals(members, len(DOMAINS))
    weights = [0.0 if d in UNWANTED else t for d, t in zip(DOMAINS, totals)]
    if not sum(weights):
        return docs
    rates = soft_mixing.fit_rates(members, weights, budget=sum(weights))
    return soft_mixing.apply_rates(docs, rates, most=1)


def codes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in files of directly addressable codes; returns doc_id, start, n_tokens, ids_crc32 read back."""
    return direct_codes.token_codes(docs)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing to target weights", mixing),
    ("token ids as direct codes", codes),
]

# Tokenisers, edit distances and fitted models aren't SQL: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{k + 1}")
    return docs
