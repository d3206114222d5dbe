"""Token counts: the exact histogram of encoded lengths and its suffix sums.

Documents are encoded where they are read and leave a task as one row per
distinct length (partial counts merge in the shuffle), so what is shuffled is
bounded by the number of distinct lengths. Suffix sums over the histogram
answer, for every context limit, how many documents and tokens lie beyond it
and how many tokens remain after truncation.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, public_tokenizer, rows
from .tokens import VOCABULARY, word_encoder

# Lengths per block of the two-level suffix sums.
BLOCK = 256


def encoded_lengths(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(n_tokens, n_docs) partial counts of every task; null and empty texts have length 0."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, seen = word_encoder(public_tokenizer(vocabulary)).ids, Counter()
        for part in rows(batches):
            seen.update(len(ids(t)) // 4 for t in part["text"])
        if seen:
            yield pa.RecordBatch.from_pydict({"n_tokens": list(seen), "n_docs": list(seen.values())},
                                             schema=pa.schema([("n_tokens", pa.int64()), ("n_docs", pa.int64())]))

    return docs.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "n_tokens long, n_docs long")


def length_histogram(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per distinct encoded length, with suffix and prefix sums.

    Columns: n_tokens; n_docs; docs_longer and tokens_longer (of documents
    longer than n_tokens); docs_upto and tokens_upto; total_docs and
    total_tokens; truncated_tokens (what remains if each document keeps at most
    n_tokens); rank_low and rank_high (0-based ranks of these documents in
    ascending length). Nulls and empty texts count as length 0; repeated rows
    count each time; an empty table gives no rows; other columns are not read.
    """
    merged = encoded_lengths(docs, text, vocabulary).groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))
    # read twice below, so written once
    hist = materialize(merged, "lengths").withColumn("block", F.floor(F.col("n_tokens") / BLOCK))
    # level one: inside a block; level two: one row per block
    inside = Window.partitionBy("block").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    tokens = F.col("n_tokens") * F.col("n_docs")
    part = hist.select("*", F.sum("n_docs").over(inside).alias("d_in"), F.sum(tokens).over(inside).alias("t_in"))
    blocks = hist.groupBy("block").agg(F.sum("n_docs").alias("d_block"), F.sum(tokens).alias("t_block"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bases = blocks.select(
        "block",
        F.coalesce(F.sum("d_block").over(before), F.lit(0)).alias("d_base"),
        F.coalesce(F.sum("t_block").over(before), F.lit(0)).alias("t_base"),
        F.sum("d_block").over(every).alias("total_docs"), F.sum("t_block").over(every).alias("total_tokens"))
    upto = part.join(bases, "block").select(
        "n_tokens", "n_docs", "total_docs", "total_tokens",
        (F.col("d_base") + F.col("d_in")).alias("docs_upto"), (F.col("t_base") + F.col("t_in")).alias("tokens_upto"))
    longer = F.col("total_docs") - F.col("docs_upto")
    return upto.select(
        "n_tokens", "n_docs", longer.alias("docs_longer"),
        (F.col("total_tokens") - F.col("tokens_upto")).alias("tokens_longer"),
        "docs_upto", "tokens_upto", "total_docs", "total_tokens",
        (F.col("tokens_upto") + F.col("n_tokens") * longer).alias("truncated_tokens"),
        (F.col("docs_upto") - F.col("n_docs")).alias("rank_low"), (F.col("docs_upto") - 1).alias("rank_high"))


def truncated_totals(hist: DataFrame, limits: list[int]) -> DataFrame:
    """(context, truncated_tokens, docs_longer): tokens left if each document keeps at most ``context``.

    One aggregate over the histogram: the suffix sums of the greatest length
    not above a limit hold for that limit, as nothing lies between. With a
    limit below every length each document keeps ``context`` tokens.
    """
    below = [F.max(F.when(F.col("n_tokens") <= c, F.struct("n_tokens", "tokens_upto", "docs_longer"))).alias(f"c{k}")
             for k, c in enumerate(limits)]
    one = hist.agg(F.coalesce(F.max("total_docs"), F.lit(0)).alias("docs"), *below)
    answers = []
    for k, c in enumerate(limits):
        longer = F.coalesce(F.col(f"c{k}.docs_longer"), F.col("docs"))
        answers.append(F.struct(
            F.lit(c).cast("long").alias("context"),
            (F.coalesce(F.col(f"c{k}.tokens_upto"), F.lit(0)) + c * longer).cast("long").alias("truncated_tokens"),
            longer.cast("long").alias("docs_longer")))
    return one.select(F.inline(F.array(*answers)))


def length_quantile(hist: DataFrame, q: float) -> Column:
    """Aggregate over ``hist``: the length of rank ``ceil(q * total) - 1`` (the lower quantile)."""
    rank = F.greatest(F.ceil(F.lit(q) * F.col("total_docs")) - 1, F.lit(0))
    return F.min(F.when(F.col("rank_high") >= rank, F.col("n_tokens")))
