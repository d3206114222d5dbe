"""Invariants over the driver tables (sf0.001)."""

from pyspark.sql import functions as F

from marginalia.operators import changes as ch
from marginalia.operators import markdown as md
from marginalia.operators import threads as th
from marginalia.plans.markdown_queries import part_markdown_docs
from marginalia.sources import driver_tables as dt

SF = "/root/testdata/sf0.001"


def test_each_comment_in_exactly_one_thread(spark):
    ev = dt.table(spark, SF, "events")
    assigned = th.assign_threads(th.normalize_comments(dt.comments_from_events(ev), dt.WIKI_BASE), bucket_width=64)
    n = ev.count()
    assert assigned.count() == n
    assert assigned.select("page_id", "position").distinct().count() == n
    threads = th.thread_rollup(assigned)
    assert threads.agg(F.sum("comment_count")).first()[0] == n
    summary = th.page_comment_summary(threads)
    bad = summary.filter(F.col("anchored_comment_count") + F.col("reply_comment_count") != F.col("total_comments"))
    assert bad.count() == 0
    assert summary.agg(F.sum("total_comments")).first()[0] == n


def test_blocks_partition_lines(spark):
    docs = part_markdown_docs(dt.table(spark, SF, "part"))
    b = md.classify_lines(docs)
    nonblank = b.filter(F.col("kind") != "blank")
    # every non-blank line belongs to exactly one block, and blocks are numbered 1..k
    assert nonblank.filter(F.col("block_no") < 1).count() == 0
    starts = b.filter(F.col("block_start")).groupBy("doc_id").agg(F.max("block_no").alias("k"), F.count("*").alias("n"))
    assert starts.filter(F.col("k") != F.col("n")).count() == 0


def test_untouched_pages_unchanged_and_one_version_per_edit(spark):
    wiki = dt.wiki_pages(dt.table(spark, SF, "pages"))
    pages = wiki.select("id", "title", F.col("body.storage.value").alias("body"),
                        F.col("version.number").alias("version"), F.lit(None).cast("string").alias("parent_id"))
    edits = pages.filter(F.col("id").cast("int") % 4 == 0).select(
        F.lit(1).alias("seq"), F.col("id").alias("page_id"), F.lit("T").alias("title"),
        F.lit(None).cast("string").alias("body_html"), F.lit("<p>x</p>").alias("append_html"),
        F.lit(None).cast("string").alias("new_parent_id"))
    nxt = ch.apply_updates(pages, edits)
    j = pages.alias("a").join(nxt.alias("b"), "id")
    untouched = j.filter(F.col("b.edit_count") == 0)
    assert untouched.filter((F.col("a.title") != F.col("b.title")) | (F.col("a.body") != F.col("b.body"))
                            | (F.col("a.version") != F.col("b.version"))).count() == 0
    touched = j.filter(F.col("b.edit_count") > 0)
    assert touched.filter(F.col("b.version") != F.col("a.version") + F.col("b.edit_count")).count() == 0
    assert touched.count() == edits.count()
