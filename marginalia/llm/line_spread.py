"""Cross-site boilerplate lines by distinct-site spread.

A HyperLogLog sketch of sites per line hash is built where lines are read and
merged by the aggregation. Lines whose estimate lies near the threshold get an
exact count of distinct sites; lines spread over enough sites are removed from
every document but the first that has them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

MIN_SITES = 10
# Sketch size: 2**LG_K registers, relative standard error about 1.04 / sqrt(2**LG_K).
LG_K = 9
# Estimates within this share of the threshold are counted exactly: over five standard errors.
NEAR = 0.25


def line_text(line: Column) -> Column:
    """What two lines must have in common: the line without blanks, tabs and returns at its ends."""
    return F.trim(line, F.lit(" \t\r"))


def _hashes(line: Column) -> Column:
    own = line_text(line)
    return F.struct(F.xxhash64(own).alias("a"), F.xxhash64(F.lit(1), own).alias("b"))


def site_lines(docs: DataFrame) -> DataFrame:
    """(key, doc_id, site, h): one row per line that isn't blank; ``h`` is 128 bits of hash."""
    lines = docs.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id",
                        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("site"),
                        F.explode(F.split(F.col("text").cast("string"), "\n", -1)).alias("line"))
    return lines.where(line_text(F.col("line")) != "").select("key", "doc_id", "site", _hashes(F.col("line")).alias("h"))


def line_spread(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K, near: float = NEAR) -> DataFrame:
    """(h, first_doc, sites) of the lines on at least ``min_sites`` sites.

    ``sites`` is exact where the sketch's estimate is near the threshold, an estimate above.
    """
    spread = lines.groupBy("h").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", lg_k)).alias("estimate"), F.count(F.lit(1)).alias("n"),
        F.min("doc_id").alias("first_doc"))
    # a line can't be on more sites than it has occurrences
    wide = materialize(spread.where((F.col("n") >= min_sites) & (F.col("estimate") >= (1 - near) * min_sites)),
                       "line-spread")
    unsure = wide.where(F.col("estimate") <= (1 + near) * min_sites)
    exact = (lines.join(unsure.select("h"), "h", "left_semi").groupBy("h", "site").agg(F.count(F.lit(1)))
             .groupBy("h").agg(F.count(F.lit(1)).alias("exact")))
    found = wide.join(exact, "h", "left").withColumn("sites", F.coalesce("exact", "estimate"))
    # a written table has a known size: a short list of lines is broadcast, a long one isn't
    return materialize(found.where(F.col("sites") >= min_sites).select("h", "first_doc", "sites"), "line-spread")


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K, near: float = NEAR) -> DataFrame:
    """(doc_id, source, text, n_lines, n_removed) of every row of ``docs`` (doc_id, source, text).

    Lines are compared without blanks at their ends; blank lines stay. A line
    on at least ``min_sites`` distinct sources stays in the document of the
    smallest doc_id that has it, and goes elsewhere. A null source is a site of
    its own; null texts stay null with 0 lines; repeated rows get equal answers;
    extra columns aren't read; an empty table gives no rows.
    """
    slim = docs.select("doc_id", "source", F.col("text").cast("string").alias("text"))
    lines = site_lines(slim)
    wide = line_spread(lines, min_sites, lg_k, near)
    hits = (lines.join(wide, "h").where(~F.col("doc_id").eqNullSafe(F.col("first_doc")))
            .groupBy("key").agg(F.collect_set("h").alias("gone")))
    keyed = slim.withColumn("key", F.xxhash64("doc_id", "text")).join(hits, "key", "left")
    split = F.split("text", "\n", -1)
    left = F.when(F.col("gone").isNull(), split).otherwise(
        F.filter(split, lambda x: (line_text(x) == "") | ~F.array_contains(F.col("gone"), _hashes(x))))
    done = keyed.select("doc_id", "source", "text", "gone", split.alias("lines"), left.alias("left"))
    return done.select(
        "doc_id", "source", F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join("left", "\n")).alias("text"),
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("lines") - F.size("left"), F.lit(0)).cast("long").alias("n_removed"))
