"""Readers with explicit schemas (R1-R5, R7), offset-batch merge (R6) and
sinks (Z1, Z2).

Captured API responses are JSON lines (one record per line); every reader
passes the schema so nothing is inferred from a sample.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.scans import ordered_running_sum
from . import schemas as S


def _json(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return spark.read.schema(S.struct_type(ddl)).option("mode", "PERMISSIVE").json(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """PAGE records."""
    return _json(spark, path, S.PAGE_DDL)


def read_children(spark: SparkSession, path: str) -> DataFrame:
    """CHILD rows (parent_id, ordinal + PAGE)."""
    return _json(spark, path, S.CHILD_DDL)


def read_comments(spark: SparkSession, path: str) -> DataFrame:
    """R2: inline comments with history / resolution / anchor."""
    return _json(spark, path, S.COMMENT_DDL)


def read_attachments(spark: SparkSession, path: str) -> DataFrame:
    """Attachments of pages."""
    return _json(spark, path, S.ATTACHMENT_DDL)


def read_issues(spark: SparkSession, path: str) -> DataFrame:
    """Issues with the requested fields."""
    return _json(spark, path, S.ISSUE_DDL)


def read_createmeta(spark: SparkSession, path: str, project: str, issue_type: str | None = None) -> DataFrame:
    """Create metadata filtered to one project (and issue type)."""
    from ..operators.summaries import filter_createmeta
    return filter_createmeta(_json(spark, path, S.CREATEMETA_DDL), project, issue_type)


def read_markdown(spark: SparkSession, glob: str) -> DataFrame:
    """Exported documents as ``(path, text)`` rows, one per file (whole text)."""
    # text()'s own ``wholetext`` argument overrides an option set earlier
    return (spark.read.text(glob, wholetext=True)
            .select(F.input_file_name().alias("path"), F.col("value").alias("text")))


def merge_offset_batches(batches: DataFrame, limit: int, key: str = "entity_id",
                         bucket_width: int = 1 << 20) -> DataFrame:
    """Rebuild complete lists from offset-paged batches.

    Per entity: start at offset 0, take a batch, stop at an empty batch or one
    shorter than ``limit``; the next batch must start at start + size.
    Returns ``(entity_id, position, item)`` with position = start + index.
    Both running quantities are prefix scans over the same ranges of (entity,
    start), so an entity with a huge number of batches is not sorted in one task.
    """
    b = batches.select(key, "start", "results", F.coalesce(F.size("results"), F.lit(0)).alias("size"))
    b = ordered_running_sum(b, [key], "start", "size", "size_incl", bucket_width, keep_ranges=True)
    b = b.withColumn("expected_start", F.col("size_incl") - F.col("size"))
    stop = ((F.col("size") == 0) | (F.col("size") < limit) | (F.col("start") != F.col("expected_start")))
    b = b.withColumn("stop", stop.cast("int"))
    b = ordered_running_sum(b, [key], "start", "stop", "stops_incl", bucket_width)
    # a batch is kept if no earlier batch stopped the chain, it starts where
    # the chain expects and it is not empty (a short batch is kept, then ends it)
    keep = ((F.col("stops_incl") - F.col("stop")) == 0) & (F.col("start") == F.col("expected_start")) \
        & (F.col("size") > 0)
    kept = b.filter(keep)
    return kept.select(key, "start", F.posexplode("results").alias("idx", "item")).select(
        key, (F.col("start") + F.col("idx")).alias("position"), "item")


def write_rows(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "json") -> None:
    """One JSON object per result row (non-ASCII kept), or ``key: value``
    text lines per row (``fmt="text"``)."""
    if fmt == "json":
        df.write.mode(mode).option("ignoreNullFields", "false").json(path)
    else:
        kv = F.concat_ws("\n", *[F.concat(F.lit(c + ": "), F.coalesce(F.col(c).cast("string"), F.lit("None")))
                                 for c in df.columns])
        df.select(kv.alias("value")).write.mode(mode).text(path)


def write_export(content: DataFrame, manifest: DataFrame, path: str) -> None:
    """Content ``(page_id, output_file, markdown)`` and manifest
    ``(page_id, title, output_file, source_url, parent_page_id)`` as parquet,
    replacing the target snapshot."""
    content.write.mode("overwrite").parquet(f"{path.rstrip('/')}/content")
    manifest.select("page_id", "title", "output_file", "source_url", "parent_page_id") \
        .write.mode("overwrite").parquet(f"{path.rstrip('/')}/manifest")


def publish_snapshot(content: DataFrame, path: str, manifest: DataFrame | None = None) -> str:
    """Z2 in two phases: the new snapshot is written beside the old ones, then one row that names it is published.

    Readers (``read_snapshot``) follow the newest published row, so a writer
    that dies between the phases leaves the old snapshot in force. Returns the
    snapshot's folder.
    """
    spark, root = content.sparkSession, path.rstrip("/")
    folder = f"{root}/snapshots/{uuid.uuid4().hex}"
    content.write.parquet(f"{folder}/content")
    if manifest is not None:
        manifest.write.parquet(f"{folder}/manifest")
    number = (_published(spark, root) or (0, ""))[0] + 1
    spark.createDataFrame([(number, folder)], _PUBLISHED).coalesce(1).write.mode("append").json(f"{root}/published")
    return folder


_PUBLISHED = "number long, folder string"


def _published(spark: SparkSession, root: str) -> tuple[int, str] | None:
    """The newest published snapshot: one row."""
    try:
        rows = spark.read.schema(_PUBLISHED).json(f"{root}/published")
    except AnalysisException:  # nothing published yet
        return None
    last = rows.orderBy(F.desc("number"), "folder").first()
    return (last["number"], last["folder"]) if last else None


def read_snapshot(spark: SparkSession, path: str, part: str = "content") -> DataFrame:
    """The published snapshot under ``path``."""
    found = _published(spark, path.rstrip("/"))
    if found is None:
        raise FileNotFoundError(f"no snapshot published under {path}")
    return spark.read.parquet(f"{found[1]}/{part}")
