"""Flat projections of nested page / attachment / issue records (P1-P9) and
search paging (X1-X4). All are narrow ``select``s: no shuffle except the
ordering in ``search`` (a bounded top-k, ``TakeOrderedAndProject``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx

# Summary field list used when issue search asks for summaries.
ISSUE_SUMMARY_FIELDS = ["summary", "status", "issuetype", "project", "assignee", "reporter", "updated"]


def _nonempty(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def joined_url(base: Column, path: Column) -> Column:
    """``base + path`` iff both are non-empty, else null."""
    return F.when(_nonempty(base) & _nonempty(path), F.concat(base, path))


def webui_url(prefix: str = "") -> Column:
    return joined_url(F.col(prefix + "_links.base"), F.col(prefix + "_links.webui"))


def fallback_page_url(base: Column, page_id: Column) -> Column:
    """``{base}/pages/viewpage.action?pageId={id}`` (base's trailing '/' stripped)."""
    return F.when(_nonempty(page_id) & _nonempty(base),
                  F.concat(F.rtrim(base, F.lit("/")), F.lit("/pages/viewpage.action?pageId="), page_id))


def parent_id(ancestors: Column | str = "ancestors") -> Column:
    """Id of the last ancestor, else null."""
    a = F.col(ancestors) if isinstance(ancestors, str) else ancestors
    return F.try_element_at(a, F.lit(-1)).getField("id")


def summarize_page(pages: DataFrame) -> DataFrame:
    """Id, type, status, title, space_key, version, webui_url."""
    return pages.select(*page_summary_cols())


def page_summary_cols() -> list[Column]:
    return [
        F.col("id"), F.col("type"), F.col("status"), F.col("title"),
        F.col("space.key").alias("space_key"),
        F.col("version.number").alias("version"),
        webui_url().alias("webui_url"),
    ]


def export_payload(pages: DataFrame) -> DataFrame:
    """P1 + body_html + ancestors (+ parent_page_id)."""
    return pages.select(*page_summary_cols(),
                        F.coalesce(F.col("body.storage.value"), F.lit("")).alias("body_html"),
                        F.coalesce(F.col("ancestors"), F.array().cast("array<struct<id:string>>")).alias("ancestors"),
                        parent_id().alias("parent_page_id"))


def summarize_attachment(att: DataFrame) -> DataFrame:
    """Id, title, media_type, file_size, download_url."""
    return att.select(
        "page_id", "ordinal", "id", "title",
        F.col("metadata.mediaType").alias("media_type"),
        F.col("extensions.fileSize").alias("file_size"),
        joined_url(F.col("_links.base"), F.col("_links.download")).alias("download_url"),
    )


def browse_url(base_url: str, key: Column) -> Column:
    """P5: ``{base}/browse/{key}``; null without a key."""
    return F.when(_nonempty(key), F.concat(F.lit(base_url.rstrip("/") + "/browse/"), key))


def summarize_issue(issues: DataFrame, base_url: str) -> DataFrame:
    """P5: ten flat columns; ``updated`` kept as the source string."""
    return issues.select(
        F.col("id"), F.col("key"),
        F.col("fields.summary").alias("summary"),
        F.col("fields.status.name").alias("status"),
        F.col("fields.issuetype.name").alias("issue_type"),
        F.col("fields.project.key").alias("project_key"),
        F.col("fields.assignee.displayName").alias("assignee"),
        F.col("fields.reporter.displayName").alias("reporter"),
        F.col("fields.updated").alias("updated"),
        browse_url(base_url, F.col("key")).alias("browse_url"),
    )


def recent_comments(issues: DataFrame, n: int = 3) -> DataFrame:
    """The last ``n`` comments in array order (n <= 0: all), plus
    ``comment_count`` = ``total`` when present, else the array length.

    Returns (id, key, comment_count, recent ARRAY<STRUCT>) -- each issue's
    array is already bounded by the source record.
    """
    comments = F.coalesce(F.col("fields.comment.comments"), F.array())
    size = F.size(comments)
    if n > 0:
        # slice(a, -n, n) is empty when size < n, so start at max(size-n, 0)+1.
        limited = F.slice(comments, F.greatest(size - F.lit(n), F.lit(0)) + 1, F.lit(n))
    else:
        limited = comments
    recent = F.transform(limited, lambda c: F.struct(
        c.getField("id").alias("id"),
        c.getField("author").getField("displayName").alias("author"),
        c.getField("created").alias("created"),
        c.getField("updated").alias("updated"),
        tx.comment_preview(c.getField("body")).alias("body_preview")))
    return issues.select(
        "id", "key",
        F.coalesce(F.col("fields.comment.total"), size.cast("long")).alias("comment_count"),
        recent.alias("recent_comments"))


def flatten_createmeta(meta: DataFrame) -> DataFrame:
    """Projects -> issue types, one row per (project, issue type); a
    project without types keeps one row with null type fields."""
    p = meta.select(F.explode_outer("projects").alias("p"))
    t = p.select(F.col("p.key").alias("project_key"), F.col("p.name").alias("project_name"),
                 F.explode_outer("p.issuetypes").alias("t"))
    return t.select("project_key", "project_name",
                    F.col("t.id").alias("issue_type_id"), F.col("t.name").alias("issue_type_name"),
                    F.col("t.subtask").alias("subtask"))


def filter_createmeta(meta: DataFrame, project: str, issue_type: str | None = None) -> DataFrame:
    """Keep the requested project (and issue-type name if given)."""
    keep = F.filter("projects", lambda p: p.getField("key") == project)
    if issue_type is not None:
        keep = F.transform(keep, lambda p: p.withField(
            "issuetypes", F.filter(p.getField("issuetypes"), lambda t: t.getField("name") == issue_type)))
    return meta.select(keep.alias("projects"))


def search(df: DataFrame, predicate: Column | None, order_by: Sequence[Column | str],
           start: int = 0, limit: int = 10) -> DataFrame:
    """Filtered, ordered page of rows. ``order_by`` must end in a unique
    key so the page is deterministic; Catalyst turns sort+limit into a top-k."""
    out = df if predicate is None else df.filter(predicate)
    out = out.orderBy(*order_by)
    if start:
        out = out.offset(start)
    return out.limit(limit)


def search_envelope(page: DataFrame) -> DataFrame:
    """Each result row plus ``count`` = rows returned (not total matches).
    The page is at most ``limit`` rows, so the global window is bounded."""
    return page.withColumn("result_count", F.count(F.lit(1)).over(Window.partitionBy()))


def merge_fields(user: str | None, required: Sequence[str]) -> str | None:
    """X3 (driver-side list merge): trimmed, ordered de-dup, user fields
    first; None when empty."""
    tokens: list[str] = []
    for value in (user, ",".join(required)):
        if not value:
            continue
        for token in value.split(","):
            item = token.strip()
            if item and item not in tokens:
                tokens.append(item)
    return ",".join(tokens) if tokens else None


def merge_fields_col(user: Column, required: Sequence[str]) -> Column:
    """X3 as a column: comma lists merged with ``array_distinct(concat(...))``."""
    parts = F.transform(F.split(F.coalesce(user, F.lit("")), ","), lambda t: tx.strip(t))
    merged = F.array_distinct(F.filter(F.concat(parts, F.array(*[F.lit(r) for r in required])),
                                       lambda t: t != ""))
    return F.when(F.size(merged) > 0, F.array_join(merged, ","))


def raw(df: DataFrame) -> DataFrame:
    """Unchanged nested record, as one JSON document per row."""
    return df.select(F.to_json(F.struct("*")).alias("raw"))
