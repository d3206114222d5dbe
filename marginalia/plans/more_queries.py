"""Registered queries for the remaining operators: C9 digest, C10, P4, B1,
B4, U1, U6, U7, S4."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import changes as ch
from ..operators import freshness as fr
from ..operators import summaries as sm
from ..operators import threads as th
from ..session import ensure_checkpoint_dir
from ..sources import driver_tables as dt
from . import sqlgen as sq
from .catalog import EXPORTED_AT, ORACLES, _EVENT_RAW_SQL, _event_threads, _threads_sql, register
from .change_queries import _validated

_NL = "chr(10)"

# --------------------------------------------------------------------------
# C9 digest lines, C10 comments with page
# --------------------------------------------------------------------------

def _digest_ctes(status: str = "all") -> str:
    chosen = "" if status == "all" else (
        f" WHERE (page_id, thread_key) IN (SELECT page_id, thread_key FROM a WHERE status = '{status}')")
    matching = "count(*)" if status == "all" else f"count(*) FILTER (WHERE status = '{status}')"
    return f""",
ts AS (SELECT * FROM tr{chosen}),
cs AS (SELECT * FROM a{chosen}),
pa AS (SELECT page_id, count(*) AS all_n, {matching} AS match_n FROM a GROUP BY page_id),
pc AS (SELECT page_id, count(own_key) AS anch, count(*) - count(own_key) AS reply,
         count(*) FILTER (WHERE status = 'open') AS n_open, count(*) FILTER (WHERE status = 'resolved') AS n_res,
         count(*) FILTER (WHERE status = 'dangling') AS n_dan FROM cs GROUP BY page_id),
pt AS (SELECT page_id, count(*) AS tc, count(*) FILTER (WHERE status = 'open') AS oc FROM ts GROUP BY page_id),
hd AS (SELECT page_id, 'Page ' || page_id AS title, 'https://wiki.example.com/spaces/EV/pages/' || page_id AS url,
         all_n, match_n, COALESCE(anch, 0) AS anch, COALESCE(reply, 0) AS reply, COALESCE(n_open, 0) AS n_open,
         COALESCE(n_res, 0) AS n_res, COALESCE(n_dan, 0) AS n_dan, COALESCE(tc, 0) AS tc, COALESCE(oc, 0) AS oc
       FROM pa LEFT JOIN pc USING (page_id) LEFT JOIN pt USING (page_id)),
hl AS (SELECT page_id, ['---', 'title: "' || replace(title || ' - Inline Comment Summary', '"', chr(39)) || '"',
         'confluence_page_id: ' || page_id, 'source_url: ' || url, 'exported_at: {EXPORTED_AT}', '---', '',
         '# ' || title || ' - Inline Comment Summary', '', 'Source page: ' || url, '', '## Quick Summary', '',
         '- Total inline comments fetched: ' || all_n, '- Matching comments for filter `{status}`: ' || match_n,
         '- Anchored comments: ' || anch, '- Reply comments: ' || reply, '- Threads to review: ' || tc,
         '- Open threads: ' || oc,
         '- Comment status distribution: open ' || n_open || ', resolved ' || n_res || ', dangling ' || n_dan,
         '', '## Threads', '',
         CASE WHEN tc = 0 THEN '- No inline comment threads matched the requested filter.' END] AS lst FROM hd),
sec AS (SELECT DISTINCT page_id, CASE WHEN status_rank = 99 THEN 3 ELSE status_rank END AS k1,
         CASE status_rank WHEN 0 THEN 'Open' WHEN 1 THEN 'Dangling' WHEN 2 THEN 'Resolved' ELSE 'Other' END AS label
       FROM ts),
tl AS (SELECT page_id, CASE WHEN status_rank = 99 THEN 3 ELSE status_rank END AS k1, lower(selection) AS k2,
         first_position AS k3,
         ['- `' || selection || '`',
          '  Status: ' || status || ' | Comments: ' || comment_count || ' | Participants: '
            || COALESCE(NULLIF(participants, ''), 'Unknown'),
          CASE WHEN latest_comment_at <> '' THEN '  Latest comment at: ' || latest_comment_at END,
          CASE WHEN latest_comment_excerpt <> '' THEN '  Latest note: ' || latest_comment_excerpt END,
          CASE WHEN latest_comment_url <> '' THEN '  Link: ' || latest_comment_url END, ''] AS lst FROM ts)"""

_DIGEST_SELECT = """SELECT * FROM (
  SELECT page_id, -1 AS k1, '' AS k2, CAST(-1 AS BIGINT) AS k3, CAST(unnest(generate_series(0, len(lst) - 1)) AS INTEGER)
    AS k4, unnest(lst) AS line FROM hl
  UNION ALL
  SELECT page_id, k1, '' AS k2, CAST(-1 AS BIGINT), CAST(unnest([0, 1]) AS INTEGER), unnest(['### ' || label, ''])
    FROM sec
  UNION ALL
  SELECT page_id, k1, k2, CAST(k3 AS BIGINT), CAST(unnest(generate_series(0, 5)) AS INTEGER), unnest(lst) FROM tl
) WHERE line IS NOT NULL"""


@register("comment_digest", _threads_sql(_EVENT_RAW_SQL, dt.WIKI_BASE, _DIGEST_SELECT, _digest_ctes()))
def q_comment_digest(spark: SparkSession, sf: str) -> DataFrame:
    """C8 + C9: the per-page Markdown digest as ordered line rows."""
    return _digest(spark, sf).select("page_id", F.col("k1").cast("int"), "k2", F.col("k3").cast("long"),
                                     F.col("k4").cast("int"), "line")


def _digest(spark: SparkSession, sf: str, status: str = "all") -> DataFrame:
    pages = dt.pages_for_comments(dt.table(spark, sf, "events"))
    return th.digest_lines(_event_threads(spark, sf), pages, EXPORTED_AT, status)


def _document_sql(status: str) -> str:
    text = sq.strip("string_agg(line, chr(10) ORDER BY k1, k2, k3, k4)")
    return _threads_sql(_EVENT_RAW_SQL, dt.WIKI_BASE, f"SELECT page_id, {text} || chr(10) AS markdown "
                        f"FROM ({_DIGEST_SELECT}) GROUP BY page_id", _digest_ctes(status))


@register("digest_documents", _document_sql("all"))
def q_digest_documents(spark: SparkSession, sf: str) -> DataFrame:
    """One Markdown digest per page."""
    return th.assemble_lines(_digest(spark, sf))


@register("resolved_digests", _document_sql("resolved"))
def q_resolved_digests(spark: SparkSession, sf: str) -> DataFrame:
    """C6 + C9: digests of the threads that hold a resolved comment; pages without one say so."""
    return th.assemble_lines(_digest(spark, sf, "resolved"))


@register("comments_with_page", """SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS page_id,
  CASE WHEN user_id % 10 = 0 THEN 'Untitled' ELSE 'Page ' || CAST(user_id AS VARCHAR) END AS page_title,
  CASE WHEN user_id % 10 = 0 THEN ''
       ELSE 'https://wiki.example.com/spaces/EV/pages/' || CAST(user_id AS VARCHAR) END AS page_url
FROM events""")
def q_comments_with_page(spark: SparkSession, sf: str) -> DataFrame:
    """Comments with their page's title and URL (defaults when the page is unknown)."""
    ev = dt.table(spark, sf, "events")
    comments = th.normalize_comments(dt.comments_from_events(ev), dt.WIKI_BASE)
    pages = dt.pages_for_comments(ev.filter(F.col("user_id") % 10 != 0))
    return th.comments_with_page(comments, pages).select("id", "page_id", "page_title", "page_url")


# --------------------------------------------------------------------------
# P4 attachment summaries
# --------------------------------------------------------------------------

def part_attachment_records(part: DataFrame) -> DataFrame:
    """part -> ATTACHMENT records (a few without a base URL, so no download URL)."""
    k = F.col("p_partkey")
    page = (k % 50).cast("string")
    title = F.concat(F.col("p_name"), F.lit(".png"))
    return part.select(
        page.alias("page_id"), k.alias("ordinal"), F.concat(F.lit("att-"), k.cast("string")).alias("id"),
        title.alias("title"), F.struct(F.lit("image/png").alias("mediaType")).alias("metadata"),
        F.struct((F.col("p_size") * 1000).cast("long").alias("fileSize")).alias("extensions"),
        F.struct(F.when(k % 7 == 0, F.lit(None)).otherwise(F.lit(dt.WIKI_BASE)).alias("base"),
                 F.concat(F.lit("/download/attachments/"), page, F.lit("/"), F.col("p_name"), F.lit(".png"))
                 .alias("download")).alias("_links"))


@register("attachment_summary", f"""SELECT CAST(p_partkey % 50 AS VARCHAR) AS page_id, p_partkey AS ordinal,
  'att-' || CAST(p_partkey AS VARCHAR) AS id, p_name || '.png' AS title, 'image/png' AS media_type,
  CAST(p_size * 1000 AS BIGINT) AS file_size,
  CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE '{dt.WIKI_BASE}/download/attachments/'
    || CAST(p_partkey % 50 AS VARCHAR) || '/' || p_name || '.png' END AS download_url
FROM part""")
def q_attachment_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Attachment summaries with joined download URLs."""
    return sm.summarize_attachment(part_attachment_records(dt.table(spark, sf, "part")))


# --------------------------------------------------------------------------
# B1 / B4 previews, U1 / U6 applies, U7 conflicts
# --------------------------------------------------------------------------

_K = "CAST(o_orderkey AS VARCHAR)"
_INTENT_OK = "NOT (o_orderkey % 3 = 0 AND o_orderkey % 7 <> 0)"


@register("create_previews", f"""SELECT 'req-' || {_K} AS request_id, 'SP' || CAST(o_orderkey % 4 AS VARCHAR) AS space_key,
  CAST(o_custkey % 40 AS VARCHAR) AS parent_id,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE 'T' || {_K} END AS title,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE 'storage_html' END AS body_source,
  CAST(CASE WHEN o_orderkey % 13 = 0 THEN 0 ELSE 8 END AS INTEGER) AS body_length,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE 'b' END AS body_preview
FROM orders WHERE o_orderkey % 5 = 0 AND o_orderkey % 7 = 0 AND o_orderkey % 4 < 3 AND o_orderkey % 11 <> 0
  AND o_custkey % 40 < 25""")
def q_create_previews(spark: SparkSession, sf: str) -> DataFrame:
    """B1: dry-run create-page previews of valid requests."""
    return ch.preview_create(_validated(spark, sf))


@register("move_previews", f"""SELECT 'req-' || {_K} AS request_id, {_K} AS page_id, 'Order ' || {_K} AS page_title,
  CAST(o_orderkey % 5 + 1 AS BIGINT) AS current_version,
  CAST((o_custkey + o_orderkey % 2) % 30 AS VARCHAR) AS current_parent_id,
  CAST(o_custkey % 30 AS VARCHAR) AS new_parent_id, true AS parent_changed
FROM orders WHERE o_orderkey % 5 = 2 AND o_orderkey % 7 = 0 AND o_custkey % 30 < 25 AND o_orderkey % 2 = 1""")
def q_move_previews(spark: SparkSession, sf: str) -> DataFrame:
    """Dry-run move-page previews (current vs new parent)."""
    orders = dt.table(spark, sf, "orders")
    live = orders.select(F.col("o_orderkey").cast("string").alias("id"),
                         F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title"),
                         (F.col("o_orderkey") % 5 + 1).cast("long").alias("version"))
    return ch.preview_move(_validated(spark, sf), live)


@register("apply_creates", f"""SELECT {_K} AS id, 'Order ' || {_K} AS title, '<p>order ' || {_K} || '</p>' AS body,
  CAST(o_orderkey % 5 + 1 AS BIGINT) AS version, CAST(NULL AS VARCHAR) AS parent_id FROM orders
UNION ALL
SELECT 'new-req-' || {_K}, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE 'T' || {_K} END,
  CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE '<p>b</p>' END, CAST(1 AS BIGINT), CAST(o_custkey % 40 AS VARCHAR)
FROM orders
WHERE o_orderkey % 5 = 0 AND o_orderkey % 7 <> 0 AND o_orderkey % 3 <> 0 AND o_orderkey % 4 < 3
  AND o_orderkey % 11 <> 0 AND o_custkey % 40 < 25""")
def q_apply_creates(spark: SparkSession, sf: str) -> DataFrame:
    """Next page snapshot with the valid apply-mode creates appended."""
    orders = dt.table(spark, sf, "orders")
    live = orders.select(F.col("o_orderkey").cast("string").alias("id"),
                         F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title"),
                         F.concat(F.lit("<p>order "), F.col("o_orderkey").cast("string"), F.lit("</p>")).alias("body"),
                         (F.col("o_orderkey") % 5 + 1).cast("long").alias("version"),
                         F.lit(None).cast("string").alias("parent_id"))
    return ch.apply_creates(live, _validated(spark, sf))


@register("apply_comments", f"""SELECT 'ORD-' || CAST(l_orderkey AS VARCHAR) AS issue_key, CAST(l_linenumber AS BIGINT) AS ordinal,
  CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id, 'line ' || CAST(l_partkey AS VARCHAR) AS body
FROM lineitem
UNION ALL
SELECT 'ORD-' || {_K}, 1 + COALESCE((SELECT max(l_linenumber) FROM lineitem WHERE l_orderkey = o_orderkey), 0), 'new-req-' || {_K}, 'Comment for ' || {_K} || '  with   spaces'
FROM orders WHERE o_orderkey % 5 = 4 AND o_orderkey % 3 <> 0 AND o_orderkey % 7 <> 0""")
def q_apply_comments(spark: SparkSession, sf: str) -> DataFrame:
    """Issue comments after appending the valid apply-mode comments."""
    li = dt.table(spark, sf, "lineitem")
    existing = li.select(F.concat(F.lit("ORD-"), F.col("l_orderkey").cast("string")).alias("issue_key"),
                         F.col("l_linenumber").cast("long").alias("ordinal"),
                         F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                                  F.col("l_linenumber").cast("string")).alias("id"),
                         F.concat(F.lit("line "), F.col("l_partkey").cast("string")).alias("body"))
    return ch.apply_comments(existing, _validated(spark, sf))


@register("change_conflicts", f"""SELECT 'req-' || {_K} AS request_id, {_K} AS page_id,
  CAST(o_orderkey % 6 + 1 AS BIGINT) AS base_version, CAST(o_orderkey % 5 + 1 AS BIGINT) AS live_version
FROM orders WHERE o_orderkey % 6 <> o_orderkey % 5""")
def q_change_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    """Edits whose base version is not the live version (the 409 case)."""
    orders = dt.table(spark, sf, "orders")
    changes = orders.select(F.concat(F.lit("req-"), F.col("o_orderkey").cast("string")).alias("request_id"),
                            F.col("o_orderkey").cast("string").alias("page_id"),
                            (F.col("o_orderkey") % 6 + 1).cast("long").alias("base_version"))
    live = orders.select(F.col("o_orderkey").cast("string").alias("id"),
                         (F.col("o_orderkey") % 5 + 1).cast("long").alias("version"))
    return ch.detect_conflicts(changes, live).select("request_id", "page_id", "base_version", "live_version")


# --------------------------------------------------------------------------
# S4 refresh: the oracles of its two parts joined
# --------------------------------------------------------------------------

def _refresh_sql() -> str:
    from . import markup_queries, page_queries  # noqa: F401  (they register the two oracles)
    return (f"SELECT s.file, s.page_id, s.title, s.remote_version, m.markdown FROM ({ORACLES['stale_exports']}) s "
            f"JOIN ({ORACLES['export_markdown']}) m ON s.page_id = m.page_id WHERE s.is_stale")


@register("refresh_exports", _refresh_sql())
def q_refresh_exports(spark: SparkSession, sf: str) -> DataFrame:
    """Re-render the stale exported files from the live pages."""
    from .markup_queries import exported_pages
    from .page_queries import q_stale_exports
    ensure_checkpoint_dir(spark)
    stale = fr.refresh_set(q_stale_exports(spark, sf), stale_only=True).checkpoint(eager=True)
    return stale.join(exported_pages(spark, sf, only=stale).select("page_id", "markdown"), "page_id").select(
        "file", "page_id", "title", "remote_version", "markdown")
