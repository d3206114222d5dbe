"""Registered issue queries (P5-P7, R5, X1-X3) and text-scalar queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import summaries as sm
from ..sources import driver_tables as dt
from . import sqlgen as q
from .catalog import register
from .partitioning import spread

_ISSUE_CTE = """iss AS (
  SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS id, 'ORD-' || CAST(o_orderkey AS VARCHAR) AS key,
    'Order ' || CAST(o_orderkey AS VARCHAR) || ' for ' || c_name AS summary,
    CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Done' ELSE 'In Progress' END AS status,
    o_orderpriority AS issue_type, c_mktsegment AS project_key, c_name AS assignee,
    'Nation ' || CAST(c_nationkey AS VARCHAR) AS reporter,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS updated,
    'https://issues.example.com/browse/ORD-' || CAST(o_orderkey AS VARCHAR) AS browse_url
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey)"""

_ISSUE_COLS = "id, key, summary, status, issue_type, project_key, assignee, reporter, updated, browse_url"


def _issues(spark: SparkSession, sf: str, with_comments: bool = False) -> DataFrame:
    li = spread(dt.table(spark, sf, "lineitem")) if with_comments else None
    return dt.issues(spread(dt.table(spark, sf, "orders")), dt.table(spark, sf, "customer"), li)


@register("issue_summary", f"WITH {_ISSUE_CTE} SELECT {_ISSUE_COLS} FROM iss")
def q_issue_summary(spark: SparkSession, sf: str) -> DataFrame:
    """P5: ten flat issue columns with browse URL."""
    return sm.summarize_issue(_issues(spark, sf), dt.ISSUE_BASE)


@register("issue_search", f"""WITH {_ISSUE_CTE}
SELECT *, count(*) OVER () AS result_count FROM (
  SELECT {_ISSUE_COLS} FROM iss WHERE status = 'Open' AND project_key = 'BUILDING'
  ORDER BY updated DESC, key ASC LIMIT 10 OFFSET 5)""")
def q_issue_search(spark: SparkSession, sf: str) -> DataFrame:
    """X1 + X2: one result page (start 5, limit 10) of a filtered, ordered
    search, with the envelope count (= rows returned). The limit is the feature."""
    s = sm.summarize_issue(_issues(spark, sf), dt.ISSUE_BASE)
    page = sm.search(s, (F.col("status") == "Open") & (F.col("project_key") == "BUILDING"),
                     [F.col("updated").desc(), F.col("key").asc()], start=5, limit=10)
    return sm.search_envelope(page)


_RECENT_SQL = f"""WITH li AS (
  SELECT l_orderkey,
    CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS id,
    'Supplier ' || CAST(l_suppkey AS VARCHAR) AS author,
    strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS created, strftime(l_shipdate, '%Y-%m-%d') AS updated,
    'Ship  ' || CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) || ' units' || chr(10) || ' of part  '
      || CAST(l_partkey AS VARCHAR) || '   flag ' || l_returnflag AS body,
    row_number() OVER (PARTITION BY l_orderkey
      ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_shipdate DESC, l_quantity DESC) AS rdesc,
    count(*) OVER (PARTITION BY l_orderkey) AS n
  FROM lineitem)
SELECT 'ORD-' || CAST(l_orderkey AS VARCHAR) AS key,
  CAST(CASE WHEN l_orderkey % 3 = 1 THEN n + 100 ELSE n END AS BIGINT) AS comment_count,
  CAST(least(n, 3) - rdesc AS INTEGER) AS recent_pos, id, author, created, updated,
  {q.truncate(q.single_line("body"), 280)} AS body_preview
FROM li JOIN orders ON l_orderkey = o_orderkey WHERE rdesc <= 3"""


@register("issue_recent_comments", _RECENT_SQL)
def q_issue_recent_comments(spark: SparkSession, sf: str) -> DataFrame:
    """Last three comments per issue (array order), count = total else length."""
    rc = sm.recent_comments(_issues(spark, sf, with_comments=True), 3)
    return rc.select("key", "comment_count", F.posexplode("recent_comments").alias("recent_pos", "c")).select(
        "key", "comment_count", F.col("recent_pos").cast("int"), "c.id", "c.author", "c.created", "c.updated",
        "c.body_preview")


@register("createmeta_types", """SELECT r_name AS project_key, lower(r_name) AS project_name,
  CAST(n_nationkey AS VARCHAR) AS issue_type_id, n_name AS issue_type_name, n_nationkey % 2 = 0 AS subtask
FROM region LEFT JOIN nation ON n_regionkey = r_regionkey""")
def q_createmeta_types(spark: SparkSession, sf: str) -> DataFrame:
    """Create metadata flattened to (project, issue type) rows."""
    meta = dt.createmeta(dt.table(spark, sf, "region"), dt.table(spark, sf, "nation"))
    return sm.flatten_createmeta(meta)


@register("createmeta_filtered", """SELECT r_name AS project_key, lower(r_name) AS project_name,
  CAST(n_nationkey AS VARCHAR) AS issue_type_id, n_name AS issue_type_name, n_nationkey % 2 = 0 AS subtask
FROM region JOIN nation ON n_regionkey = r_regionkey WHERE r_name = 'ASIA' AND n_name = 'NATION_12'""")
def q_createmeta_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """R5 + P7: create metadata for one project and one issue-type name."""
    meta = dt.createmeta(dt.table(spark, sf, "region"), dt.table(spark, sf, "nation"))
    return sm.flatten_createmeta(sm.filter_createmeta(meta, "ASIA", "NATION_12")).filter(
        F.col("issue_type_id").isNotNull())


# --------------------------------------------------------------------------
# text scalars over pages and documents
# --------------------------------------------------------------------------

@register("page_text", f"""SELECT CAST(page_id AS VARCHAR) AS page_id,
  {q.strip_tags("html")} AS text_clean,
  {q.html_to_text("html")} AS text_plain,
  {q.preview_html("html")} AS preview
FROM pages""")
def q_page_text(spark: SparkSession, sf: str) -> DataFrame:
    """Page markup to clean text, plain text and preview."""
    p = spread(dt.table(spark, sf, "pages"))
    return p.select(F.col("page_id").cast("string").alias("page_id"),
                    tx.strip_tags("html").alias("text_clean"),
                    tx.html_to_text("html").alias("text_plain"),
                    tx.preview_html("html").alias("preview"))


@register("doc_text", f"""SELECT doc_id,
  {q.preview_text("text")} AS preview,
  {q.truncate(q.single_line("text"), 160)} AS excerpt,
  CAST(length({q.single_line("text")}) AS BIGINT) AS collapsed_length,
  {q.sanitize_name("substr(text, 1, 60)")} || '.md' AS file_name
FROM documents""")
def q_doc_text(spark: SparkSession, sf: str) -> DataFrame:
    """T2, T3, T4, T6, T11, G4 over whole document texts."""
    d = spread(dt.table(spark, sf, "documents"))
    one = tx.single_line("text")
    return d.select("doc_id", tx.preview_text("text").alias("preview"),
                    tx.truncate(one, 160).alias("excerpt"),
                    F.length(one).cast("long").alias("collapsed_length"),
                    tx.export_filename(F.substring("text", 1, 60)).alias("file_name"))
