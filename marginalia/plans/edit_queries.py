"""Registered section-edit queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import sections as se
from ..sources import driver_tables as dt
from . import sqlgen as q
from .catalog import register
from .partitioning import spread


def order_pages(orders: DataFrame) -> DataFrame:
    """orders -> multi-heading pages: most have one top-level ``Install``
    section holding an h3, some lack it, some repeat it, some also nest an
    ``Install`` heading inside a div (not top-level, never matched)."""
    k = F.col("o_orderkey")
    ks = k.cast("string")
    body = F.concat(
        F.lit("<h1>Order "), ks, F.lit("</h1><p>intro "), ks, F.lit("</p>"),
        F.when(k % 4 == 1, F.lit("")).otherwise(
            F.concat(F.lit("<h2>Install</h2><p>step "), ks, F.lit("</p><h3>Sub</h3><p>nested</p>"))),
        F.lit("<h2>Usage</h2><p>use</p>"),
        F.when(k % 6 == 0, F.lit("<h2>Install</h2><p>again</p>")).otherwise(F.lit("")),
        F.when(k % 5 == 0, F.lit("<div><h2>Install</h2></div>")).otherwise(F.lit("")))
    return orders.select(ks.alias("page_id"), body.alias("body"))


def install_edits(orders: DataFrame) -> DataFrame:
    ks = F.col("o_orderkey").cast("string")
    return orders.select(F.col("o_orderkey").alias("seq"), ks.alias("page_id"), F.lit("  Install ").alias("heading"),
                         F.concat(F.lit("<p>new "), ks, F.lit("</p>")).alias("replacement_html"))


_K = "CAST(o_orderkey AS VARCHAR)"
_OLD = f"'<p>step ' || {_K} || '</p><h3>Sub</h3><p>nested</p>'"
_NEW = f"'<p>new ' || {_K} || '</p>'"
_UPD = (f"'<h1>Order ' || {_K} || '</h1><p>intro ' || {_K} || '</p><h2>Install</h2>' || {_NEW} "
        f"|| '<h2>Usage</h2><p>use</p>' || CASE WHEN o_orderkey % 5 = 0 THEN '<div><h2>Install</h2></div>' ELSE '' END")

_SECTIONS_SQL = f"""WITH o AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 1 THEN 'not_found' WHEN o_orderkey % 6 = 0 THEN 'ambiguous'
                          ELSE 'ok' END AS status FROM orders)
SELECT o_orderkey AS seq, {_K} AS page_id, '  Install ' AS heading, status,
  CASE status WHEN 'not_found' THEN 'replace-section target heading "  Install " was not found.'
              WHEN 'ambiguous' THEN 'replace-section target heading "  Install " is ambiguous because it appears multiple times.'
  END AS error,
  CASE WHEN status = 'ok' THEN 'Install' END AS matched_heading,
  CASE WHEN status = 'ok' THEN 2 END AS heading_level,
  CASE WHEN status = 'ok' THEN {_OLD} END AS old_section_html,
  CASE WHEN status = 'ok' THEN {_NEW} END AS new_section_html,
  CASE WHEN status = 'ok' THEN {_UPD} END AS updated_body_html,
  CASE WHEN status = 'ok' THEN {q.preview_html(_OLD)} END AS old_section_preview,
  CASE WHEN status = 'ok' THEN {q.preview_html(_NEW)} END AS new_section_preview,
  CASE WHEN status = 'ok' THEN {q.preview_html(_UPD)} END AS resulting_body_preview
FROM o"""


@register("replace_sections", _SECTIONS_SQL)
def q_replace_sections(spark: SparkSession, sf: str) -> DataFrame:
    """E1-E3 + B3: bulk top-level section replacement with match status and previews."""
    orders = spread(dt.table(spark, sf, "orders"))
    out = se.replace_sections(order_pages(orders), install_edits(orders))
    return out.withColumn("heading_level", F.col("heading_level").cast("int"))


# --------------------------------------------------------------------------
# many edits of a page
# --------------------------------------------------------------------------

def batch_pages(customer: DataFrame) -> DataFrame:
    """A page for ten customers: five sections with marked-up headings and loose text after them; one page in 17 is malformed."""
    page = F.floor(F.col("c_custkey") / 10)
    p = F.col("page").cast("string")
    parts = [x for j in range(5) for x in (F.lit(f"<h2>S<b>{j}</b></h2>tail{j}<p>orig "), p, F.lit(f"-{j}</p>"))]
    body = F.concat(F.lit("<h1>Page "), p, F.lit("</h1>"), *parts, F.when(F.col("page") % 17 == 16, "<br>").otherwise(""))
    return customer.select(page.alias("page")).distinct().select(p.alias("page_id"), body.alias("body"))


def batch_edits(orders: DataFrame) -> DataFrame:
    """An edit for each order of the page's customers; some sections don't exist, some replacements don't parse."""
    k = F.col("o_orderkey")
    new = F.when(k % 29 == 0, F.lit("<p>bad")).otherwise(F.concat(F.lit("loose<p>order "), k.cast("string"), F.lit("</p>")))
    return orders.select(k.alias("seq"), F.floor(F.col("o_custkey") / 10).cast("string").alias("page_id"),
                         F.concat(F.lit(" S"), (k % 6).cast("string"), F.lit("  ")).alias("heading"), new.alias("replacement_html"))


def _batches(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return se.replace_sections_folded(batch_pages(dt.table(spark, sf, "customer")),
                                      batch_edits(spread(dt.table(spark, sf, "orders"))))


_BATCH = """WITH o AS (
  SELECT o_orderkey AS k, o_custkey // 10 AS page, o_orderkey % 6 AS j,
    CASE WHEN (o_custkey // 10) % 17 = 16 THEN 'malformed' WHEN o_orderkey % 6 = 5 THEN 'not_found'
         WHEN o_orderkey % 29 = 0 THEN 'malformed' ELSE 'ok' END AS status FROM orders)"""


@register("section_batches", f"""{_BATCH},
g AS (SELECT *, lag(k) OVER (PARTITION BY page, j, status = 'ok' ORDER BY k) AS prev FROM o)
SELECT k AS seq, CAST(page AS VARCHAR) AS page_id, status,
  CASE status WHEN 'malformed' THEN '{se.PARSE_ERROR}'
    WHEN 'not_found' THEN 'replace-section target heading " S' || CAST(j AS VARCHAR) || '  " was not found.' END AS error,
  CASE WHEN status = 'ok' THEN 'S' || CAST(j AS VARCHAR) END AS matched_heading,
  CASE WHEN status <> 'ok' THEN NULL WHEN prev IS NULL THEN '<p>orig ' || CAST(page AS VARCHAR) || '-' || CAST(j AS VARCHAR) || '</p>'
    ELSE '<p>order ' || CAST(prev AS VARCHAR) || '</p>' END AS old_section_html FROM g""")
def q_section_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Results of some hundred edits a page, folded in order."""
    results, _ = _batches(spark, sf)
    return results.select("seq", "page_id", "status", "error", "matched_heading", "old_section_html")


_BATCH_SECTIONS = " || ".join(
    f"'<h2>S<b>{j}</b></h2>tail{j}<p>' || COALESCE('order ' || CAST(l{j} AS VARCHAR), 'orig ' || CAST(c.page AS VARCHAR) || '-{j}') || '</p>'"
    for j in range(5))


@register("section_batch_bodies", f"""{_BATCH},
n AS (SELECT page, {", ".join(f"max(k) FILTER (WHERE j = {j} AND status = 'ok') AS l{j}" for j in range(5))} FROM o GROUP BY page),
c AS (SELECT DISTINCT c_custkey // 10 AS page FROM customer)
SELECT CAST(c.page AS VARCHAR) AS page_id, '<h1>Page ' || CAST(c.page AS VARCHAR) || '</h1>' || {_BATCH_SECTIONS}
  || CASE WHEN c.page % 17 = 16 THEN '<br>' ELSE '' END AS body FROM c LEFT JOIN n ON c.page = n.page""")
def q_section_batch_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """The pages after all their edits."""
    _, bodies = _batches(spark, sf)
    return bodies
