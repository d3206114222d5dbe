"""Hub/content classification and child listings.

Children are a flat table ``(parent_id, ordinal, <PAGE fields>)``; a page's
child count and child summaries come from one aggregate per parent, joined
to the pages on ``page_id`` (one row per key on the aggregate side).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from .summaries import fallback_page_url, webui_url

# The read hint attached to hub pages.
HUB_READ_HINT = ("This page behaves like a hub/index page. Read the listed child pages or use "
                 "`export-tree-md` for the full hierarchy.")


def is_empty_body(col: Column | str) -> Column:
    """null/empty, or empty after dropping nbsp, comments, blank ``<p>``
    (optionally holding one ``<br>``), ``<br>`` and all whitespace."""
    c = F.col(col) if isinstance(col, str) else col
    v = F.replace(F.replace(c, F.lit("\u00a0"), F.lit(" ")), F.lit("&nbsp;"), F.lit(" "))
    v = F.regexp_replace(v, r"(?s)<!--.*?-->", "")
    v = F.regexp_replace(v, r"(?iU)<p>\s*(<br\s*/?>)?\s*</p>", "")
    v = F.regexp_replace(v, r"(?i)<br\s*/?>", "")
    v = F.regexp_replace(v, r"(?U)\s+", "")
    return c.isNull() | (c == "") | (v == "")


def children_of(pages: DataFrame, children: DataFrame) -> DataFrame:
    """Child summaries per parent, in ``ordinal`` order; a child without
    a URL gets the fallback built from the **parent's** base URL."""
    parent_base = pages.select(F.col("id").alias("parent_id"), F.col("_links.base").alias("parent_base"))
    ch = children.join(parent_base, "parent_id", "left")
    return ch.select(
        "parent_id", "ordinal",
        F.col("id"), F.col("type"), F.col("status"), F.col("title"),
        F.col("space.key").alias("space_key"), F.col("version.number").alias("version"),
        F.coalesce(webui_url(), fallback_page_url(F.col("parent_base"), F.col("id"))).alias("webui_url"),
    )


def classify_pages(pages: DataFrame, children: DataFrame) -> DataFrame:
    """``hub`` iff the body is effectively empty and the page has at least
    one child; else ``content``. Adds child_count and the hub read hint."""
    counts = children.groupBy("parent_id").agg(F.count(F.lit(1)).alias("child_count"))
    p = pages.join(counts, pages["id"] == counts["parent_id"], "left").drop("parent_id")
    empty = is_empty_body(F.col("body.storage.value"))
    n = F.coalesce(F.col("child_count"), F.lit(0)).cast("long")
    kind = F.when(empty & (n > 0), F.lit("hub")).otherwise(F.lit("content"))
    return p.select(
        F.col("id").alias("page_id"), F.col("title"),
        kind.alias("page_kind"),
        empty.alias("body_is_effectively_empty"),
        n.alias("child_count"),
        F.when(kind == "hub", F.lit(HUB_READ_HINT)).alias("read_hint"),
    )


def hub_table_lines(child_summaries: DataFrame) -> DataFrame:
    """D18 rows: one Markdown table row per child, ``(parent_id, ordinal, line)``."""
    title = tx.escape_cell(F.coalesce(F.nullif(F.col("title"), F.lit("")), F.lit("Untitled")))
    pid = tx.escape_cell(F.coalesce(F.col("id"), F.lit("")))
    url = F.coalesce(F.col("webui_url"), F.lit(""))
    link = F.when(url != "", F.concat(F.lit("[Open]("), url, F.lit(")"))).otherwise(F.lit(""))
    return child_summaries.select(
        "parent_id", "ordinal",
        F.concat(F.lit("| "), title, F.lit(" | "), pid, F.lit(" | "), link, F.lit(" |")).alias("line"))


# Hub page header lines.
HUB_HEADER = [
    "> [!INFO] This is a Confluence hub/index page.",
    "> The main content lives in the child pages listed below.",
    "",
    "## Child pages",
    "",
    "| Title | Page ID | Link |",
    "| --- | --- | --- |",
]


def render_hub(child_summaries: DataFrame) -> DataFrame:
    """``(page_id, markdown)`` for each parent with children: callout +
    child table. Bounded by one page's child list."""
    rows = hub_table_lines(child_summaries)
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "line"))),
                                    lambda x: x.getField("line")), "\n")
    return rows.groupBy(F.col("parent_id").alias("page_id")).agg(
        F.concat(F.lit("\n".join(HUB_HEADER) + "\n"), body, F.lit("\n")).alias("markdown"))
