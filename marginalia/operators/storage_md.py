"""Structured storage markup -> Markdown for well-formed bodies.

A body is one value, so rendering is an expression of its row: the fold of
``markup_fold`` over the tokens, then line rules and clean text (T7). Nothing
is shuffled, and containers nest to any depth.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from .markup_fold import Renderer


def _rx(c: Column, pattern: str, repl: str) -> Column:
    return F.regexp_replace(c, F.lit(pattern), F.lit(repl))


# The patterns of the line rules define what the export looks like.
def _postprocess_line(line: Column) -> Column:
    """D17 line rules: odd ``**`` / ``*`` counts drop all ``*``; an image
    that does not start its line moves to its own paragraph; deep list
    indents are clamped; table lines are only right-stripped."""
    n2 = (F.length(line) - F.length(F.replace(line, F.lit("**"), F.lit("")))) / 2
    n1 = F.length(line) - F.length(F.replace(line, F.lit("*"), F.lit("")))
    no_star = F.when(F.contains(line, F.lit("*")) & ((n2 % 2 == 1) | (n1 % 2 == 1)), F.replace(line, F.lit("*"), F.lit(""))).otherwise(line)

    # only the first image moves (Python's replace(..., 1))
    def moved(x: Column) -> Column:
        return F.when(F.contains(x, F.lit("![")) & ~tx.lstrip(x).startswith("!["), F.concat(
            F.substring_index(x, "![", 1), F.lit("\n\n!["), F.substring(x, F.instr(x, "![") + 2, 1 << 30))).otherwise(x)

    def clamped(x: Column) -> Column:
        return F.when(x.startswith(" " * 10), F.regexp_replace(F.regexp_replace(x, r"^ {10,}(- )", "        $1"),
                                                               r"^ {12,}(\d+\. )", "        $1")).otherwise(x)

    rest = tx.let(no_star, lambda x: tx.let(moved(x), lambda y: tx.rstrip(clamped(y))))
    return F.when(tx.lstrip(line).startswith("|"), tx.rstrip(line)).otherwise(rest)


def postprocess(v: Column) -> Column:
    """De-indent tables, separate images, tidy emphasis and indents."""
    v = _rx(v, r"(?m)^[ \t]+(?=\|)", "")
    v = _rx(v, r"(?<!\n)(!\[[^\]]+\]\([^)]+\))", "\n\n$1")
    v = _rx(v, r"(?m)^([ \t]*)-\s+([^\n]*?)\n\n(!\[)", "$1- $2\n\n$3")
    v = _rx(v, r"(?m)^([ \t]*)\*\*([^:\n]+):\*\*\s*([^\n]+?)\n\n(!\[)", "$1**$2:** $3\n\n$4")
    v = F.array_join(F.transform(F.split(v, "\n", -1), _postprocess_line), "\n")
    return _rx(v, r"\n{3,}", "\n\n")


def rendered(base_url: str, diagram_macro: str | None = None, page_id: str = "page_id", body: str = "body") -> Column:
    """The Markdown of the body column of a page, for well-formed markup."""
    blocks = Renderer.of(page_id, base_url, diagram_macro).of_column("markdown", body)
    return F.concat(tx.clean_text(postprocess(blocks)), F.lit("\n"))


def render_markdown(pages: DataFrame, base_url: str, diagram_macro: str | None = None, id_col: str = "page_id",
                    body_col: str = "body") -> DataFrame:
    """``(page_id, markdown)`` of well-formed bodies, a row for each row of ``pages``."""
    return pages.select(F.col(id_col).alias("page_id"), rendered(base_url, diagram_macro, id_col, body_col).alias("markdown"))


def table_cells(pages: DataFrame, id_col: str = "page_id", body_col: str = "body") -> DataFrame:
    """``(page_id, table_no, row_no, col_no, flat, content)`` of every table, nested ones too; rows without cells count
    for nothing. ``flat`` is the cell in one line, ``content`` its blocks."""
    found = pages.select(F.col(id_col).alias("page_id"), Renderer.of(id_col, "", None).of_column("tables", body_col).alias("tables"))
    tables = found.select("page_id", F.posexplode("tables").alias("table_no", "t"))
    rows = tables.select("page_id", "table_no", F.posexplode("t.rows").alias("row_no", "r"))
    return rows.select("page_id", "table_no", "row_no", F.posexplode("r").alias("col_no", "c")).select(
        "page_id", "table_no", "row_no", "col_no", F.col("c.f").alias("flat"), F.col("c.c").alias("content"))
