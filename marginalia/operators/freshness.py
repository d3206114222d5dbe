"""Exported-document metadata, freshness and refresh.

Exported documents are ``(path, text)`` rows. A header is an array of lines of
its row and becomes a map there (the last of equal keys counts): no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..session import ensure_checkpoint_dir


# Python's str.splitlines() boundaries, normalized to "\n" first.
LINE_BREAKS = "\r\n|[\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def split_lines(text):
    """``str.splitlines()`` as an array column (a trailing newline adds no line)."""
    t = F.regexp_replace(text, LINE_BREAKS, "\n")
    return F.split(F.regexp_replace(t, "\n\\z", ""), "\n")


def strip_quotes(c):
    """Frontmatter value: stripped; one pair of matching ' or " quotes removed."""
    return tx.let(tx.strip(c), lambda v: F.when(
        (F.length(v) >= 2) & (F.substring(v, 1, 1) == F.substring(v, -1, 1)) & F.substring(v, 1, 1).isin("'", '"'),
        F.substring(v, F.lit(2), F.length(v) - 2)).otherwise(v))


def header(text: Column) -> Column:
    """S1 in the row: (fm_state, frontmatter). Each step is bound, so what reads the result doesn't repeat it.

    fm_state: ``ok`` | ``missing`` (first line is not ``---``) | ``unclosed``; the map is null unless ``ok``. The last of equal keys counts.
    """
    def entries(head: Column) -> Column:
        made = F.transform(F.filter(head, lambda x: F.instr(x, ":") > 0), lambda x: F.struct(
            tx.strip(F.substring_index(x, ":", 1)).alias("k"),
            strip_quotes(F.substring(x, F.instr(x, ":") + 1, F.length(x))).alias("v")))

        def last(es: Column) -> Column:
            keys = F.transform(es, lambda e: e.getField("k"))
            return F.map_from_entries(F.filter(es, lambda e, i: ~F.array_contains(
                F.slice(keys, i + 2, F.size(es)), e.getField("k"))))

        return tx.let(made, last)

    def read(lines: Column) -> Column:
        rest = F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(1)))
        opened = tx.strip(F.element_at(lines, 1)) == "---"

        def state(close_at: Column) -> Column:
            name = F.when(~opened, "missing").when(close_at == 0, "unclosed").otherwise("ok")
            head = F.slice(rest, 1, F.greatest(close_at - 1, F.lit(0)))
            return F.struct(name.alias("fm_state"), F.when(name == "ok", entries(head)).alias("frontmatter"))

        return tx.let(F.array_position(F.transform(rest, lambda x: tx.strip(x) == "---"), True), state)

    return tx.let(split_lines(F.coalesce(text, F.lit(""))), read)


def parse_frontmatter(docs: DataFrame) -> DataFrame:
    """``(path, fm_state, frontmatter MAP<STRING,STRING>)``, row by row; see ``header``."""
    return docs.select("path", header(F.col("text")).alias("h")).select("path", "h.fm_state", "h.frontmatter")


def export_metadata(docs: DataFrame) -> DataFrame:
    """Page id (required), integer version or null, source URL, title,
    and a per-row ``error`` instead of an exception."""
    def read(h: Column) -> Column:
        get = lambda k: F.try_element_at(h.getField("frontmatter"), F.lit(k))
        state = h.getField("fm_state")
        page_id = F.nullif(get("confluence_page_id"), F.lit(""))
        error = (F.when(state == "missing", F.lit("Markdown frontmatter not found"))
                 .when(state == "unclosed", F.lit("Markdown frontmatter is not closed"))
                 .when(page_id.isNull(), F.lit("confluence_page_id is missing in Markdown frontmatter")))
        found = {"page_id": page_id, "local_version": F.nullif(get("confluence_version"), F.lit("")).try_cast("bigint"),
                 "source_url": get("source_url"), "title": get("title")}
        return F.struct(*[F.when(error.isNull(), v).alias(n) for n, v in found.items()], error.alias("error"))

    return docs.select("path", tx.let(header(F.col("text")), read).alias("m")).select("path", "m.*")


def check_freshness(meta: DataFrame, remote: DataFrame) -> DataFrame:
    """S3: ``is_stale = local < remote``, false if either is unknown; title
    and URL prefer the remote page. A document with an error keeps its row.

    ``remote``: (page_id, remote_title, remote_version, remote_url), one row
    per page -- the join key is unique on that side.
    """
    j = meta.join(remote, "page_id", "left")
    stale = F.coalesce(F.col("local_version") < F.col("remote_version"), F.lit(False))
    return j.select(
        F.col("path").alias("file"), "page_id",
        F.coalesce(F.nullif(F.col("remote_title"), F.lit("")), F.col("title")).alias("title"),
        "local_version", "remote_version",
        stale.alias("is_stale"),
        F.coalesce(F.nullif(F.col("remote_url"), F.lit("")), F.col("source_url")).alias("source_url"), "error",
    )


def refresh_set(freshness: DataFrame, stale_only: bool = False) -> DataFrame:
    """S4 selection: files to re-render (all, or only stale ones)."""
    return freshness.filter(F.col("is_stale")) if stale_only else freshness


def refreshed_snapshot(docs: DataFrame, freshness: DataFrame, pages: DataFrame, render, stale_only: bool = True) -> DataFrame:
    """``(path, text, refreshed)`` of every document of ``docs`` after a refresh.

    ``pages`` has page_id and whatever ``render`` needs to make ``(page_id, markdown)`` of them. Pages to render are
    picked (a slim table of its own) and semi-joined before anything is rendered; files that aren't refreshed, among them those with an error or
    without a live page, are carried over as they are.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    wanted = refresh_set(freshness, stale_only).where(F.col("error").isNull() & F.col("page_id").isNotNull()).select(
        F.col("file").alias("path"), "page_id").checkpoint(eager=True)
    stale = pages.join(wanted.select("page_id").distinct(), "page_id", "left_semi").checkpoint(eager=True)
    fresh = render(stale).checkpoint(eager=True)
    new = wanted.join(fresh.select("page_id", "markdown"), "page_id").select("path", "markdown", F.lit(True).alias("new"))
    return docs.join(new, "path", "left").select(
        "path", F.when(F.col("new"), F.col("markdown")).otherwise(F.col("text")).alias("text"),
        F.coalesce("new", F.lit(False)).alias("refreshed"))
