"""Inline-comment threads (C1-C10): normalize, assign, roll up, filter, count, digest.

Input: COMMENT records (``sources.schemas.COMMENT_DDL``), one row per comment,
with ``position`` giving arrival order within ``page_id``.

Plan shape (per corpus, not per page):
  C1 projection -> C2 prefix scan over ranges (``plans.scans``) ->
  C3-C5 aggregates by (page, thread, status), then (page, thread) ->
  C6-C9 one aggregate of the threads each, with grouping sets for the digest.
Comments are read once: a thread keeps its comments' status counts, and page
summary, status counts and digest are made from threads alone, without joins.
No unbounded per-page window is used, so a page holding a third of all
comments does not land in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..plans.scans import ordered_carry

# Thread status ordering and placeholder labels.
STATUS_RANK = {"open": 0, "dangling": 1, "resolved": 2}
OTHER_RANK = 99
NO_SELECTION = "(No quoted selection)"
ORPHAN_SELECTION = "(Reply without quoted selection)"
EXCERPT_LIMIT = 160


def _blank_to(c: Column, default: str) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def excerpt_of(body_html: Column) -> Column:
    """Comment excerpt: T1 text, one line, at most 160 chars.

    T1's whitespace tidying is subsumed by the one-line collapse, so only its
    tag rules and unescape run here.
    """
    return tx.truncate(tx.single_line(tx.html_unescape(tx.tag_rules(body_html))), EXCERPT_LIMIT)


def normalize_comments(raw: DataFrame, base_url: str) -> DataFrame:
    """Flat, defaulted comment rows."""
    body = F.coalesce(F.col("body.storage.value"), F.lit(""))
    body_text = tx.html_to_text(body)
    webui = F.nullif(F.col("_links.webui"), F.lit(""))
    base = base_url.rstrip("/")
    return raw.select(
        F.col("page_id"),
        F.col("position"),
        F.col("id"),
        _blank_to(F.col("extensions.resolution.status"), "unknown").alias("status"),
        tx.strip(F.coalesce(F.col("extensions.inlineProperties.originalSelection"), F.lit(""))).alias("selection"),
        tx.strip(F.coalesce(F.col("extensions.inlineProperties.markerRef"), F.lit(""))).alias("marker_ref"),
        body.alias("body_html"),
        body_text.alias("body_text"),
        excerpt_of(body).alias("body_excerpt"),
        F.col("history.createdDate").alias("created_at"),
        _blank_to(F.col("history.createdBy.displayName"), "Unknown").alias("created_by"),
        F.when(webui.isNotNull(), F.concat(F.lit(base), webui)).alias("webui_url"),
    )


def assign_threads(comments: DataFrame, bucket_width: int = 1 << 20) -> DataFrame:
    """Thread of every comment, by arrival order.

    * marker -> that marker's thread (even if non-adjacent);
    * selection without marker -> a new thread of its own;
    * blank -> the current thread (last anchored comment before it);
    * blanks before any anchor -> one orphan thread per page.
    """
    own_key = (F.when(F.col("marker_ref") != "", F.concat(F.lit("m:"), F.col("marker_ref")))
               .when(F.col("selection") != "", F.concat(F.lit("s:"), F.col("position").cast("string"))))
    c = comments.withColumn("own_key", own_key)
    c = ordered_carry(c, by=["page_id"], order="position", carry=["own_key"],
                      bucket_width=bucket_width, first=["id"])
    return (c.withColumn("thread_key", F.coalesce(F.col("own_key_carry"), F.lit("o:")))
             .withColumn("is_anchored", F.col("own_key").isNotNull())
             .withColumnRenamed("id_first", "page_first_id")
             .drop("own_key_carry"))


def _status_rank(c: Column) -> Column:
    expr = F.lit(OTHER_RANK)
    for name, rank in sorted(STATUS_RANK.items(), key=lambda kv: -kv[1]):
        expr = F.when(c == name, F.lit(rank)).otherwise(expr)
    return expr


def thread_rollup(assigned: DataFrame, parsed_time: bool = False) -> DataFrame:
    """One row per (page_id, thread_key).

    The excerpt is rendered only for each thread's latest comment (after the
    aggregate), not for every comment.

    status: any open > any dangling > any resolved > last comment's status.
    latest comment: max created_at compared as a string (null as ''), first
    in arrival order on ties. ``parsed_time=True`` compares parsed instants
    instead (timestamps with different UTC offsets then order correctly).
    """
    # per (page, thread, status) first, so that the counts by status stay; then per thread
    g = assigned.groupBy("page_id", "thread_key", "status").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("position").alias("first_position"),
        F.min(F.when(F.col("is_anchored"), F.struct(
            F.col("position").alias("p"), F.col("id").alias("id"),
            F.col("selection").alias("selection"), F.col("marker_ref").alias("marker_ref")))).alias("anchor"),
        F.min("page_first_id").alias("page_first_id"),
        F.max(F.struct((F.coalesce(F.col("created_at"), F.lit("")) if not parsed_time else
                        F.coalesce(F.try_to_timestamp(F.col("created_at")).cast("string"), F.lit(""))).alias("t"),
                       (-F.col("position")).alias("np"),
                       F.col("created_at").alias("created_at"),
                       F.col("body_html").alias("body"),
                       F.col("webui_url").alias("url"))).alias("latest"),
        F.max("position").alias("last_position"),
        F.collect_set("created_by").alias("authors"),
        F.count(F.when(F.col("is_anchored"), 1)).alias("anchored_count"),
    ).groupBy("page_id", "thread_key").agg(
        F.sum("n").alias("comment_count"),
        F.min("first_position").alias("first_position"),
        F.min("anchor").alias("anchor"),
        F.min("page_first_id").alias("page_first_id"),
        F.max("latest").alias("latest"),
        F.max_by("status", "last_position").alias("last_status"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("authors")))).alias("participant_list"),
        F.array_sort(F.collect_list(F.struct("status", "n"))).alias("status_counts"),
        F.sum("anchored_count").alias("anchored_count"),
    ).withColumn("statuses", F.col("status_counts.status"))
    statuses = F.col("statuses")
    status = (F.when(F.array_contains(statuses, "open"), F.lit("open"))
              .when(F.array_contains(statuses, "dangling"), F.lit("dangling"))
              .when(F.array_contains(statuses, "resolved"), F.lit("resolved"))
              .otherwise(F.col("last_status")))
    anchor = F.col("anchor")
    thread_id = (F.when(anchor.isNull(), F.concat(F.lit("orphan-"), F.col("page_first_id")))
                 .when(anchor.marker_ref != "", anchor.marker_ref)
                 .otherwise(F.concat(F.lit("selection-"), anchor.id)))
    selection = (F.when(anchor.isNull(), F.lit(ORPHAN_SELECTION))
                 .otherwise(_blank_to(anchor.selection, NO_SELECTION)))
    return g.select(
        "page_id", "thread_key",
        thread_id.alias("thread_id"),
        selection.alias("selection"),
        F.nullif(anchor.marker_ref, F.lit("")).alias("marker_ref"),
        status.alias("status"),
        _status_rank(status).alias("status_rank"),
        "comment_count",
        "anchored_count",
        (F.col("comment_count") - F.col("anchored_count")).alias("reply_count"),
        F.array_join("participant_list", ", ").alias("participants"),
        "participant_list",
        "statuses",
        "status_counts",
        F.col("latest.created_at").alias("latest_comment_at"),
        excerpt_of(F.col("latest.body")).alias("latest_comment_excerpt"),
        F.col("latest.url").alias("latest_comment_url"),
        "first_position",
    )


def filter_threads(threads: DataFrame, status: str = "all") -> DataFrame:
    """``all``, or threads having any comment with that status
    (the thread's own rolled-up status may differ)."""
    if status == "all":
        return threads
    return threads.filter(F.array_contains("statuses", status))


def order_threads(threads: DataFrame) -> DataFrame:
    """Open, dangling, resolved, rest; then lower(selection); then creation order."""
    return threads.orderBy("page_id", "status_rank", F.lower("selection"), "first_position")


def _selected(status: str) -> Column:
    return F.lit(True) if status == "all" else F.array_contains("statuses", status)


def _status_n(status: str) -> Column:
    """Comments of the thread with that status."""
    return F.aggregate("status_counts", F.lit(0).cast("long"),
                       lambda n, x: F.when(x["status"] == status, n + x["n"]).otherwise(n))


def _summary_aggregates(status: str) -> list[Column]:
    """C8 counts over thread rows."""
    zero = F.lit(0).cast("long")
    chosen = lambda c: F.sum(F.when(_selected(status), c).otherwise(zero))
    return [
        chosen(F.col("comment_count")).alias("total_comments"),
        F.sum("comment_count").alias("all_comment_count"),
        F.sum(F.col("comment_count") if status == "all" else _status_n(status)).alias("matching_comment_count"),
        chosen(F.col("anchored_count")).alias("anchored_comment_count"),
        chosen(F.col("reply_count")).alias("reply_comment_count"),
        # rows without a count are page titles (see digest_lines)
        F.count(F.when(_selected(status), F.col("comment_count"))).alias("thread_count"),
        F.count(F.when(_selected(status) & (F.col("status") == "open"), 1)).alias("open_thread_count"),
    ]


def page_comment_summary(threads: DataFrame, status: str = "all") -> DataFrame:
    """Per-page counts, one aggregate of the threads.

    ``total_comments`` counts every comment of the selected threads;
    ``matching_comment_count`` counts only comments with the filter status.
    """
    return threads.groupBy("page_id").agg(*_summary_aggregates(status)).select(
        "page_id", F.lit(status).alias("status_filter"), "total_comments", "all_comment_count",
        "matching_comment_count", "anchored_comment_count", "reply_comment_count", "thread_count",
        "open_thread_count")


def status_counts(threads: DataFrame, status: str = "all") -> DataFrame:
    """C8 maps as rows: (page_id, scope, status, n) for the selected threads'
    comments (scope ``comment``) and the threads themselves (scope ``thread``)."""
    entry = lambda scope, name, n: F.struct(
        F.lit(scope).alias("scope"), name.alias("status"), n.alias("n"))
    entries = F.concat(
        F.array(entry("thread", F.col("status"), F.lit(1).cast("long"))),
        F.transform("status_counts", lambda x: entry("comment", x["status"], x["n"])))
    return (filter_threads(threads, status).select("page_id", F.inline(entries))
            .groupBy("page_id", "scope", "status").agg(F.sum("n").alias("n")))


def status_count_map(counts: DataFrame, scope: str) -> DataFrame:
    """C8 maps on request: (page_id, MAP<status, n>) for one scope."""
    return (counts.filter(F.col("scope") == scope).groupBy("page_id")
            .agg(F.map_from_entries(F.collect_list(F.struct("status", "n"))).alias(scope + "_status_counts")))


def comments_with_page(comments: DataFrame, pages: DataFrame) -> DataFrame:
    """Attach page title / URL (defaults ``Untitled`` / '').

    ``pages`` is one row per page; the join is on ``page_id``. A hot page is a
    skewed key on the comment side only, which AQE's skew-join split handles.
    """
    p = pages.select(
        F.col("id").alias("page_id"),
        _blank_to(F.col("title"), "Untitled").alias("page_title"),
        F.coalesce(
            F.when((F.col("_links.base") != "") & (F.col("_links.webui") != ""),
                   F.concat("_links.base", "_links.webui")),
            F.lit("")).alias("page_url"),
    )
    return (comments.join(p, "page_id", "left")
            .withColumn("page_title", F.coalesce("page_title", F.lit("Untitled")))
            .withColumn("page_url", F.coalesce("page_url", F.lit(""))))


# --------------------------------------------------------------------------
# Digest as ordered line rows
# --------------------------------------------------------------------------

_SECTION = {"open": ("Open", 0), "dangling": ("Dangling", 1), "resolved": ("Resolved", 2)}  # label, rank


def digest_lines(threads: DataFrame, pages: DataFrame, exported_at: str, status: str = "all") -> DataFrame:
    """The Markdown digest as rows ``(page_id, k1, k2, k3, k4, line)``.

    Lines sort by ``(k1, k2, k3, k4)`` within a page; nothing is collected per
    page here. ``assemble_lines`` joins them when one document per page is
    wanted (its size is one page's digest).

    One aggregate with grouping sets makes the rows of pages, of their sections
    and of their threads from one pass over the threads. Page titles come in as
    rows of the same aggregate, so there is no join on ``page_id`` and a page
    with a third of all threads is combined before the exchange. A page without
    comments has no digest, a page without a record is ``Untitled``.
    """
    section = F.when(F.col("status_rank") == OTHER_RANK, F.lit(3)).otherwise(F.col("status_rank"))
    lines = F.array(
        F.concat(F.lit("- `"), F.col("selection"), F.lit("`")),
        F.concat(F.lit("  Status: "), F.col("status"), F.lit(" | Comments: "), F.col("comment_count").cast("string"),
                 F.lit(" | Participants: "), _blank_to(F.col("participants"), "Unknown")),
        F.when(_nonempty("latest_comment_at"), F.concat(F.lit("  Latest comment at: "), F.col("latest_comment_at"))),
        F.when(_nonempty("latest_comment_excerpt"), F.concat(F.lit("  Latest note: "), F.col("latest_comment_excerpt"))),
        F.when(_nonempty("latest_comment_url"), F.concat(F.lit("  Link: "), F.col("latest_comment_url"))),
        F.lit(""),
    )
    chosen = lambda c: F.when(_selected(status), c)
    named = ["page_id", "status", "statuses", "status_counts", "comment_count", "anchored_count", "reply_count"]
    rows = threads.select(
        *named, chosen(section).alias("k1"), chosen(F.lower("selection")).alias("k2"),
        chosen(F.col("first_position")).alias("k3"), chosen(lines).alias("lines"))
    titles = pages.select(
        F.col("id").alias("page_id"), _blank_to(F.col("title"), "Untitled").alias("page_title"),
        F.when((F.col("_links.base") != "") & (F.col("_links.webui") != ""),
               F.concat("_links.base", "_links.webui")).alias("page_url"))
    grouped = rows.unionByName(titles, allowMissingColumns=True).groupingSets(
        [("page_id",), ("page_id", "k1"), ("page_id", "k1", "k2", "k3", "lines")],
        "page_id", "k1", "k2", "k3", "lines",
    ).agg(
        F.grouping("k1").alias("of_page"), F.grouping("k3").alias("of_section"),
        F.max("page_title").alias("page_title"), F.max("page_url").alias("page_url"),
        *_summary_aggregates(status),
        *[F.sum(F.when(_selected(status), _status_n(s))).alias("n_" + s) for s in ("open", "resolved", "dangling")])

    title = F.coalesce("page_title", F.lit("Untitled"))
    url = F.coalesce("page_url", F.lit(""))
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("string")
    head = F.array(
        F.lit("---"),
        F.concat(F.lit('title: "'), F.replace(F.concat(title, F.lit(" - Inline Comment Summary")),
                                              F.lit('"'), F.lit("'")), F.lit('"')),
        F.concat(F.lit("confluence_page_id: "), F.col("page_id")),
        F.concat(F.lit("source_url: "), url),
        F.lit("exported_at: " + exported_at),
        F.lit("---"), F.lit(""),
        F.concat(F.lit("# "), title, F.lit(" - Inline Comment Summary")), F.lit(""),
        F.concat(F.lit("Source page: "), url), F.lit(""),
        F.lit("## Quick Summary"), F.lit(""),
        F.concat(F.lit("- Total inline comments fetched: "), n("all_comment_count")),
        F.concat(F.lit(f"- Matching comments for filter `{status}`: "), n("matching_comment_count")),
        F.concat(F.lit("- Anchored comments: "), n("anchored_comment_count")),
        F.concat(F.lit("- Reply comments: "), n("reply_comment_count")),
        F.concat(F.lit("- Threads to review: "), n("thread_count")),
        F.concat(F.lit("- Open threads: "), n("open_thread_count")),
        F.concat(F.lit("- Comment status distribution: open "), n("n_open"), F.lit(", resolved "),
                 n("n_resolved"), F.lit(", dangling "), n("n_dangling")),
        F.lit(""), F.lit("## Threads"), F.lit(""),
        F.when(F.col("thread_count") == 0, F.lit("- No inline comment threads matched the requested filter.")),
    )
    label = F.lit("Other")
    for name, rank in _SECTION.values():
        label = F.when(F.col("k1") == rank, F.lit(name)).otherwise(label)
    of_page, of_section = F.col("of_page") == 1, F.col("of_section") == 1
    # null keys: title rows and threads that aren't selected; they count for their page only
    wanted = F.when(of_page, F.col("all_comment_count").isNotNull()).otherwise(F.col("k1").isNotNull())
    text = (F.when(of_page, head).when(of_section, F.array(F.concat(F.lit("### "), label), F.lit("")))
            .otherwise(F.col("lines")))
    return (grouped.filter(wanted)
            .select("page_id", F.when(of_page, F.lit(-1)).otherwise(F.col("k1")).alias("k1"),
                    F.coalesce("k2", F.lit("")).alias("k2"), F.coalesce("k3", F.lit(-1)).alias("k3"),
                    F.posexplode(text).alias("k4", "line"))
            .filter(F.col("line").isNotNull()))


def _nonempty(c: str) -> Column:
    return F.col(c).isNotNull() & (F.col(c) != "")


def assemble_lines(lines: DataFrame, key: str = "page_id", order: tuple[str, ...] = ("k1", "k2", "k3", "k4"),
                   out: str = "markdown") -> DataFrame:
    """Join ordered line rows into one text per key (trailing blank lines
    stripped, one final newline). Bounded by one document's size."""
    srt = F.array_sort(F.collect_list(F.struct(*[F.col(o) for o in order], F.col("line"))))
    text = F.array_join(F.transform(srt, lambda x: x.getField("line")), "\n")
    return lines.groupBy(key).agg(F.concat(tx.strip(text), F.lit("\n")).alias(out))
