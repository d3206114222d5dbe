"""Guarded change sets: validate -> preview -> apply.

A change set is a table of requests (``sources.schemas.CHANGE_DDL``).
Rejections are rows with an ``error`` (first failing rule, in the order the
reference checks them) instead of exceptions.

Allowlists are a table ``(kind, value)``; a kind with no rows is
unrestricted. The allowlist is joined with a size check: it is broadcast only
when it is proven small (``BROADCAST_MAX_ROWS``), otherwise a shuffle join is
used.
"""

from __future__ import annotations

import json
import mimetypes

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..plans.scans import ordered_running_sum

BROADCAST_MAX_ROWS = 100_000

# Allowlist setting names used in rejection messages.
SETTING = {
    "space": "CONFLUENCE_ALLOWED_SPACE_KEYS",
    "parent": "CONFLUENCE_ALLOWED_PARENT_IDS",
    "page": "CONFLUENCE_ALLOWED_PAGE_IDS",
    "project": "JIRA_ALLOWED_PROJECT_KEYS",
    "issue": "JIRA_ALLOWED_ISSUE_KEYS",
}

# Fixed value: the message of an update without input.
UPDATE_NEEDS = (
    "update-page requires at least one of --title, --body-html/--body-file, --body-markdown/--body-markdown-file, "
    "--append-html/--append-file, or --append-markdown/--append-markdown-file.")


def _kind_sizes(allow: DataFrame) -> dict[str, int]:
    """Rows per allowlist kind: one small aggregate (at most one row per kind)."""
    return {r["kind"]: r["n"] for r in allow.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}


def _member(changes: DataFrame, allow: DataFrame, sizes: dict[str, int], kind: str, value: Column,
            flag: str) -> DataFrame:
    """Adds ``flag``: true = allowed (in list, or kind unrestricted). The list
    is broadcast only when its size is within ``BROADCAST_MAX_ROWS``."""
    n = sizes.get(kind, 0)
    if n == 0:
        return changes.withColumn(flag, F.lit(True))
    vals = allow.filter(F.col("kind") == kind).select(F.col("value").alias("__v")).distinct()
    if n <= BROADCAST_MAX_ROWS:
        vals = F.broadcast(vals)
    tmp = changes.withColumn("__probe", value)
    j = tmp.join(vals, tmp["__probe"] == vals["__v"], "left")
    return j.withColumn(flag, F.col("__v").isNotNull()).drop("__v", "__probe")


def validate_changes(changes: DataFrame, allow: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """V1-V6 (+V7 body source): adds ``mode`` (preview|apply), ``body_source``
    and ``error`` (null when valid).

    ``pages`` (id, parent_id) is needed for V6 (move to the current parent).
    """
    c = changes
    sizes = _kind_sizes(allow)
    for kind, col in (("space", F.col("space_key")), ("parent", F.col("parent_id")),
                      ("page", F.col("page_id")), ("project", F.col("project_key")),
                      ("issue", F.col("issue_key"))):
        c = _member(c, allow, sizes, kind, col, "ok_" + kind)
    parent_restricted = sizes.get("parent", 0) > 0
    c = _member(c, allow, sizes, "parent", F.col("new_parent_id"), "ok_new_parent")
    if pages is not None:
        cur = pages.select(F.col("id").alias("__pid"), F.col("parent_id").alias("current_parent_id"))
        c = c.join(cur, c["page_id"] == cur["__pid"], "left").drop("__pid")
    else:
        c = c.withColumn("current_parent_id", F.lit(None).cast("string"))
    a = F.col("action")
    blocked = lambda kind, v: F.concat(F.lit(f"Write blocked: {_label(kind)} "), F.coalesce(v, F.lit("None")),
                                       F.lit(f" is not in {SETTING[kind]}."))
    err = (F.when(~F.coalesce(F.col("allow_write"), F.lit(False)) & ~F.coalesce(F.col("dry_run"), F.lit(False)),
                  F.lit("Write commands require --allow-write or --dry-run."))
           .when((a == "create-page") & ~F.col("ok_space"), blocked("space", F.col("space_key")))
           .when((a == "create-page") & F.lit(parent_restricted) & (F.coalesce(F.col("parent_id"), F.lit("")) == ""),
                 F.lit("Write blocked: parent ID is required by CONFLUENCE_ALLOWED_PARENT_IDS."))
           .when((a == "create-page") & ~F.col("ok_parent"), blocked("parent", F.col("parent_id")))
           .when(a.isin("update-page", "replace-section", "move-page", "upload-attachment") & ~F.col("ok_page"),
                 blocked("page", F.col("page_id")))
           .when((a == "update-page") & F.col("title").isNull() & F.col("body_html").isNull()
                 & F.col("body_markdown").isNull() & F.col("append_html").isNull() & F.col("append_markdown").isNull(),
                 F.lit(UPDATE_NEEDS))
           .when((a == "move-page") & ~F.col("ok_new_parent"), blocked("parent", F.col("new_parent_id")))
           .when((a == "move-page") & F.col("current_parent_id").eqNullSafe(F.col("new_parent_id")),
                 F.lit("move-page requires different current and new parent IDs."))
           .when((a == "jira-create-issue") & ~F.col("ok_project"), blocked("project", F.col("project_key")))
           .when((a == "jira-add-comment") & ~F.col("ok_issue"), blocked("issue", F.col("issue_key"))))
    source = (F.when(F.col("body_html").isNotNull(), "storage_html")
              .when(F.col("body_markdown").isNotNull(), "markdown"))
    mode = F.when(F.coalesce(F.col("dry_run"), F.lit(False)), "preview").otherwise("apply")
    drop = [x for x in c.columns if x.startswith("ok_")]
    return c.withColumn("error", err).withColumn("mode", mode).withColumn("body_source", source).drop(*drop)


def _label(kind: str) -> str:
    return {"space": "space key", "parent": "parent ID", "page": "page ID",
            "project": "project key", "issue": "issue key"}[kind]


def preview_create(valid: DataFrame) -> DataFrame:
    """B1: create-page previews (body lengths, source, T5 preview)."""
    c = valid.filter((F.col("action") == "create-page") & F.col("error").isNull() & (F.col("mode") == "preview"))
    body = F.coalesce(F.col("body_html"), F.lit(""))
    return c.select("request_id", "space_key", "parent_id", "title", "body_source",
                    F.length(body).alias("body_length"), tx.preview_html(body).alias("body_preview"))


def preview_move(valid: DataFrame, pages: DataFrame) -> DataFrame:
    """Current / new parent and whether it changes."""
    c = valid.filter((F.col("action") == "move-page") & F.col("error").isNull() & (F.col("mode") == "preview"))
    p = pages.select(F.col("id").alias("page_id"), F.col("title").alias("page_title"), "version")
    j = c.join(p, "page_id", "left")
    return j.select("request_id", "page_id", "page_title", F.col("version").alias("current_version"),
                    "current_parent_id", "new_parent_id",
                    (~F.col("current_parent_id").eqNullSafe(F.col("new_parent_id"))).alias("parent_changed"))


def detect_conflicts(changes: DataFrame, pages: DataFrame) -> DataFrame:
    """Changes whose base version differs from the live one (the 409)."""
    p = pages.select(F.col("id").alias("page_id"), F.col("version").alias("live_version"))
    return changes.join(p, "page_id").filter(~F.col("base_version").eqNullSafe(F.col("live_version")))


def apply_updates(pages: DataFrame, updates: DataFrame) -> DataFrame:
    """Next snapshot of ``pages``, all its columns, and ``edit_count``.

    ``pages``: (id, title, body, version, parent_id, ...);
    ``updates``: valid apply-mode rows (seq, page_id, title, body_html,
    append_html, new_parent_id). Edits of a page count in ``seq`` order: the
    last non-empty title, body and new parent win, non-empty appends since
    that body (its own included) follow it, each edit adds one version.
    Untouched pages pass through; a page id that occurs twice is edited twice;
    edits of unknown pages are in ``unapplied``. Aggregates with map-side
    combine give all but the appends, and of these only the ones that the next
    body holds are gathered: bodies that are replaced later never are.
    """
    at = F.col("seq")

    def last(col: str, given: Column) -> Column:
        return F.max_by(F.when(given, F.col(col)), F.when(given, at))

    has_body, has_append = F.col("body_html").isNotNull(), F.coalesce(F.col("append_html"), F.lit("")) != ""
    summary = updates.groupBy("page_id").agg(
        F.count(F.lit(1)).alias("__edits"), last("title", F.col("title") != "").alias("__title"),
        last("body_html", has_body).alias("__body"),
        last("new_parent_id", F.col("new_parent_id").isNotNull()).alias("__parent"))
    since = updates.where(has_body).groupBy("page_id").agg(F.max("seq").alias("__since"))
    tails = (updates.where(has_append).select("page_id", "seq", "append_html").join(since, "page_id", "left")
             .where("__since is null or seq >= __since").groupBy("page_id").agg(F.array_join(F.transform(
                 F.array_sort(F.collect_list(F.struct("seq", "append_html"))), lambda x: x.getField("append_html")), "")
                 .alias("__tail")))
    edits = summary.join(tails, "page_id", "left").withColumnRenamed("page_id", "__page")
    j = pages.join(edits, pages["id"] == F.col("__page"), "left")
    n = F.coalesce(F.col("__edits"), F.lit(0))
    body = F.concat(F.coalesce(F.col("__body"), pages["body"], F.lit("")), F.coalesce(F.col("__tail"), F.lit("")))
    now = {"title": F.coalesce(F.col("__title"), pages["title"]), "body": F.when(n > 0, body).otherwise(pages["body"]),
           "version": F.when(n > 0, F.coalesce(pages["version"], F.lit(0)) + n).otherwise(pages["version"]).cast("long"),
           "parent_id": F.coalesce(F.col("__parent"), pages["parent_id"])}
    return j.select(*[now.get(c, pages[c]).alias(c) for c in pages.columns], n.alias("edit_count"))


def unapplied(pages: DataFrame, updates: DataFrame) -> DataFrame:
    """The edits whose page isn't there, with the error that they end in."""
    lost = updates.join(pages.select(F.col("id").alias("page_id")), "page_id", "left_anti")
    return lost.withColumn("error", F.concat(F.lit("Page "), F.coalesce(F.col("page_id"), F.lit("None")), F.lit(" was not found.")))


def preview_update(valid: DataFrame, pages: DataFrame) -> DataFrame:
    """B2: current vs next title/body of update-page requests.

    ``pages``: (id, title, body, version, space_key, webui_url). An empty
    title keeps the current one; an empty append still reports
    ``body_appended`` (it was given) but changes nothing.
    """
    c = valid.filter((F.col("action") == "update-page") & F.col("error").isNull()
                     & (F.col("mode") == "preview")).drop("space_key")
    p = pages.select(F.col("id").alias("page_id"), F.col("title").alias("current_title"),
                     F.coalesce(F.col("body"), F.lit("")).alias("current_body"),
                     F.col("version").alias("current_version"), "space_key", F.col("webui_url").alias("source_url"))
    j = c.join(p, "page_id", "left")
    nxt_body = F.coalesce(F.col("body_html"), F.col("current_body"))
    nxt_body = F.when(F.coalesce(F.col("append_html"), F.lit("")) != "",
                      F.concat(nxt_body, F.col("append_html"))).otherwise(nxt_body)
    next_title = F.when(F.coalesce(F.col("title"), F.lit("")) != "", F.col("title")).otherwise(F.col("current_title"))
    return j.select(
        "request_id", "page_id", "space_key", "source_url", "current_version", "current_title",
        next_title.alias("next_title"),
        (~next_title.eqNullSafe(F.col("current_title"))).alias("title_changed"),
        F.col("body_html").isNotNull().alias("body_replaced"),
        F.col("append_html").isNotNull().alias("body_appended"),
        "body_source",
        (F.col("append_source") if "append_source" in j.columns else
         F.when(F.col("append_html").isNotNull(), F.lit("storage_html"))).alias("append_source"),
        F.length("current_body").alias("current_body_length"),
        F.length(nxt_body).alias("next_body_length"),
        tx.preview_html(nxt_body).alias("body_preview"))


def content_type(name: Column) -> Column:
    """MIME type of a file name by its extension (``application/octet-stream`` if unknown).

    The table is the interpreter's own (``mimetypes``, without the machine's
    files); as there, a compressed file has the type of what it holds
    (``a.tar.gz``), and a leading dot is no extension.
    """
    known = mimetypes.MimeTypes(filenames=())
    lookup = lambda table: F.from_json(F.lit(json.dumps(table)), "map<string, string>")
    ext = lambda n: F.regexp_extract(n, r"[^./][^/]*(\.[^./]*)$", 1)
    stem = lambda n: F.substring(n, F.lit(1), F.length(n) - F.length(ext(n)))
    whole = F.concat(stem(name), F.coalesce(F.try_element_at(lookup(known.suffix_map), F.lower(ext(name))), ext(name)))
    inner = F.when(ext(whole).isin(list(known.encodings_map)), stem(whole)).otherwise(whole)
    return F.coalesce(F.try_element_at(lookup(known.types_map[True]), F.lower(ext(inner))),
                      F.lit("application/octet-stream"))


def preview_attachment(uploads: DataFrame, attachments: DataFrame) -> DataFrame:
    """``replace`` iff an attachment with the same (page, file name)
    exists (first by ordinal), else ``create``.

    ``uploads``: (request_id, page_id, file_name, file_size), ``comment`` and
    ``major_edit`` if there are any; ``attachments``: (page_id, ordinal, id,
    title, media_type, file_size, download_url).
    """
    first = attachments.groupBy("page_id", F.col("title").alias("file_name")).agg(
        F.min(F.struct("ordinal", "id", "title", "media_type", "file_size", "download_url")).alias("existing"))
    j = uploads.join(first, ["page_id", "file_name"], "left")
    comment = F.col("comment") if "comment" in uploads.columns else F.lit(None).cast("string")
    major = F.coalesce("major_edit", F.lit(False)) if "major_edit" in uploads.columns else F.lit(False)
    return j.select("request_id", "page_id", "file_name", "file_size",
                    content_type(F.col("file_name")).alias("content_type"), comment.alias("comment"),
                    (~major).alias("minor_edit"),
                    F.when(F.col("existing").isNotNull(), "replace").otherwise("create").alias("mode"),
                    F.col("existing").dropFields("ordinal").alias("existing_attachment"))


def preview_uploads(valid: DataFrame, attachments: DataFrame) -> DataFrame:
    """B5 over a validated change set: previews of its upload requests in preview mode."""
    return preview_attachment(valid.filter((F.col("action") == "upload-attachment") & F.col("error").isNull()
                                           & (F.col("mode") == "preview")), attachments)


def apply_attachments(attachments: DataFrame, uploads: DataFrame) -> DataFrame:
    """U4: upsert on (page, file name): an upload replaces size and media type
    of the first existing attachment of that name (lowest ordinal), or creates
    one. Of several uploads of a name the last by ``seq`` (by request id
    without one) stays, under the id that the first created."""
    order = F.struct(*[c for c in ("seq", "request_id") if c in uploads.columns])
    up = uploads.groupBy(F.col("page_id").alias("u_page"), F.col("file_name").alias("u_title")).agg(
        F.max_by("file_size", order).alias("new_size"), F.min_by("request_id", order).alias("request_id"),
    ).withColumn("new_type", content_type(F.col("u_title")))
    firsts = attachments.groupBy("page_id", "title").agg(F.min("ordinal").alias("first_ordinal"))
    a = attachments.join(firsts, ["page_id", "title"]).withColumn(
        "is_first", F.col("ordinal") == F.col("first_ordinal"))
    j = a.join(up, (a["page_id"] == up["u_page"]) & (a["title"] == up["u_title"]) & a["is_first"], "full_outer")
    media = [F.coalesce("new_type", "media_type").alias("media_type")] if "media_type" in attachments.columns else []
    return j.select(
        F.coalesce("page_id", "u_page").alias("page_id"), F.coalesce("title", "u_title").alias("title"),
        F.coalesce(F.col("id"), F.concat(F.lit("new-"), F.col("request_id"))).alias("id"),
        "ordinal",
        F.when(F.col("request_id").isNotNull(), F.col("new_size")).otherwise(F.col("file_size")).alias("file_size"),
        *media,
        F.when(F.col("request_id").isNull(), "unchanged")
        .when(F.col("id").isNull(), "created").otherwise("replaced").alias("change"))


def preview_issue(valid: DataFrame, base_url: str) -> DataFrame:
    """Create-issue preview: description length/preview, sorted extra
    field keys, project browse URL."""
    c = valid.filter((F.col("action") == "jira-create-issue") & F.col("error").isNull() & (F.col("mode") == "preview"))
    return c.select(
        "request_id", "project_key", "summary", "issue_type_name",
        tx.preview_text(F.col("description")).alias("description_preview"),
        F.coalesce(F.length("description"), F.lit(0)).alias("description_length"),
        F.array_sort(F.coalesce(F.map_keys("fields"), F.array().cast("array<string>"))).alias("extra_field_keys"),
        F.concat(F.lit(base_url.rstrip("/") + "/projects/"), F.col("project_key")).alias("project_browse_url"))


def apply_issue_fields(valid: DataFrame) -> DataFrame:
    """Issue fields = base fields overridden by the extra fields map.

    ``map_concat`` raises on duplicate keys, so base keys present in the
    extras are filtered out first."""
    c = valid.filter((F.col("action") == "jira-create-issue") & F.col("error").isNull())
    base = F.map_from_arrays(
        F.array(F.lit("project"), F.lit("summary"), F.lit("issuetype"), F.lit("description")),
        F.array(F.col("project_key"), F.col("summary"), F.col("issue_type_name"), F.col("description")))
    base = F.map_filter(base, lambda k, v: v.isNotNull())
    extras = F.coalesce(F.col("fields"), F.create_map().cast("map<string,string>"))
    kept = F.map_filter(base, lambda k, v: ~F.array_contains(F.map_keys(extras), k))
    return c.select("request_id", F.map_concat(kept, extras).alias("fields"))


def preview_comment(valid: DataFrame, issues: DataFrame) -> DataFrame:
    """Add-comment preview: issue summary and status, comment length and
    T4 preview. ``issues``: (key, summary, status, browse_url)."""
    c = valid.filter((F.col("action") == "jira-add-comment") & F.col("error").isNull() & (F.col("mode") == "preview")).drop("summary")
    j = c.join(issues.withColumnRenamed("key", "issue_key"), "issue_key", "left")
    body = F.coalesce(F.col("comment_body"), F.lit(""))
    return j.select("request_id", "issue_key", F.col("summary").alias("issue_summary"),
                    F.col("status").alias("issue_status"), "browse_url",
                    F.length(body).alias("comment_length"), tx.preview_text(body).alias("comment_preview"))


def apply_creates(pages: DataFrame, valid: DataFrame) -> DataFrame:
    """Next snapshot, all columns of ``pages``, with the created pages appended (id = request id).

    A created page is a current page of the requested space; columns that the
    request doesn't tell are null.
    """
    c = valid.filter((F.col("action") == "create-page") & F.col("error").isNull() & (F.col("mode") == "apply"))
    new = {"id": F.concat(F.lit("new-"), F.col("request_id")), "title": F.col("title"),
           "body": F.coalesce(F.col("body_html"), F.lit("")), "version": F.lit(1), "parent_id": F.col("parent_id"),
           "type": F.lit("page"), "status": F.lit("current"), "space_key": F.col("space_key")}
    return pages.unionByName(c.select(*[
        new.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in pages.schema.fields]))


def apply_comments(comments: DataFrame, valid: DataFrame) -> DataFrame:
    """Issue comments with the new ones appended.

    New comments of an issue are numbered on from its last ordinal in ``seq``
    order; the numbers come from a prefix scan, so an issue with very many
    requests isn't sorted in one task.
    """
    c = valid.filter((F.col("action") == "jira-add-comment") & F.col("error").isNull() & (F.col("mode") == "apply"))
    new = ordered_running_sum(
        c.select("issue_key", "seq", F.concat(F.lit("new-"), F.col("request_id")).alias("id"),
                 F.col("comment_body").alias("body"), F.lit(1).cast("long").alias("one")),
        ["issue_key"], "seq", "one", "place")
    last = comments.groupBy("issue_key").agg(F.max("ordinal").alias("last"))
    placed = new.join(last, "issue_key", "left").select(
        "issue_key", (F.coalesce("last", F.lit(0)) + F.col("place")).cast("long").alias("ordinal"), "id", "body")
    return comments.select("issue_key", "ordinal", "id", "body").unionByName(placed)


def resolve_bodies(changes: DataFrame, mermaid_macro: str | None = None) -> DataFrame:
    """V7: the storage body of each request: ``body_html`` if given, else
    ``body_markdown`` converted by the Markdown importer (M12); the same for
    the appended part, both in the row. Adds ``append_source``; ``body_source``
    comes from ``validate_changes``.
    """
    from .markdown import storage_html
    given = F.array(F.when(F.col("body_html").isNull(), F.col("body_markdown")),
                    F.when(F.col("append_html").isNull(), F.col("append_markdown")))
    out = changes.withColumn("__html", F.transform(given, lambda t: F.when(t.isNotNull(), storage_html(t, mermaid_macro))))
    return (out.withColumn("append_source", F.when(F.col("append_html").isNotNull(), "storage_html")
                           .when(F.col("append_markdown").isNotNull(), "markdown"))
            .withColumn("body_html", F.coalesce(F.col("body_html"), F.col("__html")[0]))
            .withColumn("append_html", F.coalesce(F.col("append_html"), F.col("__html")[1])).drop("__html"))
