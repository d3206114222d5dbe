"""Registered change-set and triage queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import changes as ch
from ..operators import triage as tg
from ..sources import driver_tables as dt
from ..sources.schemas import CHANGE_DDL, struct_type
from . import sqlgen as q
from .catalog import register


def order_changes(orders: DataFrame) -> DataFrame:
    """orders -> a change set mixing every action, intents and guard outcomes."""
    k = F.col("o_orderkey")
    ks = k.cast("string")
    action = (F.when(k % 5 == 0, "create-page").when(k % 5 == 1, "update-page").when(k % 5 == 2, "move-page")
              .when(k % 5 == 3, "jira-create-issue").otherwise("jira-add-comment"))
    cols = {
        "request_id": F.concat(F.lit("req-"), ks), "seq": k, "action": action,
        "allow_write": k % 3 != 0, "dry_run": k % 7 == 0,
        "page_id": ks, "space_key": F.concat(F.lit("SP"), (k % 4).cast("string")),
        "parent_id": F.when(k % 11 == 0, F.lit(None)).otherwise((F.col("o_custkey") % 40).cast("string")),
        "new_parent_id": (F.col("o_custkey") % 30).cast("string"),
        "title": F.when(k % 13 == 0, F.lit(None)).otherwise(F.concat(F.lit("T"), ks)),
        "body_html": F.when(k % 13 == 0, F.lit(None)).otherwise(F.lit("<p>b</p>")),
        "project_key": F.when(k % 2 == 0, F.lit("ASIA")).otherwise(F.lit("MARS")),
        "issue_key": F.concat(F.lit("ORD-"), ks),
        "summary": F.concat(F.lit("Summary "), ks),
        "issue_type_name": F.col("o_orderpriority"),
        "description": F.when(k % 4 == 0, F.lit(None)).otherwise(F.concat(F.lit("Desc  "), ks, F.lit("\n more"))),
        "fields": F.when(k % 2 == 0, F.create_map(F.lit("priority"), F.concat(F.lit("P"), (k % 3).cast("string")),
                                                   F.lit("summary"), F.lit("Override"))),
        "comment_body": F.concat(F.lit("Comment for "), ks, F.lit("  with   spaces")),
    }
    schema = struct_type(CHANGE_DDL)
    return orders.select(*[(cols[f.name] if f.name in cols else F.lit(None)).cast(f.dataType).alias(f.name)
                           for f in schema.fields])


def allowlist(region: DataFrame, nation: DataFrame) -> DataFrame:
    spaces = region.filter(F.col("r_regionkey") < 3).select(
        F.lit("space").alias("kind"), F.concat(F.lit("SP"), F.col("r_regionkey").cast("string")).alias("value"))
    projects = region.select(F.lit("project").alias("kind"), F.col("r_name").alias("value"))
    parents = nation.select(F.lit("parent").alias("kind"), F.col("n_nationkey").cast("string").alias("value"))
    return spaces.unionByName(projects).unionByName(parents)


_K = "CAST(o_orderkey AS VARCHAR)"
_CHANGES_SQL = f"""WITH c AS (
  SELECT o_orderkey AS k, 'req-' || {_K} AS request_id,
    CASE o_orderkey % 5 WHEN 0 THEN 'create-page' WHEN 1 THEN 'update-page' WHEN 2 THEN 'move-page'
         WHEN 3 THEN 'jira-create-issue' ELSE 'jira-add-comment' END AS action,
    o_orderkey % 3 <> 0 AS allow_write, o_orderkey % 7 = 0 AS dry_run,
    'SP' || CAST(o_orderkey % 4 AS VARCHAR) AS space_key,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_custkey % 40 AS VARCHAR) END AS parent_id,
    CAST(o_custkey % 30 AS VARCHAR) AS new_parent_id,
    CAST((o_custkey + o_orderkey % 2) % 30 AS VARCHAR) AS current_parent_id,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE 'T' || {_K} END AS title,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE '<p>b</p>' END AS body_html,
    CASE WHEN o_orderkey % 2 = 0 THEN 'ASIA' ELSE 'MARS' END AS project_key
  FROM orders),
v AS (SELECT c.*,
    space_key IN (SELECT 'SP' || CAST(r_regionkey AS VARCHAR) FROM region WHERE r_regionkey < 3) AS ok_space,
    COALESCE(parent_id IN (SELECT CAST(n_nationkey AS VARCHAR) FROM nation), false) AS ok_parent,
    new_parent_id IN (SELECT CAST(n_nationkey AS VARCHAR) FROM nation) AS ok_new_parent,
    project_key IN (SELECT r_name FROM region) AS ok_project
  FROM c)
SELECT request_id, action, CASE WHEN dry_run THEN 'preview' ELSE 'apply' END AS mode,
  CASE WHEN body_html IS NOT NULL THEN 'storage_html' END AS body_source,
  CASE
    WHEN NOT allow_write AND NOT dry_run THEN 'Write commands require --allow-write or --dry-run.'
    WHEN action = 'create-page' AND NOT ok_space
      THEN 'Write blocked: space key ' || space_key || ' is not in CONFLUENCE_ALLOWED_SPACE_KEYS.'
    WHEN action = 'create-page' AND COALESCE(parent_id, '') = ''
      THEN 'Write blocked: parent ID is required by CONFLUENCE_ALLOWED_PARENT_IDS.'
    WHEN action = 'create-page' AND NOT ok_parent
      THEN 'Write blocked: parent ID ' || parent_id || ' is not in CONFLUENCE_ALLOWED_PARENT_IDS.'
    WHEN action = 'update-page' AND title IS NULL AND body_html IS NULL
      THEN '{ch.UPDATE_NEEDS}'
    WHEN action = 'move-page' AND NOT ok_new_parent
      THEN 'Write blocked: parent ID ' || new_parent_id || ' is not in CONFLUENCE_ALLOWED_PARENT_IDS.'
    WHEN action = 'move-page' AND current_parent_id = new_parent_id
      THEN 'move-page requires different current and new parent IDs.'
    WHEN action = 'jira-create-issue' AND NOT ok_project
      THEN 'Write blocked: project key ' || project_key || ' is not in JIRA_ALLOWED_PROJECT_KEYS.'
  END AS error
FROM v"""


@register("guarded_changes", _CHANGES_SQL)
def q_guarded_changes(spark: SparkSession, sf: str) -> DataFrame:
    """V1-V7: intent, allowlist guards, update/move validation per request."""
    orders = dt.table(spark, sf, "orders")
    changes = order_changes(orders)
    pages = orders.select(F.col("o_orderkey").cast("string").alias("id"),
                          ((F.col("o_custkey") + F.col("o_orderkey") % 2) % 30).cast("string").alias("parent_id"))
    allow = allowlist(dt.table(spark, sf, "region"), dt.table(spark, sf, "nation"))
    v = ch.validate_changes(changes, allow, pages)
    return v.select("request_id", "action", "mode", "body_source", "error")


_APPLY_SQL = f"""WITH {q.pages_cte()},
e AS (SELECT *, page_id % 3 = 0 AS e1, page_id % 4 = 0 AS e2 FROM pg)
SELECT id, CASE WHEN e1 AND page_id % 9 <> 0 THEN 'New ' || id ELSE title END AS title,
  md5(CASE WHEN e2 THEN '<p>replaced ' || id || '</p>' WHEN e1 THEN body || '<p>appended</p>' ELSE body END)
    AS body_md5,
  CAST(version + CAST(e1 AS INTEGER) + CAST(e2 AS INTEGER) AS BIGINT) AS version,
  parent_id, CAST(CAST(e1 AS INTEGER) + CAST(e2 AS INTEGER) AS INTEGER) AS edit_count
FROM e"""


@register("apply_updates", _APPLY_SQL)
def q_apply_updates(spark: SparkSession, sf: str) -> DataFrame:
    """Next page snapshot after folding each page's edits in seq order."""
    wiki = dt.wiki_pages(dt.table(spark, sf, "pages"))
    pages = wiki.select("id", "title", F.col("body.storage.value").alias("body"),
                        F.col("version.number").alias("version"),
                        F.try_element_at("ancestors", F.lit(-1)).getField("id").alias("parent_id"))
    pid = F.col("id").cast("long")
    e1 = pages.filter(pid % 3 == 0).select(
        F.lit(1).alias("seq"), F.col("id").alias("page_id"),
        F.when(pid % 9 == 0, F.lit("")).otherwise(F.concat(F.lit("New "), F.col("id"))).alias("title"),
        F.lit(None).cast("string").alias("body_html"), F.lit("<p>appended</p>").alias("append_html"),
        F.lit(None).cast("string").alias("new_parent_id"))
    e2 = pages.filter(pid % 4 == 0).select(
        F.lit(2).alias("seq"), F.col("id").alias("page_id"), F.lit(None).cast("string").alias("title"),
        F.concat(F.lit("<p>replaced "), F.col("id"), F.lit("</p>")).alias("body_html"),
        F.lit(None).cast("string").alias("append_html"), F.lit(None).cast("string").alias("new_parent_id"))
    nxt = ch.apply_updates(pages, e1.unionByName(e2))
    return nxt.select("id", "title", F.md5("body").alias("body_md5"), "version", "parent_id",
                      F.col("edit_count").cast("int"))


def account_pages(customer: DataFrame) -> DataFrame:
    """A page with all its columns for four customers of five; the others' pages aren't there."""
    k = F.col("c_custkey").cast("string")
    return customer.where(F.col("c_custkey") % 5 != 0).select(
        k.alias("id"), F.lit("page").alias("type"), F.lit("current").alias("status"), F.col("c_name").alias("title"),
        F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("space_key"),
        F.concat(F.lit("<p>"), k, F.lit("</p>")).alias("body"), (F.col("c_custkey") % 9).cast("long").alias("version"),
        F.lit("root").alias("parent_id"), F.concat(F.lit("/p/"), k).alias("webui"))


def account_edits(orders: DataFrame) -> DataFrame:
    """An edit for each order: a move, a title, an append, or a body with an append."""
    k = F.col("o_orderkey").cast("string")
    kind = F.floor(F.col("o_orderkey") / 3) % 4
    return orders.select(
        F.col("o_orderkey").alias("seq"), F.concat(F.lit("e"), k).alias("request_id"),
        F.col("o_custkey").cast("string").alias("page_id"),
        F.when(kind == 1, F.concat(F.lit("T"), k)).when(kind == 2, F.lit("")).alias("title"),
        F.when(kind == 3, F.concat(F.lit("<h1>"), k, F.lit("</h1>"))).alias("body_html"),
        F.when(kind >= 2, F.concat(F.lit("<i>"), k, F.lit("</i>"))).when(kind == 1, F.lit("")).alias("append_html"),
        F.when(kind == 0, F.concat(F.lit("P"), (F.col("o_orderkey") % 10).cast("string"))).alias("new_parent_id"))


@register("apply_moves", """WITH o AS (SELECT o_custkey AS c, o_orderkey AS k, (o_orderkey // 3) % 4 AS kind FROM orders),
s AS (SELECT c, max(k) FILTER (WHERE kind = 3) AS since FROM o GROUP BY c),
e AS (SELECT o.c, count(*) AS n, max(k) FILTER (WHERE kind = 0) AS moved, max(k) FILTER (WHERE kind = 1) AS named,
    any_value(since) AS since,
    string_agg('<i>' || CAST(k AS VARCHAR) || '</i>', '' ORDER BY k) FILTER (WHERE kind >= 2 AND k >= COALESCE(since, 0)) AS tail
  FROM o JOIN s ON o.c = s.c GROUP BY o.c)
SELECT CAST(c_custkey AS VARCHAR) AS id, 'page' AS type, 'current' AS status,
  COALESCE('T' || CAST(named AS VARCHAR), c_name) AS title, 'S' || CAST(c_nationkey AS VARCHAR) AS space_key,
  COALESCE('<h1>' || CAST(since AS VARCHAR) || '</h1>', '<p>' || CAST(c_custkey AS VARCHAR) || '</p>') || COALESCE(tail, '') AS body,
  CAST(c_custkey % 9 + COALESCE(n, 0) AS BIGINT) AS version,
  COALESCE('P' || CAST(moved % 10 AS VARCHAR), 'root') AS parent_id, '/p/' || CAST(c_custkey AS VARCHAR) AS webui,
  CAST(COALESCE(n, 0) AS BIGINT) AS edit_count
FROM customer LEFT JOIN e ON c_custkey = e.c WHERE c_custkey % 5 <> 0""")
def q_apply_moves(spark: SparkSession, sf: str) -> DataFrame:
    """Whole next page records after moves, titles, bodies and appends, many to a page."""
    return ch.apply_updates(account_pages(dt.table(spark, sf, "customer")), account_edits(dt.table(spark, sf, "orders")))


@register("unapplied_edits", """SELECT 'e' || CAST(o_orderkey AS VARCHAR) AS request_id, CAST(o_custkey AS VARCHAR) AS page_id,
  'Page ' || CAST(o_custkey AS VARCHAR) || ' was not found.' AS error
FROM orders WHERE o_custkey % 5 = 0 OR o_custkey NOT IN (SELECT c_custkey FROM customer)""")
def q_unapplied_edits(spark: SparkSession, sf: str) -> DataFrame:
    """Edits of pages that aren't there."""
    lost = ch.unapplied(account_pages(dt.table(spark, sf, "customer")), account_edits(dt.table(spark, sf, "orders")))
    return lost.select("request_id", "page_id", "error")


# --------------------------------------------------------------------------
# L1-L4
# --------------------------------------------------------------------------

# Configuration-error messages used to generate the error log.
CONFIG_MESSAGES = [
    "Missing Confluence token.", "Missing Jira base URL.",
    "Write blocked: space key X is not in CONFLUENCE_ALLOWED_SPACE_KEYS.",
    "Write commands require --allow-write or --dry-run.",
    ch.UPDATE_NEEDS,
    'replace-section target heading "x" was not found.',
    "move-page requires different current and new parent IDs.",
    "Failed to parse Confluence storage HTML fragment.",
    "Something unexpected.",
]
STATUS_CODES = [401, 403, 404, 409, 429, 500, 503, 418]


def event_errors(events: DataFrame) -> DataFrame:
    """events -> ERROR rows (API errors with payloads, config errors, file/JSON errors)."""
    k = F.get_json_object("props", "$.k").cast("int")
    et = F.col("event_type")
    etype = (F.when(et == "error", "ConfigError").when(et.isin("view", "click"), "ApiError")
             .when(et == "purchase", "FileNotFoundError").otherwise("JSONDecodeError"))
    status = F.when(etype == "ApiError",
                    F.element_at(F.array(*[F.lit(s) for s in STATUS_CODES]), (F.col("event_id") % 8 + 1).cast("int")))
    msg = F.when(etype == "ConfigError",
                 F.element_at(F.array(*[F.lit(m) for m in CONFIG_MESSAGES]), (k % 9 + 1).cast("int")))
    payload = F.when(etype == "ApiError",
                     F.when(k % 3 == 0, F.concat(F.lit('{"message": "Boom '), k.cast("string"), F.lit('"}')))
                     .when(k % 3 == 1, F.concat(F.lit('{"errorMessages": ["a'), k.cast("string"), F.lit('", "b"]}')))
                     .otherwise(F.col("props")))
    return events.select(F.col("event_id").alias("error_id"),
                         F.when(F.col("user_id") % 2 == 0, "Confluence").otherwise("Jira").alias("product"),
                         etype.alias("error_type"), status.cast("int").alias("status_code"),
                         msg.alias("message"), payload.alias("payload"))


def _triage_sql() -> str:
    codes = ", ".join(str(s) for s in STATUS_CODES)
    msgs = ", ".join(q.lit(m) for m in CONFIG_MESSAGES)
    sg = "CASE"
    for lo, hi, hints in tg.STATUS_RULES:
        t = q.lit(tg.GUIDANCE_SEP.join(hints))
        sg += f" WHEN status_code BETWEEN {lo} AND {hi} THEN replace(replace({t}, '{{PU}}', upper(product)), '{{P}}', product)"
    sg += " END"
    cg = "CASE"
    for pats, hints in tg.CONFIG_RULES:
        cond = " OR ".join(f"contains(lower(message), {q.lit(p)})" for p in pats)
        cg += f" WHEN {cond} THEN {q.lit(tg.GUIDANCE_SEP.join(hints))}"
    cg += " END"
    return f"""WITH ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
e AS (SELECT event_id AS error_id, CASE WHEN user_id % 2 = 0 THEN 'Confluence' ELSE 'Jira' END AS product,
    CASE WHEN event_type = 'error' THEN 'ConfigError' WHEN event_type IN ('view', 'click') THEN 'ApiError'
         WHEN event_type = 'purchase' THEN 'FileNotFoundError' ELSE 'JSONDecodeError' END AS error_type,
    event_id, k, props
  FROM ev),
f AS (SELECT error_id, product, error_type,
    CAST(CASE WHEN error_type = 'ApiError' THEN ([{codes}])[event_id % 8 + 1] END AS INTEGER) AS status_code,
    CASE WHEN error_type = 'ConfigError' THEN ([{msgs}])[k % 9 + 1]
         WHEN error_type = 'ApiError' THEN (CASE WHEN k % 3 = 0 THEN 'Boom ' || CAST(k AS VARCHAR)
                                                 WHEN k % 3 = 1 THEN 'a' || CAST(k AS VARCHAR) || '; b'
                                                 ELSE product || ' API request failed' END) END AS message
  FROM e)
SELECT error_id, product, error_type, status_code, message,
  CASE WHEN error_type = 'ApiError' THEN {sg}
       WHEN error_type = 'ConfigError' THEN {cg}
       WHEN error_type = 'FileNotFoundError' THEN {q.lit(tg.FILE_HINT)}
       WHEN error_type = 'JSONDecodeError' THEN {q.lit(tg.JSON_HINT)} END AS guidance
FROM f"""


@register("error_triage", _triage_sql())
def q_error_triage(spark: SparkSession, sf: str) -> DataFrame:
    """L1-L4: message extraction and guidance by status / config rule."""
    return tg.triage(event_errors(dt.table(spark, sf, "events")))


# --------------------------------------------------------------------------
# Offset-paged batches
# --------------------------------------------------------------------------

BATCH_LIMIT = 3


def customer_batches(orders: DataFrame) -> DataFrame:
    """orders re-paged per customer: batches of 3 by order key; for every
    5th customer the third batch is missing, so its chain stops early."""
    from ..plans.scans import ordered_running_sum
    # per-customer numbering with the skew-safe two-level running count
    o = ordered_running_sum(orders.select("o_custkey", "o_orderkey", F.lit(1).alias("one")),
                            ["o_custkey"], "o_orderkey", "one", "n")
    o = o.select("o_custkey", "o_orderkey", (F.col("n") - 1).alias("rn"))
    o = o.withColumn("batch_no", F.floor(F.col("rn") / BATCH_LIMIT))
    o = o.filter(~((F.col("o_custkey") % 5 == 0) & (F.col("batch_no") == 2)))
    return o.groupBy("o_custkey", "batch_no").agg(
        F.array_sort(F.collect_list(F.struct(F.col("o_orderkey").alias("k"),
                                             F.col("o_orderkey").cast("string").alias("id")))).alias("r")
    ).select(F.col("o_custkey").cast("string").alias("entity_id"),
             (F.col("batch_no") * BATCH_LIMIT).cast("long").alias("start"),
             F.transform("r", lambda x: x.dropFields("k")).alias("results"))


@register("offset_batches", f"""WITH o AS (
  SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS rn FROM orders),
b AS (SELECT *, rn // {BATCH_LIMIT} AS batch_no FROM o)
SELECT CAST(o_custkey AS VARCHAR) AS entity_id, CAST(rn AS BIGINT) AS position, CAST(o_orderkey AS VARCHAR) AS item_id
FROM b WHERE NOT (o_custkey % 5 = 0 AND batch_no >= 2)""")
def q_offset_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Complete lists rebuilt from offset batches (stop at a gap / short batch)."""
    from ..sources.readers import merge_offset_batches
    m = merge_offset_batches(customer_batches(dt.table(spark, sf, "orders")), BATCH_LIMIT)
    return m.select("entity_id", "position", F.col("item.id").alias("item_id"))


# --------------------------------------------------------------------------
# previews and applies
# --------------------------------------------------------------------------

def _validated(spark: SparkSession, sf: str) -> DataFrame:
    orders = dt.table(spark, sf, "orders")
    pages = orders.select(F.col("o_orderkey").cast("string").alias("id"),
                          ((F.col("o_custkey") + F.col("o_orderkey") % 2) % 30).cast("string").alias("parent_id"))
    allow = allowlist(dt.table(spark, sf, "region"), dt.table(spark, sf, "nation"))
    return ch.validate_changes(order_changes(orders), allow, pages)


_VALID_ERR = "NOT (o_orderkey % 3 = 0 AND o_orderkey % 7 <> 0)"


@register("update_previews", f"""SELECT 'req-' || {_K} AS request_id, {_K} AS page_id,
  'Order ' || {_K} AS current_title, 'T' || {_K} AS next_title, true AS title_changed,
  true AS body_replaced, false AS body_appended,
  CAST(length('<p>order ' || {_K} || '</p>') AS INTEGER) AS current_body_length,
  CAST(8 AS INTEGER) AS next_body_length, 'b' AS body_preview,
  CAST(o_orderkey % 5 + 1 AS BIGINT) AS current_version
FROM orders WHERE o_orderkey % 5 = 1 AND {_VALID_ERR} AND o_orderkey % 13 <> 0
  AND o_orderkey % 7 = 0""")
def q_update_previews(spark: SparkSession, sf: str) -> DataFrame:
    """B2: update-page previews against the live pages."""
    orders = dt.table(spark, sf, "orders")
    live = orders.select(F.col("o_orderkey").cast("string").alias("id"),
                         F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title"),
                         F.concat(F.lit("<p>order "), F.col("o_orderkey").cast("string"), F.lit("</p>")).alias("body"),
                         (F.col("o_orderkey") % 5 + 1).cast("long").alias("version"),
                         F.lit("SP").alias("space_key"), F.lit(None).cast("string").alias("webui_url"))
    p = ch.preview_update(_validated(spark, sf), live)
    return p.select("request_id", "page_id", "current_title", "next_title", "title_changed", "body_replaced",
                    "body_appended", "current_body_length", "next_body_length", "body_preview", "current_version")


from .issue_queries import _ISSUE_CTE  # noqa: E402


@register("comment_previews", f"""WITH {_ISSUE_CTE}
SELECT 'req-' || id AS request_id, key AS issue_key, summary AS issue_summary, status AS issue_status, browse_url,
  CAST(length('Comment for ' || id || '  with   spaces') AS INTEGER) AS comment_length,
  'Comment for ' || id || ' with spaces' AS comment_preview
FROM iss WHERE o_orderkey % 5 = 4 AND o_orderkey % 7 = 0""")
def q_comment_previews(spark: SparkSession, sf: str) -> DataFrame:
    """Add-comment previews with the issue's summary and status."""
    from ..operators import summaries as sm
    iss = sm.summarize_issue(dt.issues(dt.table(spark, sf, "orders"), dt.table(spark, sf, "customer")),
                             dt.ISSUE_BASE).select("key", "summary", "status", "browse_url")
    return ch.preview_comment(_validated(spark, sf), iss)


_DESC = f"'Desc  ' || {_K} || chr(10) || ' more'"
_ISSUE_PREVIEW_SQL = f"""SELECT 'req-' || {_K} AS request_id, 'ASIA' AS project_key, 'Summary ' || {_K} AS summary,
  o_orderpriority AS issue_type_name,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'Desc ' || {_K} || ' more' END AS description_preview,
  CAST(CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE length({_DESC}) END AS INTEGER) AS description_length,
  'priority,summary' AS extra_field_keys,
  'https://issues.example.com/projects/ASIA' AS project_browse_url,
  CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'description=' || {_DESC} || ';' END
    || 'issuetype=' || o_orderpriority || ';priority=P' || CAST(o_orderkey % 3 AS VARCHAR)
    || ';project=ASIA;summary=Override' AS fields
FROM orders WHERE o_orderkey % 5 = 3 AND o_orderkey % 2 = 0 AND o_orderkey % 7 = 0"""


@register("issue_create_previews", _ISSUE_PREVIEW_SQL)
def q_issue_create_previews(spark: SparkSession, sf: str) -> DataFrame:
    """B6 + U5: create-issue previews and the merged field map (extras win)."""
    v = _validated(spark, sf)
    prev = ch.preview_issue(v, dt.ISSUE_BASE)
    merged = ch.apply_issue_fields(v).select(
        "request_id", F.array_join(F.transform(F.array_sort(F.map_entries("fields")),
                                               lambda e: F.concat(e.key, F.lit("="), e.value)), ";").alias("fields"))
    return prev.withColumn("extra_field_keys", F.array_join("extra_field_keys", ",")).join(merged, "request_id")


def part_attachments(part: DataFrame) -> DataFrame:
    return part.select(
        (F.col("p_partkey") % 50).cast("string").alias("page_id"), F.col("p_partkey").alias("ordinal"),
        F.concat(F.lit("att-"), F.col("p_partkey").cast("string")).alias("id"),
        F.concat(F.col("p_name"), F.lit(".png")).alias("title"),
        (F.col("p_size") * 1000).cast("long").alias("file_size"))


def part_uploads(part: DataFrame) -> DataFrame:
    """Uploads for every third part, half of them aimed at another page; the
    last request per (page, name) wins."""
    u = part.filter(F.col("p_partkey") % 3 == 0).select(
        F.concat(F.lit("up-"), F.col("p_partkey").cast("string")).alias("request_id"),
        ((F.col("p_partkey") + F.col("p_partkey") % 2) % 50).cast("string").alias("page_id"),
        F.concat(F.col("p_name"), F.lit(".png")).alias("file_name"),
        (F.col("p_size") * 10).cast("long").alias("file_size"), F.col("p_partkey").alias("seq"))
    return u.groupBy("page_id", "file_name").agg(
        F.max_by("request_id", "seq").alias("request_id"), F.max_by("file_size", "seq").alias("file_size"))


_ATT_CTE = """att AS (SELECT CAST(p_partkey % 50 AS VARCHAR) AS page_id, p_partkey AS ordinal,
    'att-' || CAST(p_partkey AS VARCHAR) AS id, p_name || '.png' AS title, CAST(p_size * 1000 AS BIGINT) AS file_size
  FROM part),
up0 AS (SELECT 'up-' || CAST(p_partkey AS VARCHAR) AS request_id,
    CAST((p_partkey + p_partkey % 2) % 50 AS VARCHAR) AS page_id, p_name || '.png' AS file_name,
    CAST(p_size * 10 AS BIGINT) AS file_size, p_partkey AS seq FROM part WHERE p_partkey % 3 = 0),
up AS (SELECT page_id, file_name, arg_max(request_id, seq) AS request_id, arg_max(file_size, seq) AS file_size
  FROM up0 GROUP BY page_id, file_name)"""


@register("attachment_preview", f"""WITH {_ATT_CTE},
fa AS (SELECT page_id, title, arg_min(id, ordinal) AS existing_id FROM att GROUP BY page_id, title)
SELECT request_id, up.page_id, file_name, file_size,
  CASE WHEN existing_id IS NULL THEN 'create' ELSE 'replace' END AS mode, existing_id
FROM up LEFT JOIN fa ON up.page_id = fa.page_id AND up.file_name = fa.title""")
def q_attachment_preview(spark: SparkSession, sf: str) -> DataFrame:
    """Upload previews: replace iff the page already has that file name."""
    part = dt.table(spark, sf, "part")
    p = ch.preview_attachment(part_uploads(part), part_attachments(part).withColumn("media_type", F.lit("image/png"))
                              .withColumn("download_url", F.lit(None).cast("string")))
    return p.select("request_id", "page_id", "file_name", "file_size", "mode",
                    F.col("existing_attachment.id").alias("existing_id"))


@register("attachment_upsert", f"""WITH {_ATT_CTE},
a2 AS (SELECT *, ordinal = min(ordinal) OVER (PARTITION BY page_id, title) AS is_first FROM att)
SELECT COALESCE(a2.page_id, up.page_id) AS page_id, COALESCE(a2.title, up.file_name) AS title,
  CASE WHEN up.request_id IS NULL THEN 'image/x-scan' ELSE 'image/png' END AS media_type,
  COALESCE(a2.id, 'new-' || up.request_id) AS id, a2.ordinal,
  COALESCE(up.file_size, a2.file_size) AS file_size,
  CASE WHEN up.request_id IS NULL THEN 'unchanged' WHEN a2.id IS NULL THEN 'created' ELSE 'replaced' END AS change
FROM a2 FULL OUTER JOIN up ON a2.page_id = up.page_id AND a2.title = up.file_name AND a2.is_first""")
def q_attachment_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """U4: attachments after the uploads (replace first same-name, else create)."""
    part = dt.table(spark, sf, "part")
    return ch.apply_attachments(part_attachments(part).withColumn("media_type", F.lit("image/x-scan")),
                                part_uploads(part))


# --------------------------------------------------------------------------
# V3, V4 with page and issue allowlists; B5 over a guarded change set
# --------------------------------------------------------------------------

# Fixed values of the generated uploads: file extensions and their media types.
UPLOAD_TYPES = {".png": "image/png", ".PDF": "application/pdf", ".tar.gz": "application/x-tar",
                ".unknown": "application/octet-stream", "": "application/octet-stream", ".csv.bz2": "text/csv"}


def part_requests(part: DataFrame) -> DataFrame:
    """part -> page and issue requests, some for objects outside the allowlists."""
    k, ks = F.col("p_partkey"), F.col("p_partkey").cast("string")
    action = F.element_at(F.array(*map(F.lit, ("update-page", "replace-section", "move-page", "upload-attachment",
                                               "jira-add-comment"))), (k % 5 + 1).cast("int"))
    ext = F.element_at(F.array(*map(F.lit, UPLOAD_TYPES)), (F.floor(k / 5) % len(UPLOAD_TYPES) + 1).cast("int"))
    cols = {
        "request_id": F.concat(F.lit("pr-"), ks), "seq": k, "action": action, "allow_write": k % 3 > 0,
        "dry_run": k % 4 < 2, "page_id": F.when(k % 17 > 0, (k % 50).cast("string")),
        "issue_key": F.concat(F.lit("P-"), (k % 40).cast("string")), "title": F.when(k % 2 == 0, "T"),
        "new_parent_id": (k % 30).cast("string"), "comment_body": F.lit("c"),
        "file_name": F.concat(F.lit("f"), (k % 7).cast("string"), ext), "file_size": F.col("p_size").cast("long"),
        "comment": F.when(k % 3 == 0, F.concat(F.lit("up "), ks)), "major_edit": F.when(k % 6 > 1, k % 6 > 3),
    }
    return part.select(*[(cols[f.name] if f.name in cols else F.lit(None)).cast(f.dataType).alias(f.name)
                         for f in struct_type(CHANGE_DDL).fields])


def part_allowlist(nation: DataFrame) -> DataFrame:
    """nation -> allowed pages and parents 0..24, issues P-0..P-24."""
    n = F.col("n_nationkey").cast("string")
    return nation.select(F.inline(F.array(
        F.struct(F.lit("page").alias("kind"), n.alias("value")),
        F.struct(F.lit("parent").alias("kind"), n.alias("value")),
        F.struct(F.lit("issue").alias("kind"), F.concat(F.lit("P-"), n).alias("value")))))


def _requests_validated(spark: SparkSession, sf: str) -> DataFrame:
    part = dt.table(spark, sf, "part")
    pages = dt.table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("id"),
                                                 (F.col("n_nationkey") % 4).cast("string").alias("parent_id"))
    return ch.validate_changes(part_requests(part), part_allowlist(dt.table(spark, sf, "nation")), pages)


_REQUESTS_CTE = f"""r AS (
  SELECT p_partkey AS k, 'pr-' || p_partkey AS request_id,
    ['update-page', 'replace-section', 'move-page', 'upload-attachment', 'jira-add-comment'][p_partkey % 5 + 1] AS action,
    p_partkey % 4 < 2 AS dry_run, p_partkey % 3 > 0 OR p_partkey % 4 < 2 AS meant,
    CASE WHEN p_partkey % 17 > 0 THEN CAST(p_partkey % 50 AS VARCHAR) END AS page_id,
    'P-' || (p_partkey % 40) AS issue_key, p_partkey % 50 AS pg, p_partkey % 30 AS np, p_size FROM part),
g AS (SELECT *, CASE
    WHEN NOT meant THEN 'Write commands require --allow-write or --dry-run.'
    WHEN k % 5 < 4 AND page_id IS NULL
      THEN 'Write blocked: page ID None is not in CONFLUENCE_ALLOWED_PAGE_IDS.'
    WHEN k % 5 < 4 AND pg >= 25
      THEN 'Write blocked: page ID ' || pg || ' is not in CONFLUENCE_ALLOWED_PAGE_IDS.'
    WHEN k % 5 = 0 AND k % 2 = 1 THEN '{ch.UPDATE_NEEDS}'
    WHEN k % 5 = 2 AND np >= 25 THEN 'Write blocked: parent ID ' || np || ' is not in CONFLUENCE_ALLOWED_PARENT_IDS.'
    WHEN k % 5 = 2 AND np = pg % 4 THEN 'move-page requires different current and new parent IDs.'
    WHEN k % 5 = 4 AND k % 40 >= 25
      THEN 'Write blocked: issue key ' || issue_key || ' is not in JIRA_ALLOWED_ISSUE_KEYS.'
  END AS error FROM r)"""


@register("guarded_pages", f"""WITH {_REQUESTS_CTE}
SELECT request_id, action, page_id, CASE WHEN dry_run THEN 'preview' ELSE 'apply' END AS mode, error
FROM g WHERE k % 5 < 4""")
def q_guarded_pages(spark: SparkSession, sf: str) -> DataFrame:
    """V3 under a page allowlist: updates, section edits, moves and uploads (V1, V5, V6 too)."""
    return (_requests_validated(spark, sf).filter(F.col("action") != "jira-add-comment")
            .select("request_id", "action", "page_id", "mode", "error"))


@register("guarded_issues", f"""WITH {_REQUESTS_CTE}
SELECT request_id, issue_key, CASE WHEN dry_run THEN 'preview' ELSE 'apply' END AS mode, error FROM g WHERE k % 5 = 4""")
def q_guarded_issues(spark: SparkSession, sf: str) -> DataFrame:
    """V4 under an issue allowlist."""
    return (_requests_validated(spark, sf).filter(F.col("action") == "jira-add-comment")
            .select("request_id", "issue_key", "mode", "error"))


@register("upload_previews", f"""WITH {_REQUESTS_CTE},
att AS (SELECT CAST(p_partkey % 50 AS VARCHAR) AS page_id, 'f' || (p_partkey % 3) || '.png' AS title,
    min(p_partkey) AS first_key FROM part GROUP BY 1, 2),
u AS (SELECT *, CAST(floor(k / 5) AS BIGINT) % {len(UPLOAD_TYPES)} + 1 AS t FROM g
      WHERE k % 5 = 3 AND error IS NULL AND dry_run),
n AS (SELECT *, 'f' || (k % 7) || {list(UPLOAD_TYPES)}[t] AS file_name FROM u)
SELECT request_id, n.page_id, file_name, CAST(p_size AS BIGINT) AS file_size, {list(UPLOAD_TYPES.values())}[t] AS content_type,
  CASE WHEN k % 3 = 0 THEN 'up ' || k END AS comment, k % 6 <= 3 AS minor_edit,
  CASE WHEN first_key IS NULL THEN 'create' ELSE 'replace' END AS mode, 'a-' || first_key AS existing_id
FROM n LEFT JOIN att ON n.page_id = att.page_id AND n.file_name = att.title""")
def q_upload_previews(spark: SparkSession, sf: str) -> DataFrame:
    """Previews of guarded uploads with content type, comment and kind of edit."""
    k = F.col("p_partkey")
    existing = dt.table(spark, sf, "part").select(
        (k % 50).cast("string").alias("page_id"), k.alias("ordinal"), F.concat(F.lit("a-"), k).alias("id"),
        F.concat(F.lit("f"), (k % 3).cast("string"), F.lit(".png")).alias("title"), F.lit("image/png").alias("media_type"),
        F.lit(1).alias("file_size"), F.lit(None).cast("string").alias("download_url"))
    p = ch.preview_uploads(_requests_validated(spark, sf), existing)
    return p.select(
        "request_id", "page_id", "file_name", "file_size", "content_type", "comment", "minor_edit", "mode",
        F.col("existing_attachment.id").alias("existing_id"))
