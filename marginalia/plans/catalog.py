"""Registered queries: each reads the driver tables at ``sf_dir`` and returns
a DataFrame; most have an independent DuckDB SQL oracle.

Column names are aliased identically on both sides (the checker sorts
columns by name before hashing values).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import threads as th
from ..sources import driver_tables as dt
from . import sqlgen as q

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# Parameters shared by the registered queries and their oracles.
EXPORTED_AT = "2024-01-01T00:00:00+00:00"

# --------------------------------------------------------------------------
# comment threads
# --------------------------------------------------------------------------


def _event_comments(spark: SparkSession, sf: str) -> DataFrame:
    raw = dt.comments_from_events(dt.table(spark, sf, "events"))
    return th.normalize_comments(raw, dt.WIKI_BASE)


def _event_threads(spark: SparkSession, sf: str) -> DataFrame:
    return th.thread_rollup(th.assign_threads(_event_comments(spark, sf)))


THREAD_COLS = ["page_id", "thread_id", "selection", "marker_ref", "status", "status_rank", "comment_count",
               "anchored_count", "reply_count", "participants", "latest_comment_at", "latest_comment_excerpt",
               "latest_comment_url", "first_position"]


def _thread_out(df: DataFrame) -> DataFrame:
    return df.select(*THREAD_COLS).withColumn("status_rank", F.col("status_rank").cast("int"))


_EVENT_RAW_SQL = f"""
ev AS (
  SELECT user_id, event_id, event_type, ts,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
),
raw AS (
  SELECT CAST(user_id AS VARCHAR) AS page_id, event_id AS position, CAST(event_id AS VARCHAR) AS id,
    CASE WHEN event_type IN ('click', 'signup')
         THEN (CASE WHEN k % 2 = 0 THEN ' Quote ' ELSE 'quote ' END) || CAST(k % 8 AS VARCHAR) END AS sel,
    CASE WHEN event_type IN ('click', 'error') THEN 'mk-' || CAST(k % 6 AS VARCHAR) END AS marker,
    CASE WHEN event_type = 'click' THEN 'open' WHEN event_type = 'error' THEN 'dangling'
         WHEN event_type = 'purchase' THEN 'resolved'
         WHEN event_type = 'view' AND k % 3 = 0 THEN 'archived' END AS st,
    CASE WHEN k % 10 = 0 THEN NULL WHEN k % 10 = 1 THEN '' ELSE 'Author ' || CAST(k % 7 AS VARCHAR) END AS author,
    CASE WHEN k % 17 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d') END AS created_at,
    '<p>Event <b>' || event_type || '</b> &amp; k=' || CAST(k AS VARCHAR) || '</p><ul><li>item '
      || CAST(k AS VARCHAR) || '</li></ul>' || repeat('lorem ', k % 50) || '&lt;end&gt;' AS body,
    CASE WHEN k % 9 = 0 THEN NULL
         ELSE '/spaces/EV/pages/' || CAST(user_id AS VARCHAR) || '?focusedCommentId=' || CAST(event_id AS VARCHAR)
    END AS webui
  FROM ev
)"""

_CONV_RAW_SQL = """
raw AS (
  SELECT CAST(conv_id AS VARCHAR) AS page_id, turn AS position,
    CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS id,
    CASE WHEN role = 'system' THEN substr(text, 1, 40) END AS sel,
    CAST(NULL AS VARCHAR) AS marker,
    CASE WHEN role = 'user' THEN 'open' WHEN role = 'assistant' THEN 'resolved' END AS st,
    role AS author,
    '2024-01-01T00:00:0' || CAST(turn AS VARCHAR) AS created_at,
    text AS body,
    '/conv/' || CAST(conv_id AS VARCHAR) || '#' || CAST(turn AS VARCHAR) AS webui
  FROM conversations
)"""


def _threads_sql(raw_ctes: str, base: str, select_tail: str, extra_ctes: str = "") -> str:
    body_text = q.html_to_text("body")
    return f"""
WITH {raw_ctes},
c AS (
  SELECT page_id, position, id,
    COALESCE(NULLIF(st, ''), 'unknown') AS status,
    {q.strip("COALESCE(sel, '')")} AS selection,
    {q.strip("COALESCE(marker, '')")} AS marker_ref,
    {body_text} AS body_text,
    created_at,
    COALESCE(NULLIF(author, ''), 'Unknown') AS created_by,
    CASE WHEN webui IS NOT NULL AND webui <> '' THEN '{base}' || webui END AS webui_url
  FROM raw
),
c2 AS (
  SELECT *, {q.truncate(q.single_line("body_text"), 160)} AS excerpt,
    CASE WHEN marker_ref <> '' THEN 'm:' || marker_ref
         WHEN selection <> '' THEN 's:' || CAST(position AS VARCHAR) END AS own_key
  FROM c
),
a AS (
  SELECT *,
    COALESCE(LAST_VALUE(own_key IGNORE NULLS) OVER (PARTITION BY page_id ORDER BY position
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'o:') AS thread_key,
    FIRST_VALUE(id) OVER (PARTITION BY page_id ORDER BY position
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS page_first_id
  FROM c2
),
lt AS (
  SELECT page_id, thread_key, created_at AS latest_comment_at, excerpt AS latest_comment_excerpt,
         webui_url AS latest_comment_url
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY page_id, thread_key
               ORDER BY COALESCE(created_at, '') DESC, position ASC) AS rn FROM a) WHERE rn = 1
),
an AS (
  SELECT page_id, thread_key, id AS a_id, selection AS a_sel, marker_ref AS a_marker
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY page_id, thread_key ORDER BY position) AS rn
        FROM a WHERE own_key IS NOT NULL) WHERE rn = 1
),
g AS (
  SELECT page_id, thread_key, count(*) AS comment_count, min(position) AS first_position,
    min(page_first_id) AS page_first_id, count(own_key) AS anchored_count,
    bool_or(status = 'open') AS h_open, bool_or(status = 'dangling') AS h_dangling,
    bool_or(status = 'resolved') AS h_resolved,
    arg_max(status, position) AS last_status,
    string_agg(DISTINCT created_by, ', ' ORDER BY created_by) AS participants
  FROM a GROUP BY page_id, thread_key
),
t AS (
  SELECT g.page_id, g.thread_key,
    CASE WHEN an.a_id IS NULL THEN 'orphan-' || g.page_first_id
         WHEN an.a_marker <> '' THEN an.a_marker ELSE 'selection-' || an.a_id END AS thread_id,
    CASE WHEN an.a_id IS NULL THEN '(Reply without quoted selection)'
         ELSE COALESCE(NULLIF(an.a_sel, ''), '(No quoted selection)') END AS selection,
    NULLIF(an.a_marker, '') AS marker_ref,
    CASE WHEN h_open THEN 'open' WHEN h_dangling THEN 'dangling' WHEN h_resolved THEN 'resolved'
         ELSE last_status END AS status,
    comment_count, anchored_count, comment_count - anchored_count AS reply_count,
    participants, lt.latest_comment_at, lt.latest_comment_excerpt, lt.latest_comment_url,
    first_position
  FROM g LEFT JOIN an USING (page_id, thread_key) LEFT JOIN lt USING (page_id, thread_key)
),
tr AS (
  SELECT *, CAST(CASE status WHEN 'open' THEN 0 WHEN 'dangling' THEN 1 WHEN 'resolved' THEN 2
                 ELSE 99 END AS INTEGER) AS status_rank
  FROM t
){extra_ctes}
{select_tail}
"""


_THREAD_SELECT = ("SELECT page_id, thread_id, selection, marker_ref, status, status_rank, comment_count, "
                  "anchored_count, reply_count, participants, latest_comment_at, latest_comment_excerpt, "
                  "latest_comment_url, first_position FROM tr")


@register("thread_rollup", _threads_sql(_EVENT_RAW_SQL, dt.WIKI_BASE, _THREAD_SELECT))
def q_thread_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """C1-C5, C7 keys: every thread of every page."""
    return _thread_out(_event_threads(spark, sf))


@register("thread_open", _threads_sql(
    _EVENT_RAW_SQL, dt.WIKI_BASE,
    _THREAD_SELECT + " WHERE (page_id, thread_key) IN "
                     "(SELECT page_id, thread_key FROM a WHERE status = 'open')"))
def q_thread_open(spark: SparkSession, sf: str) -> DataFrame:
    """Threads with any open comment."""
    return _thread_out(th.filter_threads(_event_threads(spark, sf), "open"))


_SEL_RESOLVED = "(SELECT DISTINCT page_id, thread_key FROM a WHERE status = 'resolved')"

_SUMMARY_TAIL = f"""
, sel AS (SELECT tr.* FROM tr JOIN {_SEL_RESOLVED} s USING (page_id, thread_key)),
pp AS (SELECT page_id, count(*) AS all_comment_count,
              count(*) FILTER (WHERE status = 'resolved') AS matching_comment_count FROM a GROUP BY page_id),
ps AS (SELECT page_id, sum(comment_count) AS total_comments, sum(anchored_count) AS anchored_comment_count,
              sum(reply_count) AS reply_comment_count, count(*) AS thread_count,
              count(*) FILTER (WHERE status = 'open') AS open_thread_count FROM sel GROUP BY page_id)
"""


@register("page_comment_summary", _threads_sql(
    _EVENT_RAW_SQL, dt.WIKI_BASE,
    """SELECT pp.page_id, 'resolved' AS status_filter,
       CAST(COALESCE(total_comments, 0) AS BIGINT) AS total_comments, all_comment_count, matching_comment_count,
       CAST(COALESCE(anchored_comment_count, 0) AS BIGINT) AS anchored_comment_count,
       CAST(COALESCE(reply_comment_count, 0) AS BIGINT) AS reply_comment_count,
       CAST(COALESCE(thread_count, 0) AS BIGINT) AS thread_count,
       CAST(COALESCE(open_thread_count, 0) AS BIGINT) AS open_thread_count
       FROM pp LEFT JOIN ps USING (page_id)""", _SUMMARY_TAIL))
def q_page_comment_summary(spark: SparkSession, sf: str) -> DataFrame:
    """C6 + C8 with the ``resolved`` filter (selected threads may be open)."""
    return th.page_comment_summary(_event_threads(spark, sf), "resolved")


@register("comment_status_counts", _threads_sql(
    _EVENT_RAW_SQL, dt.WIKI_BASE,
    """SELECT page_id, 'comment' AS scope, status, count(*) AS n
         FROM a JOIN sel_keys USING (page_id, thread_key) GROUP BY page_id, status
       UNION ALL
       SELECT page_id, 'thread' AS scope, status, count(*) AS n
         FROM tr JOIN sel_keys USING (page_id, thread_key) GROUP BY page_id, status""",
    f", sel_keys AS {_SEL_RESOLVED}"))
def q_comment_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    """C8 status maps as rows, ``resolved`` filter."""
    return th.status_counts(_event_threads(spark, sf), "resolved")


@register("conversation_threads", _threads_sql(_CONV_RAW_SQL, dt.WIKI_BASE, _THREAD_SELECT))
def q_conversation_threads(spark: SparkSession, sf: str) -> DataFrame:
    """C1-C5 over conversations (system turns anchor, others reply)."""
    raw = dt.comments_from_conversations(dt.table(spark, sf, "conversations"))
    assigned = th.assign_threads(th.normalize_comments(raw, dt.WIKI_BASE))
    return _thread_out(th.thread_rollup(assigned))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    return q_thread_rollup(spark, sf)


# Query families registered in their own modules (imported for the side effect).
from . import page_queries  # noqa: E402,F401
from . import issue_queries  # noqa: E402,F401
from . import markup_queries  # noqa: E402,F401
from . import edit_queries  # noqa: E402,F401
from . import change_queries  # noqa: E402,F401
from . import markdown_queries  # noqa: E402,F401
from . import more_queries  # noqa: E402,F401
