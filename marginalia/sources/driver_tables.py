"""Adapters: the driver's generic tables re-shaped into this library's records.

The benchmark tables are TPC-H-like plus ``events`` / ``pages`` /
``conversations`` / ``documents``. Each adapter is a pure projection (no
shuffle) that maps them onto the wiki/issue record schemas, so every query
reads the given tables and its work grows with them. The same mappings are
spelled in SQL in ``plans.catalog`` for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Base URLs used by the adapters.
WIKI_BASE = "https://wiki.example.com"
ISSUE_BASE = "https://issues.example.com"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def comments_from_events(events: DataFrame) -> DataFrame:
    """events -> COMMENT records.

    page = user_id, position = event_id; the event type decides anchor kind
    and resolution status; ``props.k`` varies selection, marker, author and
    body length. Created dates are days, so ties are common (tie rules matter).
    """
    k = _k()
    et = F.col("event_type")
    selection = F.when(et.isin("click", "signup"),
                       F.concat(F.when(k % 2 == 0, F.lit(" Quote ")).otherwise(F.lit("quote ")),
                                (k % 8).cast("string")))
    marker = F.when(et.isin("click", "error"), F.concat(F.lit("mk-"), (k % 6).cast("string")))
    status = (F.when(et == "click", F.lit("open"))
              .when(et == "error", F.lit("dangling"))
              .when(et == "purchase", F.lit("resolved"))
              .when((et == "view") & (k % 3 == 0), F.lit("archived")))
    author = F.when(k % 10 == 0, F.lit(None).cast("string")).when(k % 10 == 1, F.lit("")).otherwise(
        F.concat(F.lit("Author "), (k % 7).cast("string")))
    created = F.when(k % 17 == 0, F.lit(None).cast("string")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    body = F.concat(F.lit("<p>Event <b>"), et, F.lit("</b> &amp; k="), k.cast("string"),
                    F.lit("</p><ul><li>item "), k.cast("string"), F.lit("</li></ul>"),
                    F.repeat(F.lit("lorem "), k % 50), F.lit("&lt;end&gt;"))
    webui = F.when(k % 9 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("/spaces/EV/pages/"), F.col("user_id").cast("string"),
                 F.lit("?focusedCommentId="), F.col("event_id").cast("string")))
    return events.select(
        F.col("user_id").cast("string").alias("page_id"),
        F.col("event_id").alias("position"),
        F.col("event_id").cast("string").alias("id"),
        F.struct(created.alias("createdDate"),
                 F.struct(author.alias("displayName")).alias("createdBy")).alias("history"),
        F.struct(F.struct(body.alias("value")).alias("storage")).alias("body"),
        F.struct(F.struct(selection.alias("originalSelection"), marker.alias("markerRef")).alias("inlineProperties"),
                 F.struct(status.alias("status")).alias("resolution")).alias("extensions"),
        F.struct(webui.alias("webui")).alias("_links"),
    )


def comments_from_conversations(conv: DataFrame) -> DataFrame:
    """conversations -> COMMENT records: conv = page, turn = position,
    role = author, ``system`` turns quote a selection (anchors), the rest reply."""
    role = F.col("role")
    selection = F.when(role == "system", F.substring("text", 1, 40))
    status = F.when(role == "user", F.lit("open")).when(role == "assistant", F.lit("resolved"))
    return conv.select(
        F.col("conv_id").cast("string").alias("page_id"),
        F.col("turn").alias("position"),
        F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("id"),
        F.struct(F.concat(F.lit("2024-01-01T00:00:0"), F.col("turn").cast("string")).alias("createdDate"),
                 F.struct(role.alias("displayName")).alias("createdBy")).alias("history"),
        F.struct(F.struct(F.col("text").alias("value")).alias("storage")).alias("body"),
        F.struct(F.struct(selection.alias("originalSelection"), F.lit(None).cast("string").alias("markerRef"))
                 .alias("inlineProperties"),
                 F.struct(status.alias("status")).alias("resolution")).alias("extensions"),
        F.struct(F.concat(F.lit("/conv/"), F.col("conv_id").cast("string"), F.lit("#"),
                          F.col("turn").cast("string")).alias("webui")).alias("_links"),
    )


def pages_for_comments(events: DataFrame) -> DataFrame:
    """One PAGE record per commented page of ``comments_from_events``."""
    uid = F.col("user_id").cast("string")
    return (events.select("user_id").distinct().select(
        uid.alias("id"), F.lit("page").alias("type"), F.lit("current").alias("status"),
        F.concat(F.lit("Page "), uid).alias("title"),
        F.struct(F.lit("EV").alias("key")).alias("space"),
        F.struct(F.lit(1).cast("long").alias("number")).alias("version"),
        F.struct(F.struct(F.lit("").alias("value")).alias("storage")).alias("body"),
        F.array().cast("array<struct<id:string>>").alias("ancestors"),
        F.struct(F.lit(WIKI_BASE).alias("base"),
                 F.concat(F.lit("/spaces/EV/pages/"), uid).alias("webui")).alias("_links"),
    ))


# --------------------------------------------------------------------------
# pages -> PAGE records, child edges, exported documents
# --------------------------------------------------------------------------

TREE_FANOUT = 4


def _ancestor_ids(pid: Column, max_levels: int = 40) -> Column:
    """Ancestor chain root..parent of the implicit tree parent = (id-1) div 4.

    The k-th ancestor has the closed form floor((id - (4^k-1)/3) / 4^k), so
    the chain is one ``transform`` over a fixed-size sequence, no recursion.
    """
    ks = F.sequence(F.lit(max_levels), F.lit(1), F.lit(-1))
    anc = F.transform(ks, lambda k: F.floor(
        (pid - (F.pow(F.lit(4.0), k) - 1) / 3) / F.pow(F.lit(4.0), k)).cast("long"))
    anc = F.filter(anc, lambda a: a >= 0)
    return F.transform(anc, lambda a: F.struct(a.cast("string").alias("id")))


def wiki_pages(pages: DataFrame) -> DataFrame:
    """pages -> PAGE records (title from ``<title>``, some bodies blanked so
    that hub detection has work, a few pages without a web link)."""
    from ..functions import text as tx
    pid = F.col("page_id")
    title = tx.html_unescape(F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1))
    body = (F.when(pid % 7 == 0, F.lit("<p><br/></p>"))
            .when(pid % 7 == 3, F.lit("<!-- draft --><p>&nbsp;</p>"))
            .otherwise(F.col("html")))
    webui = F.when(pid % 6 == 5, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("/pages/"), pid.cast("string")))
    return pages.select(
        pid.cast("string").alias("id"), F.lit("page").alias("type"), F.lit("current").alias("status"),
        title.alias("title"),
        F.struct(F.concat(F.lit("SP"), (pid % 3).cast("string")).alias("key")).alias("space"),
        F.struct((pid % 5 + 1).cast("long").alias("number")).alias("version"),
        F.struct(F.struct(body.alias("value")).alias("storage")).alias("body"),
        _ancestor_ids(pid).alias("ancestors"),
        F.struct(F.lit(WIKI_BASE).alias("base"), webui.alias("webui")).alias("_links"),
    )


def child_edges(wiki: DataFrame) -> DataFrame:
    """CHILD rows: every page with a parent, ordinal = its numeric id."""
    parent = F.try_element_at(F.col("ancestors"), F.lit(-1)).getField("id")
    return (wiki.withColumn("parent_id", parent).filter(F.col("parent_id").isNotNull())
            .withColumn("ordinal", F.col("id").cast("long")))


def exported_docs(pages: DataFrame) -> DataFrame:
    """pages -> exported Markdown documents ``(path, text)`` with frontmatter;
    some lack frontmatter, some are unclosed, some lack the page id or version."""
    from ..functions import text as tx
    pid = F.col("page_id")
    ps = pid.cast("string")
    title = tx.html_unescape(F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1))
    good = F.concat(
        F.lit('---\ntitle: "'), F.replace(title, F.lit('"'), F.lit("'")), F.lit('"\n'),
        F.when(pid % 5 == 2, F.lit("")).otherwise(F.concat(F.lit("confluence_page_id: "), ps, F.lit("\n"))),
        F.lit("confluence_version: "),
        F.when(pid % 4 == 0, F.lit("")).otherwise((pid % 7).cast("string")),
        F.lit("\nsource_url: " + WIKI_BASE + "/pages/"), ps,
        F.lit("\n---\n\n# "), title, F.lit("\n"))
    text = (F.when(pid % 11 == 0, F.concat(F.lit("# "), title, F.lit("\nno frontmatter\n")))
            .when(pid % 13 == 0, F.concat(F.lit("---\ntitle: 'x'\nconfluence_page_id: "), ps, F.lit("\n")))
            .otherwise(good))
    return pages.select(F.concat(F.lit("export/"), ps, F.lit(".md")).alias("path"), text.alias("text"))


# --------------------------------------------------------------------------
# orders/customer/lineitem -> ISSUE records; region/nation -> create metadata
# --------------------------------------------------------------------------

def issues(orders: DataFrame, customer: DataFrame, lineitem: DataFrame | None = None) -> DataFrame:
    """orders x customer -> ISSUE records; line items become issue comments
    (ordered by line number; an order has a bounded number of lines)."""
    status = (F.when(F.col("o_orderstatus") == "O", "Open").when(F.col("o_orderstatus") == "F", "Done")
              .otherwise("In Progress"))
    o = orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "left")
    ok = F.col("o_orderkey").cast("string")
    if lineitem is not None:
        lc = lineitem.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(
            # total order within an order (line numbers repeat in the data)
            F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity").alias("n"),
            F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("id"),
            F.struct(F.concat(F.lit("Supplier "), F.col("l_suppkey").cast("string")).alias("displayName")).alias("author"),
            F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("created"),
            F.date_format("l_shipdate", "yyyy-MM-dd").alias("updated"),
            F.concat(F.lit("Ship  "), F.floor("l_quantity").cast("string"), F.lit(" units\n of part  "),
                     F.col("l_partkey").cast("string"), F.lit("   flag "), F.col("l_returnflag")).alias("body")))).alias("cs"))
        o = o.join(lc, o["o_orderkey"] == lc["l_orderkey"], "left")
        comments = F.transform(F.coalesce(F.col("cs"), F.array()), lambda c: c.dropFields("n"))
        comment = F.struct(
            # the server's total may exceed the returned list, or be absent
            F.when(F.col("o_orderkey") % 3 == 0, F.lit(None))
            .when(F.col("o_orderkey") % 3 == 1, F.size(F.coalesce("cs", F.array())) + 100)
            .otherwise(F.size(F.coalesce("cs", F.array()))).cast("long").alias("total"),
            comments.alias("comments"))
    else:
        comment = F.lit(None).cast("struct<total:bigint,comments:array<struct<id:string,author:struct<"
                                   "displayName:string>,created:string,updated:string,body:string>>>")
    return o.select(
        ok.alias("id"), F.concat(F.lit("ORD-"), ok).alias("key"),
        F.struct(
            F.concat(F.lit("Order "), ok, F.lit(" for "), F.col("c_name")).alias("summary"),
            F.struct(status.alias("name")).alias("status"),
            F.struct(F.col("o_orderpriority").alias("name")).alias("issuetype"),
            F.struct(F.col("c_mktsegment").alias("key")).alias("project"),
            F.struct(F.col("c_name").alias("displayName")).alias("assignee"),
            F.struct(F.concat(F.lit("Nation "), F.col("c_nationkey").cast("string")).alias("displayName")).alias("reporter"),
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("updated"),
            comment.alias("comment"),
        ).alias("fields"))


def createmeta(region: DataFrame, nation: DataFrame) -> DataFrame:
    """region/nation -> one CREATEMETA document per region: project = region,
    issue types = its nations (a small dimension; bounded arrays)."""
    types = nation.groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct(
        F.col("n_nationkey").alias("k"), F.col("n_nationkey").cast("string").alias("id"),
        F.col("n_name").alias("name"), (F.col("n_nationkey") % 2 == 0).alias("subtask")))).alias("ts"))
    r = region.join(types, region["r_regionkey"] == types["n_regionkey"], "left")
    proj = F.struct(F.col("r_name").alias("key"), F.lower("r_name").alias("name"),
                    F.transform(F.coalesce("ts", F.array()), lambda t: t.dropFields("k")).alias("issuetypes"))
    return r.select(F.array(proj).alias("projects"))
