"""Registered Markdown-import queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import markdown as md
from ..sources import driver_tables as dt
from . import sqlgen as q
from .catalog import register
from .partitioning import spread

MERMAID_MACRO = "mermaid-cloud"
NL = "\n"


def part_markdown_docs(part: DataFrame) -> DataFrame:
    """part -> Markdown documents with frontmatter, heading, inline markup,
    links, nested list, table, code fence, callout; every third part adds an
    ordered list, the next a mermaid fence."""
    k = F.col("p_partkey").cast("string")
    size = F.col("p_size").cast("string")
    text = F.concat(
        F.lit("---\ntitle: Part "), k, F.lit("\n---\n# "), F.col("p_name"), F.lit("\n\nBrand **"), F.col("p_brand"),
        F.lit("** size "), size, F.lit(" with `code-"), k, F.lit("` and :status["), F.col("p_type"),
        F.lit("]{color=gray}.\nSee [spec](https://parts.example.com/"), k, F.lit(") and [[Part "), k,
        F.lit("|alias "), k, F.lit("]] or [[manual-"), k, F.lit(".pdf]].\n\n- first "), k,
        F.lit("\n  - nested "), size, F.lit("\n- second\n  continued\n\n| Name | Size |\n| --- | --- |\n| "),
        F.col("p_name"), F.lit(" | "), size, F.lit(" |\n\n```python\nprint("), k,
        F.lit(")\n```\n\n> [!NOTE] Note "), k, F.lit("\n> Body "), k, F.lit("\n"),
        F.when(F.col("p_partkey") % 3 == 0, F.lit("\n1. one\n2. two\n"))
        .when(F.col("p_partkey") % 3 == 1, F.lit("\n```mermaid\ngraph TD\nA-->B\n```\n")).otherwise(F.lit("")))
    return part.select(F.col("p_partkey").alias("doc_id"), text.alias("text"))


_K = "CAST(p_partkey AS VARCHAR)"
_S = "CAST(p_size AS VARCHAR)"
_STATUS = ("'<ac:structured-macro ac:name=\"status\" ac:schema-version=\"1\"><ac:parameter ac:name=\"colour\">"
           "Grey</ac:parameter><ac:parameter ac:name=\"title\">' || p_type || '</ac:parameter></ac:structured-macro>'")
_LINK_BODY = "'<ac:plain-text-link-body><![CDATA['"
_LINK_END = "']]></ac:plain-text-link-body></ac:link>'"
_IMPORT_SQL = f"""SELECT p_partkey AS doc_id,
  '<h1>' || p_name || '</h1>'
  || '<p>Brand <strong>' || p_brand || '</strong> size ' || {_S} || ' with <code>code-' || {_K} || '</code> and '
  || {_STATUS} || '. See <a href="https://parts.example.com/' || {_K} || '">spec</a> and '
  || '<ac:link><ri:page ri:content-title="Part ' || {_K} || '" />' || {_LINK_BODY} || 'alias ' || {_K} || {_LINK_END}
  || ' or <ac:link><ri:attachment ri:filename="manual-' || {_K} || '.pdf" />' || {_LINK_BODY} || 'manual-' || {_K}
  || '.pdf' || {_LINK_END} || '.</p>'
  || '<ul><li>first ' || {_K} || '<ul><li>nested ' || {_S} || '</li></ul></li><li>second continued</li></ul>'
  || '<table><tbody><tr><th>Name</th><th>Size</th></tr><tr><td>' || p_name || '</td><td>' || {_S}
  || '</td></tr></tbody></table>'
  || '<ac:structured-macro ac:name="code" ac:schema-version="1"><ac:parameter ac:name="language">python'
  || '</ac:parameter><ac:parameter ac:name="theme">Default</ac:parameter><ac:plain-text-body><![CDATA[print('
  || {_K} || ')]]></ac:plain-text-body></ac:structured-macro>'
  || '<ac:structured-macro ac:name="note" ac:schema-version="1"><ac:parameter ac:name="title">Note ' || {_K}
  || '</ac:parameter><ac:rich-text-body><p>Body ' || {_K} || '</p></ac:rich-text-body></ac:structured-macro>'
  || CASE WHEN p_partkey % 3 = 0 THEN '<ol><li>one</li><li>two</li></ol>'
          WHEN p_partkey % 3 = 1 THEN '<ac:structured-macro ac:name="{MERMAID_MACRO}" ac:schema-version="1">'
            || '<ac:plain-text-body><![CDATA[graph TD' || chr(10) || 'A-->B]]></ac:plain-text-body></ac:structured-macro>'
          ELSE '' END AS html
FROM part"""


@register("import_markdown", _IMPORT_SQL)
def q_import_markdown(spark: SparkSession, sf: str) -> DataFrame:
    """Markdown documents to storage markup."""
    docs = part_markdown_docs(spread(dt.table(spark, sf, "part")))
    return md.import_markdown(docs, MERMAID_MACRO)


@register("link_targets", f"""SELECT p_partkey AS doc_id, t.token_no, 'link' AS token, t.kind, t.target, t.text
FROM part, (VALUES (2, 'url'), (3, 'page'), (4, 'attachment')) AS t(token_no, kind)""".replace(
    "t.target, t.text", "CASE t.kind WHEN 'url' THEN 'https://parts.example.com/' || " + _K +
    " WHEN 'page' THEN 'Part ' || " + _K + " ELSE 'manual-' || " + _K + " || '.pdf' END AS target, "
    "CASE t.kind WHEN 'url' THEN 'spec' WHEN 'page' THEN 'alias ' || " + _K + " ELSE 'manual-' || " + _K +
    " || '.pdf' END AS text"))
def q_link_targets(spark: SparkSession, sf: str) -> DataFrame:
    """Link / image / wiki-link targets as (url | page | attachment) edges."""
    docs = part_markdown_docs(spread(dt.table(spark, sf, "part")))
    return md.link_targets(docs).withColumn("token_no", F.col("token_no").cast("int"))


@register("markdown_blocks", f"""SELECT p_partkey AS doc_id, b.block_no, b.kind
FROM part, (VALUES (1, 'heading'), (2, 'text'), (3, 'item'), (4, 'table_start'), (5, 'fence'), (6, 'quote'))
  AS b(block_no, kind)
UNION ALL
SELECT p_partkey, 7, CASE WHEN p_partkey % 3 = 0 THEN 'item' ELSE 'fence' END FROM part WHERE p_partkey % 3 <> 2""")
def q_markdown_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """M1-M3: block numbering and the kind of each block's first line."""
    docs = part_markdown_docs(spread(dt.table(spark, sf, "part")))
    return md.markdown_blocks(docs).select("doc_id", "block_no", "kind")


def part_create_changes(part: DataFrame) -> DataFrame:
    """Dry-run create-page requests whose bodies are the part Markdown documents."""
    from ..sources.schemas import CHANGE_DDL, struct_type
    docs = part_markdown_docs(part)
    cols = {"request_id": F.concat(F.lit("md-"), F.col("doc_id").cast("string")), "seq": F.col("doc_id"),
            "action": F.lit("create-page"), "allow_write": F.lit(False), "dry_run": F.lit(True),
            "space_key": F.lit("DOCS"), "title": F.concat(F.lit("Part "), F.col("doc_id").cast("string")),
            "body_markdown": F.col("text")}
    return docs.select(*[(cols[f.name] if f.name in cols else F.lit(None)).cast(f.dataType).alias(f.name)
                         for f in struct_type(CHANGE_DDL).fields])


@register("markdown_create_previews", f"""WITH imp AS ({_IMPORT_SQL})
SELECT 'md-' || CAST(doc_id AS VARCHAR) AS request_id, 'DOCS' AS space_key, CAST(NULL AS VARCHAR) AS parent_id,
  'Part ' || CAST(doc_id AS VARCHAR) AS title, 'markdown' AS body_source,
  CAST(length(html) AS INTEGER) AS body_length, {q.preview_html("html")} AS body_preview
FROM imp""")
def q_markdown_create_previews(spark: SparkSession, sf: str) -> DataFrame:
    """V7 + M12 + B1: create previews whose Markdown bodies are converted first."""
    from ..operators import changes as ch
    changes = part_create_changes(spread(dt.table(spark, sf, "part")))
    allow = spark.createDataFrame([], "kind string, value string")
    v = ch.resolve_bodies(ch.validate_changes(changes, allow), MERMAID_MACRO)
    return ch.preview_create(v)


# --------------------------------------------------------------------------
# containers of any depth
# --------------------------------------------------------------------------

def order_quotes(orders: DataFrame) -> DataFrame:
    """Quotes one to eight deep with a callout and a fence in the innermost, then lists that change type and end."""
    k = F.col("o_orderkey").cast("string")
    depth = (F.col("o_orderkey") % 8 + 1).cast("int")
    marks = lambda n: F.repeat(F.lit("> "), n)
    quotes = F.array_join(F.transform(F.sequence(F.lit(1), depth), lambda i: F.concat(
        marks(i), F.lit("q"), i.cast("string"), F.lit(" **"), k, F.lit("**\n"))), "")
    callout = F.when(F.col("o_orderkey") % 3 == 0, F.concat(
        marks(depth + 1), F.lit("[!tip] T"), k, F.lit("\n"), marks(depth + 1), F.lit("```sql\n"), marks(depth + 1),
        F.lit("> a | b\n"), marks(depth + 1), F.lit("```\n"))).otherwise("")
    rest = F.concat(F.lit("\nafter\n\n- a\n  - b "), k, F.lit("\n  1. c\n- d\n\n- e\n\n\n- f\n1. g\n"))
    return orders.select(F.col("o_orderkey").alias("doc_id"),
                         F.concat(F.lit("---\nsee: [[Hidden]]\n---\n"), quotes, callout, rest).alias("text"))


@register("nested_quotes", """WITH o AS (SELECT o_orderkey AS doc_id, CAST(o_orderkey AS VARCHAR) AS k, o_orderkey % 8 + 1 AS depth FROM orders)
SELECT doc_id, """ + " || ".join(
    f"CASE WHEN depth >= {i} THEN '<blockquote><p>q{i} <strong>' || k || '</strong></p>' ELSE '' END" for i in range(1, 9)) + """
  || CASE WHEN doc_id % 3 = 0 THEN '<ac:structured-macro ac:name="tip" ac:schema-version="1"><ac:parameter ac:name="title">T'
    || k || '</ac:parameter><ac:rich-text-body><ac:structured-macro ac:name="code" ac:schema-version="1">'
    || '<ac:parameter ac:name="language">sql</ac:parameter><ac:parameter ac:name="theme">Default</ac:parameter>'
    || '<ac:plain-text-body><![CDATA[> a | b]]></ac:plain-text-body></ac:structured-macro></ac:rich-text-body></ac:structured-macro>'
    ELSE '' END
  || repeat('</blockquote>', CAST(depth AS INTEGER)) || '<p>after</p><ul><li>a<ul><li>b ' || k
  || '</li></ul><ol><li>c</li></ol></li><li>d</li><li>e</li></ul><ul><li>f</li></ul><ol><li>g</li></ol>' AS html FROM o""")
def q_nested_quotes(spark: SparkSession, sf: str) -> DataFrame:
    """M3, M5, M6: quotes of any depth, lists in lists of another type, lists that a second blank line ends."""
    return md.import_markdown(order_quotes(spread(dt.table(spark, sf, "orders"))))
