"""Registered markup queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import markup as mk
from ..operators import navigation as nav
from ..operators import summaries as sm
from ..operators.markup_fold import is_well_formed
from ..session import ensure_checkpoint_dir
from ..sources import driver_tables as dt
from . import sqlgen as q
from .catalog import EXPORTED_AT, register
from .partitioning import spread

# The token grammar for DuckDB's engine, which has no possessive repeats.
_TOK = (r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<[!?][^>]*>"
        r"""|</?[A-Za-z](?:[^>"']|"[^"]*"|'[^']*')*>|</?[A-Za-z][^>]*>|[^<]+|<""").replace("'", "''")
_VOID = ", ".join(f"'{t}'" for t in mk.VOID_TAGS)


def part_markup(part: DataFrame) -> DataFrame:
    """part -> generated storage markup (heading, paragraph with emphasis and
    a link, status macro, attachment image); every 5th part carries an
    undeclared entity and every 7th an unclosed list, so both export paths run."""
    k = F.col("p_partkey").cast("string")
    colour = (F.when(F.col("p_size") % 4 == 0, "Gray").when(F.col("p_size") % 4 == 1, "green")
              .when(F.col("p_size") % 4 == 2, "").otherwise("Teal"))
    body = F.concat(
        F.lit("<h2>"), F.col("p_name"), F.lit("</h2><p>Brand <strong>"), F.col("p_brand"),
        F.lit("</strong> size "), F.col("p_size").cast("string"),
        F.lit(' see <a href="https://parts.example.com/'), k, F.lit('">part '), k, F.lit("</a> .</p>"),
        F.when(F.col("p_partkey") % 5 == 0, F.lit("<p>Bad &nbsp; entity</p>")).otherwise(F.lit("")),
        F.lit('<ac:structured-macro ac:name="status"><ac:parameter ac:name="title">'), F.col("p_type"),
        F.lit('</ac:parameter><ac:parameter ac:name="colour">'), colour,
        F.lit('</ac:parameter></ac:structured-macro><ac:image><ri:attachment ri:filename="'),
        F.col("p_name"), F.lit(" v"), F.col("p_size").cast("string"), F.lit('.png" /></ac:image>'),
        F.when(F.col("p_partkey") % 7 == 0, F.lit("<ul><li>unclosed</ul>")).otherwise(F.lit("")))
    return part.select(F.col("p_partkey").alias("page_id"), body.alias("body"))


_PART_BODY_SQL = """pm AS (
  SELECT p_partkey AS page_id, p_partkey, p_name, p_brand, p_size, p_type,
    CASE p_size % 4 WHEN 0 THEN 'Gray' WHEN 1 THEN 'green' WHEN 2 THEN '' ELSE 'Teal' END AS colour,
    p_name || ' v' || CAST(p_size AS VARCHAR) || '.png' AS filename,
    '<h2>' || p_name || '</h2><p>Brand <strong>' || p_brand || '</strong> size ' || CAST(p_size AS VARCHAR)
      || ' see <a href="https://parts.example.com/' || CAST(p_partkey AS VARCHAR) || '">part '
      || CAST(p_partkey AS VARCHAR) || '</a> .</p>'
      || CASE WHEN p_partkey % 5 = 0 THEN '<p>Bad &nbsp; entity</p>' ELSE '' END
      || '<ac:structured-macro ac:name="status"><ac:parameter ac:name="title">' || p_type
      || '</ac:parameter><ac:parameter ac:name="colour">'
      || CASE p_size % 4 WHEN 0 THEN 'Gray' WHEN 1 THEN 'green' WHEN 2 THEN '' ELSE 'Teal' END
      || '</ac:parameter></ac:structured-macro><ac:image><ri:attachment ri:filename="' || p_name || ' v'
      || CAST(p_size AS VARCHAR) || '.png" /></ac:image>'
      || CASE WHEN p_partkey % 7 = 0 THEN '<ul><li>unclosed</ul>' ELSE '' END AS body
  FROM part)"""


def _tokens_sql(src: str) -> str:
    """Token table CTEs ``tk`` over a CTE/table ``src(page_id, body)``."""
    return f"""tr0 AS (SELECT page_id, regexp_extract_all(body, '{_TOK}', 0) AS toks FROM {src}),
tr1 AS (SELECT page_id, unnest(generate_series(0, len(toks) - 1)) AS pos, unnest(toks) AS tok FROM tr0),
tr2 AS (SELECT page_id, pos, tok, lower(regexp_extract(tok, '^</?([A-Za-z][A-Za-z0-9:._-]*)', 1)) AS name FROM tr1),
tr3 AS (SELECT *, CASE
    WHEN starts_with(tok, '<!--') THEN 'comment'
    WHEN starts_with(tok, '<![CDATA[') THEN 'cdata'
    WHEN regexp_matches(tok, '(?i)^<(script|style)\\b') THEN 'raw'
    WHEN starts_with(tok, '<!') OR starts_with(tok, '<?') THEN 'decl'
    WHEN starts_with(tok, '</') THEN 'close'
    WHEN starts_with(tok, '<') AND length(tok) > 1 AND ends_with(tok, '/>') THEN 'selfclose'
    WHEN starts_with(tok, '<') AND length(tok) > 1 AND name IN ({_VOID}) THEN 'void'
    WHEN starts_with(tok, '<') AND length(tok) > 1 THEN 'open'
    ELSE 'text' END AS kind FROM tr2),
tr4 AS (SELECT *, CASE kind WHEN 'open' THEN 1 WHEN 'close' THEN -1 ELSE 0 END AS delta FROM tr3),
tk AS (SELECT *, CASE WHEN kind = 'close' THEN run ELSE run - delta END AS depth FROM (
  SELECT *, sum(delta) OVER (PARTITION BY page_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    AS run FROM tr4))"""


def _pages_body(spark: SparkSession, sf: str) -> DataFrame:
    return spread(dt.table(spark, sf, "pages")).select("page_id", F.col("html").alias("body"))


@register("page_tokens", f"""WITH src AS (SELECT page_id, html AS body FROM pages), {_tokens_sql("src")}
SELECT page_id, CAST(pos AS INTEGER) AS pos, kind, name, CAST(depth AS BIGINT) AS depth FROM tk""")
def q_page_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Token table of every page with element depth."""
    t = mk.markup_tokens(_pages_body(spark, sf))
    return t.select("page_id", "pos", "kind", "name", "depth")


# Fragments around a name and whether an XML parser takes them.
WELL_FORMED = [
    ("<p>{}</p>", True), ("<p>{}", False), ("<![CDATA[{} && <b>]]>", True), ("{} && b", False), ("<p title={}>x</p>", False),
    ("<p title='a > {}'>x</p>", True), ("<p><b>{}</p></b>", False), ("<foo:x>{}</foo:x>", False), ("<ac:x>{}</ac:x>", True),
    ('<p a="{}" a="2"/>', False), ("{}&nbsp;", False), ("{}&#65;&#x42;", True), ("{}&#0;", False), ("<!-- {} -- -->", False),
    ("<!-- {} - --><br/>", True), ("{}<br>", False), ("{} ]]> b", False), ("{} > b", True), ("{} < b", False),
    ("<ul><li>{}</li><li/></ul>", True), ("</p>{}", False), ("<P>{}</p>", False), ("<?note {}?>", True),
    ("<p xmlns:q='u'><q:x>{}</q:x></p>", True), ("<!DOCTYPE html>{}", False), ("", True),
]


@register("markup_wellformed", f"""SELECT page_id, lower(html) NOT LIKE '%<!doctype%' AS well_formed FROM pages
UNION ALL
SELECT -1 - p_partkey, CASE p_partkey % {len(WELL_FORMED)} {" ".join(
    f"WHEN {i} THEN {str(ok).lower()}" for i, (_, ok) in enumerate(WELL_FORMED))} END FROM part""")
def q_markup_wellformed(spark: SparkSession, sf: str) -> DataFrame:
    """Well-formedness of real pages (none is: all have a doctype) and of fragments around part names."""
    part = dt.table(spark, sf, "part")
    case = F.element_at(F.array(*[F.lit(t) for t, _ in WELL_FORMED]), (F.col("p_partkey") % len(WELL_FORMED) + 1).cast("int"))
    parts = part.select((-1 - F.col("p_partkey")).alias("page_id"), F.replace(case, F.lit("{}"), F.col("p_name")).alias("body"))
    return mk.well_formed(_pages_body(spark, sf).unionByName(parts))


@register("page_headings", f"""WITH h AS (
  SELECT page_id, regexp_extract_all(html, '{mk.HEADING_RE}', 1) AS lv,
         regexp_extract_all(html, '{mk.HEADING_RE}', 2) AS inn FROM pages),
u AS (SELECT page_id, unnest(generate_series(0, len(lv) - 1)) AS heading_no, unnest(lv) AS level,
             unnest(inn) AS inn FROM h),
v AS (SELECT page_id, CAST(heading_no AS INTEGER) AS heading_no, CAST(level AS INTEGER) AS level,
             {q.plain_inner("inn")} AS text FROM u)
SELECT * FROM v WHERE text <> ''""")
def q_page_headings(spark: SparkSession, sf: str) -> DataFrame:
    """D3: heading level and plain text per page."""
    return mk.headings(_pages_body(spark, sf))


_HREF_SQL = r"""(?is)\bhref\s*=\s*["']([^"']*)["']""".replace("'", "''")


@register("page_links", f"""WITH h AS (
  SELECT page_id, regexp_extract_all(html, '{mk.LINK_RE}', 1) AS att,
         regexp_extract_all(html, '{mk.LINK_RE}', 2) AS inn FROM pages),
u AS (SELECT page_id, unnest(generate_series(0, len(att) - 1)) AS link_no, unnest(att) AS att, unnest(inn) AS inn
      FROM h),
v AS (SELECT page_id, link_no, {q.plain_inner("inn")} AS t, regexp_extract(att, '{_HREF_SQL}', 1) AS href FROM u)
SELECT page_id, CAST(link_no AS INTEGER) AS link_no, CASE WHEN t <> '' THEN t ELSE href END AS text, href
FROM v""")
def q_page_links(spark: SparkSession, sf: str) -> DataFrame:
    """(text, href) of every link; text defaults to the href."""
    return mk.links(_pages_body(spark, sf))


@register("part_status", f"""WITH {_PART_BODY_SQL}
SELECT page_id, CAST(0 AS INTEGER) AS macro_no, p_type AS title,
  ':status[' || p_type || ']{{color=' || CASE lower(colour) WHEN '' THEN 'grey' WHEN 'gray' THEN 'grey'
                                               ELSE lower(colour) END || '}}' AS markdown
FROM pm""")
def q_part_status(spark: SparkSession, sf: str) -> DataFrame:
    """D13 + D14 + T12: status macros -> Markdown tokens with normalized colour."""
    return mk.status_tokens(part_markup(dt.table(spark, sf, "part"))).withColumn(
        "macro_no", F.col("macro_no").cast("int"))


@register("part_images", f"""WITH {_PART_BODY_SQL}
SELECT page_id, CAST(0 AS INTEGER) AS image_no, filename,
  '{dt.WIKI_BASE}/download/attachments/' || CAST(page_id AS VARCHAR) || '/' || replace(filename, ' ', '%20') AS url,
  '![' || filename || '](' || '{dt.WIKI_BASE}/download/attachments/' || CAST(page_id AS VARCHAR) || '/'
    || replace(filename, ' ', '%20') || ')' AS markdown
FROM pm""")
def q_part_images(spark: SparkSession, sf: str) -> DataFrame:
    """D11 + T16: attachment images -> quoted download links."""
    return mk.images(part_markup(dt.table(spark, sf, "part")), dt.WIKI_BASE).withColumn(
        "image_no", F.col("image_no").cast("int"))


def _structured_expected() -> str:
    k = "CAST(p_partkey AS VARCHAR)"
    colour = "CASE lower(colour) WHEN '' THEN 'grey' WHEN 'gray' THEN 'grey' ELSE lower(colour) END"
    return (f"'## ' || p_name || chr(10) || chr(10) || 'Brand **' || p_brand || '** size ' || CAST(p_size AS VARCHAR)"
            f" || ' see [part ' || {k} || '](https://parts.example.com/' || {k} || ').' || chr(10) || chr(10)"
            f" || ':status[' || p_type || ']{{color=' || {colour} || '}}' || chr(10) || chr(10)"
            f" || '![' || filename || '](' || '{dt.WIKI_BASE}/download/attachments/' || {k} || '/'"
            f" || replace(filename, ' ', '%20') || ')' || chr(10)")


@register("part_markdown", f"""WITH {_PART_BODY_SQL}
SELECT page_id, CASE WHEN p_partkey % 5 <> 0 AND p_partkey % 7 <> 0 THEN {_structured_expected()}
                     ELSE {q.strip_tags("body")} || chr(10) END AS body_markdown
FROM pm""")
def q_part_markdown(spark: SparkSession, sf: str) -> DataFrame:
    """D19 body: structured rendering of well-formed markup, strip-tags
    fallback otherwise (strict parity)."""
    from ..operators.storage_md import rendered
    b = part_markup(spread(dt.table(spark, sf, "part")))
    body = F.col("body")
    return b.select("page_id", F.when(is_well_formed(body), rendered(dt.WIKI_BASE)).otherwise(
        F.concat(mk.tx.strip_tags("body"), F.lit("\n"))).alias("body_markdown"))


def _export_sql() -> str:
    from .page_queries import _HUB_MD_SQL
    hub_md = _HUB_MD_SQL.split("WITH ", 1)[1]
    nl = "chr(10)"
    title = "COALESCE(NULLIF(e.title, ''), 'Untitled')"
    return f"""WITH {hub_md.rsplit("SELECT parent_id AS page_id", 1)[0].rstrip()},
hm AS (SELECT parent_id AS page_id, {q.lit(chr(10).join(nav.HUB_HEADER) + chr(10))}
         || string_agg(line, chr(10) ORDER BY ordinal) || chr(10) AS hub_md FROM r GROUP BY parent_id),
e AS (SELECT pg.*, cc.child_count, hm.hub_md FROM pg LEFT JOIN cc ON pg.id = cc.parent_id
      LEFT JOIN hm ON pg.id = hm.page_id)
SELECT id AS page_id, {title} AS title,
  '---' || {nl} || 'title: "' || replace({title}, '"', chr(39)) || '"' || {nl}
  || 'confluence_page_id: ' || id || {nl} || 'confluence_version: ' || CAST(version AS VARCHAR) || {nl}
  || CASE WHEN parent_id IS NOT NULL THEN 'confluence_parent_page_id: ' || parent_id || {nl} ELSE '' END
  || 'confluence_page_kind: ' || CASE WHEN hub_md IS NOT NULL THEN 'hub' ELSE 'content' END || {nl}
  || CASE WHEN COALESCE(child_count, 0) <> 0 THEN 'confluence_child_count: ' || CAST(child_count AS VARCHAR) || {nl}
          ELSE '' END
  || 'source_url: ' || COALESCE(webui_url, '') || {nl} || 'exported_at: {EXPORTED_AT}' || {nl} || '---' || {nl}
  || {nl} || '# ' || {title} || {nl} || {nl} || 'Source: ' || COALESCE(webui_url, '') || {nl} || {nl}
  || {q.strip("CASE WHEN hub_md IS NOT NULL THEN hub_md WHEN page_id % 7 = 0 THEN '' ELSE " + q.strip_tags("body") + " END")}
  || {nl} AS markdown
FROM e"""


@register("export_markdown", _export_sql())
def q_export_markdown(spark: SparkSession, sf: str) -> DataFrame:
    """D18 + D19 (+ N2): every page exported in strict parity mode; hub pages
    get the child table, malformed bodies the strip-tags fallback."""
    return exported_pages(spark, sf)


def exported_pages(spark: SparkSession, sf: str, only: DataFrame | None = None) -> DataFrame:
    """D19 of the live pages, or of those with a ``page_id`` in ``only``: picked before anything is rendered."""
    wiki = dt.wiki_pages(spread(dt.table(spark, sf, "pages")))
    edges = dt.child_edges(wiki)
    kinds = nav.classify_pages(wiki, edges)
    hubs_ids = kinds.filter(F.col("page_kind") == "hub").select(F.col("page_id").alias("parent_id"))
    hub_md = nav.render_hub(nav.children_of(wiki, edges).join(hubs_ids, "parent_id", "left_semi"))
    payload = page_payload(wiki).join(kinds.select("page_id", "page_kind", "child_count"), "page_id")
    if only is not None:
        # the few pages to render as a table of their own: rendering isn't planned again with every join before it
        ensure_checkpoint_dir(spark)
        payload = payload.join(only.select("page_id").distinct(), "page_id", "left_semi").checkpoint(eager=True)
    return mk.export_markdown(payload, dt.WIKI_BASE, EXPORTED_AT, hubs=hub_md)


def page_payload(wiki: DataFrame) -> DataFrame:
    """What the export needs of a page."""
    return sm.export_payload(wiki).select(F.col("id").alias("page_id"), "title", F.col("body_html").alias("body"), "version",
                                          "webui_url", "parent_page_id")


# --------------------------------------------------------------------------
# D2 blocks, D7 cells, D9/D10 key/content tables
# --------------------------------------------------------------------------

@register("markup_blocks", f"""WITH {_PART_BODY_SQL},
src AS (SELECT -1 - page_id AS page_id, body FROM pm), {_tokens_sql("src")}
SELECT page_id, CAST(pos AS INTEGER) AS pos, CASE WHEN kind = 'text' THEN 'text' ELSE 'element' END AS kind,
  CASE WHEN kind = 'text' THEN NULL ELSE name END AS name
FROM tk WHERE depth = 0 AND (kind IN ('open', 'selfclose', 'void')
  OR (kind = 'text' AND regexp_replace(tok, '^\\s+|\\s+$', '', 'g') <> ''))""")
def q_markup_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """D1 + D2: top-level block sequence of the generated storage markup."""
    parts = part_markup(dt.table(spark, sf, "part")).select((-1 - F.col("page_id")).alias("page_id"), "body")
    return mk.markup_blocks(mk.markup_tokens(parts))


def region_tables(region: DataFrame, nation: DataFrame) -> DataFrame:
    """region x nation -> one storage page per region holding a key/content
    table (Item / Description / Notes) and a plain table (Name / Key)."""
    rows = nation.groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct(
        "n_nationkey", "n_name"))).alias("ns"))
    j = region.join(rows, region["r_regionkey"] == rows["n_regionkey"], "left")
    kc = F.array_join(F.transform(F.coalesce("ns", F.array()), lambda n: F.concat(
        F.lit("<tr><td>"), n.getField("n_name"), F.lit("</td><td><p>Key "), n.getField("n_nationkey").cast("string"),
        F.lit("</p></td><td>Region "), F.col("r_name"), F.lit("</td></tr>"))), "")
    plain = F.array_join(F.transform(F.coalesce("ns", F.array()), lambda n: F.concat(
        F.lit("<tr><td>"), n.getField("n_name"), F.lit("</td><td><strong>"),
        n.getField("n_nationkey").cast("string"), F.lit("</strong></td></tr>"))), "")
    body = F.concat(F.lit("<table><tbody><tr><th>Item</th><th>Description</th><th>Notes</th></tr>"), kc,
                    F.lit("</tbody></table><table><tbody><tr><th>Name</th><th>Key</th></tr>"), plain,
                    F.lit("</tbody></table>"))
    return j.select(F.col("r_regionkey").cast("string").alias("page_id"), body.alias("body"))


@register("table_cells", """SELECT CAST(r_regionkey AS VARCHAR) AS page_id, -1 AS slot, t.table_no,
  CAST(t.row_no AS INTEGER) AS row_no, CAST(t.col_no AS INTEGER) AS col_no, t.flat
FROM region, (VALUES (0, 0, 0, 'Item'), (0, 0, 1, 'Description'), (0, 0, 2, 'Notes'),
                     (1, 0, 0, 'Name'), (1, 0, 1, 'Key')) AS t(table_no, row_no, col_no, flat)
UNION ALL
SELECT CAST(n_regionkey AS VARCHAR), -1, 0, CAST(rn AS INTEGER), CAST(c.col_no AS INTEGER),
  CASE c.col_no WHEN 0 THEN n_name WHEN 1 THEN 'Key ' || CAST(n_nationkey AS VARCHAR)
       ELSE 'Region ' || r_name END
FROM (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS rn FROM nation)
  JOIN region ON n_regionkey = r_regionkey, (VALUES (0), (1), (2)) AS c(col_no)
UNION ALL
SELECT CAST(n_regionkey AS VARCHAR), -1, 1, CAST(rn AS INTEGER), CAST(c.col_no AS INTEGER),
  CASE c.col_no WHEN 0 THEN n_name ELSE '**' || CAST(n_nationkey AS VARCHAR) || '**' END
FROM (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS rn FROM nation),
  (VALUES (0), (1)) AS c(col_no)""")
def q_table_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Table cells with their flattened (one-line) text."""
    from ..operators import storage_md as smd
    pages = region_tables(dt.table(spark, sf, "region"), dt.table(spark, sf, "nation"))
    return smd.table_cells(pages).select("page_id", F.lit(-1).alias("slot"), "table_no", "row_no", "col_no", "flat")


@register("region_table_markdown", """WITH n AS (
  SELECT n_regionkey, n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT CAST(r_regionkey AS VARCHAR) AS page_id,
  COALESCE((SELECT string_agg('#### ' || n_name || chr(10) || chr(10) || 'Key ' || CAST(n_nationkey AS VARCHAR)
                  || chr(10) || chr(10) || '**Notes:** Region ' || r_name, chr(10) || chr(10) ORDER BY n_nationkey)
            FROM n WHERE n.n_regionkey = region.r_regionkey), '')
  || chr(10) || chr(10) || '| Name | Key |' || chr(10) || '| --- | --- |'
  || COALESCE((SELECT string_agg(chr(10) || '| ' || n_name || ' | **' || CAST(n_nationkey AS VARCHAR) || '** |', ''
                  ORDER BY n_nationkey) FROM n WHERE n.n_regionkey = region.r_regionkey), '')
  || chr(10) AS markdown
FROM region""")
def q_region_table_markdown(spark: SparkSession, sf: str) -> DataFrame:
    """A key/content table rendered as sections, a plain table as Markdown."""
    from ..operators.storage_md import render_markdown
    pages = region_tables(dt.table(spark, sf, "region"), dt.table(spark, sf, "nation"))
    return render_markdown(pages, dt.WIKI_BASE)


# --------------------------------------------------------------------------
# containers in containers, 1 to 8 deep by key
# --------------------------------------------------------------------------

_DEPTH = "(p_partkey % 8 + 1)"


def _nested(part: DataFrame, level) -> DataFrame:
    """part -> markup of ``p_partkey % 8 + 1`` levels; ``level(k, key, inner)`` wraps the markup of level k + 1."""
    key = F.col("p_partkey").cast("string")
    levels = F.sequence((F.col("p_partkey") % 8 + 1).cast("int"), F.lit(1), F.lit(-1))
    body = F.aggregate(levels, F.lit(""), lambda inner, k: level(k, key, inner))
    return part.select(F.col("p_partkey").alias("page_id"), body.alias("body"))


def _nested_markdown(spark: SparkSession, sf: str, level) -> DataFrame:
    from ..operators.storage_md import render_markdown
    return render_markdown(_nested(spread(dt.table(spark, sf, "part")), level), dt.WIKI_BASE)


@register("nested_lists", f"""WITH l AS (
  SELECT p_partkey, unnest(generate_series(1, {_DEPTH})) AS k, {_DEPTH} AS d FROM part),
i AS (SELECT *, repeat(' ', CAST(CASE WHEN k % 2 = 1 AND (k - 1) * (k + 2) >= 10 OR k % 2 = 0 AND (k - 1) * (k + 2) >= 12 THEN 8
                           ELSE (k - 1) * (k + 2) END AS INTEGER)) AS pad FROM l),
n AS (SELECT p_partkey, k AS pos, pad || CASE WHEN k % 2 = 1 THEN '- ' ELSE '1. ' END || 'A' || CAST(k AS VARCHAR) || ' '
        || CAST(p_partkey AS VARCHAR) AS line FROM i
      UNION ALL
      SELECT p_partkey, 2 * d + 1 - k, pad || CASE WHEN k % 2 = 1 THEN '- ' ELSE '2. ' END || 'B' || CAST(k AS VARCHAR) FROM i)
SELECT p_partkey AS page_id, string_agg(line, chr(10) ORDER BY pos) || chr(10) AS markdown FROM n GROUP BY p_partkey""")
def q_nested_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Lists in items, ul and ol in turn, 1 to 8 deep."""
    def level(k: Column, key: Column, inner: Column) -> Column:
        tag, n = F.when(k % 2 == 1, "ul").otherwise("ol"), k.cast("string")
        return F.concat(F.lit("<"), tag, F.lit("><li>A"), n, F.lit(" "), key, inner, F.lit("</li><li>B"), n, F.lit("</li></"), tag,
                        F.lit(">"))
    return _nested_markdown(spark, sf, level)


@register("nested_macros", f"""WITH l AS (
  SELECT p_partkey, unnest(generate_series(1, {_DEPTH})) AS k, {_DEPTH} AS d FROM part),
n AS (SELECT p_partkey, k, repeat('> ', CAST(k AS INTEGER)) || '[!'
    || CASE k % 5 WHEN 0 THEN 'EXPAND' WHEN 1 THEN 'INFO' WHEN 2 THEN 'NOTE' WHEN 3 THEN 'TIP' ELSE 'WARNING' END || ']'
    || CASE WHEN k % 3 = 0 THEN '' ELSE ' T' || CAST(k AS VARCHAR) END || chr(10)
    || repeat('> ', CAST(k AS INTEGER)) || 't' || CAST(k AS VARCHAR) || ' ' || CAST(p_partkey AS VARCHAR)
    || CASE WHEN k < d THEN chr(10) || repeat('> ', CAST(k - 1 AS INTEGER)) || '>' ELSE '' END AS part_md FROM l)
SELECT p_partkey AS page_id, string_agg(part_md, chr(10) ORDER BY k) || chr(10) AS markdown FROM n GROUP BY p_partkey""")
def q_nested_macros(spark: SparkSession, sf: str) -> DataFrame:
    """Callouts in callouts, some inside a macro without a form of its own, 1 to 8 deep."""
    def level(k: Column, key: Column, inner: Column) -> Column:
        n = k.cast("string")
        name = F.element_at(F.array(*[F.lit(x) for x in ("expand", "info", "note", "tip", "warning")]), k % 5 + 1)
        title = F.when(k % 3 == 0, "").otherwise(F.concat(F.lit('<ac:parameter ac:name="title">T'), n, F.lit("</ac:parameter>")))
        panel = F.when(k % 4 == 0, F.concat(F.lit("<ac:structured-macro ac:name='panel'><ac:rich-text-body>"), inner,
                                            F.lit("</ac:rich-text-body></ac:structured-macro>"))).otherwise(inner)
        return F.concat(F.lit('<ac:structured-macro ac:name="'), name, F.lit('">'), title, F.lit("<ac:rich-text-body><p>t"), n,
                        F.lit(" "), key, F.lit("</p>"), panel, F.lit("</ac:rich-text-body></ac:structured-macro>"))
    return _nested_markdown(spark, sf, level)


_HEAD = "'| H' || CAST({k} AS VARCHAR) || ' | ' || CAST(p_partkey AS VARCHAR) || ' |' || chr(10) || '| --- | --- |' || chr(10)"


@register("nested_tables", f"""WITH RECURSIVE t(p_partkey, k, cell) AS (
  SELECT p_partkey, {_DEPTH}, 'c' || CAST({_DEPTH} AS VARCHAR) FROM part
  UNION ALL
  SELECT p_partkey, k - 1, 'c' || CAST(k - 1 AS VARCHAR) || ' '
    || replace(replace({_HEAD.format(k="k")} || '| ' || cell || ' | v |', chr(10), '<br>'), '|', '\\|') FROM t WHERE k > 1)
SELECT p_partkey AS page_id, {_HEAD.format(k="k")} || '| ' || cell || ' | v |' || chr(10) AS markdown FROM t WHERE k = 1""")
def q_nested_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Tables in cells, 1 to 8 deep."""
    def level(k: Column, key: Column, inner: Column) -> Column:
        n = k.cast("string")
        return F.concat(F.lit("<table><tbody><tr><th>H"), n, F.lit("</th><th>"), key, F.lit("</th></tr><tr><td>c"), n, inner,
                        F.lit("</td><td>v</td></tr></tbody></table>"))
    return _nested_markdown(spark, sf, level)


@register("macro_rows", f"""WITH l AS (
  SELECT p_partkey, unnest(generate_series(1, {_DEPTH})) AS k, {_DEPTH} AS d FROM part)
SELECT p_partkey AS page_id, CAST(k - 1 AS INTEGER) AS macro_no, 'm' || CAST(k AS VARCHAR) AS name,
  'John''s ' || CAST(k AS VARCHAR) || ' & co' AS title, CASE WHEN k = d THEN 'x && ' || CAST(p_partkey AS VARCHAR) ELSE '' END AS plain_body
FROM l""")
def q_macro_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Macros in macros as rows; of two parameters of one name the first counts, the outer ones keep their own."""
    def level(k: Column, key: Column, inner: Column) -> Column:
        n = k.cast("string")
        code = F.concat(F.lit("<ac:plain-text-body><![CDATA[x && "), key, F.lit("]]></ac:plain-text-body>"))
        return F.concat(F.lit('<ac:structured-macro ac:name="m'), n, F.lit('"><ac:parameter ac:name="title">John\'s '), n,
                        F.lit(' &amp; co</ac:parameter><ac:parameter ac:name="title">other</ac:parameter>'),
                        F.when(inner == "", code).otherwise(F.concat(F.lit("<ac:rich-text-body>"), inner, F.lit("</ac:rich-text-body>"))),
                        F.lit("</ac:structured-macro>"))
    rows = mk.macros(_nested(spread(dt.table(spark, sf, "part")), level))
    return rows.select("page_id", "macro_no", "name", F.try_element_at("params", F.lit("title")).alias("title"), "plain_body")
