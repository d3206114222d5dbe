"""Storage markup -> tokens, headings, links, images, macros, Markdown.

Two paths, as in the reference:

* **strict parity** (default for ``export_markdown``): a body that an XML parser
  wouldn't accept (undeclared entities such as ``&nbsp;``, unclosed tags, a
  doctype, stray ``<``) loses all structure and is exported as ``strip_tags``
  text (T19). ``markup_fold.is_well_formed`` decides, within the row.
* **structured**: well-formed bodies are rendered by the fold of
  ``markup_fold`` over the row's tokens.

Extraction operators (headings, links, images, macros) are per-row array
expressions -> ``posexplode``; they need no shuffle at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from .markup_fold import attribute, is_well_formed, macro_array

# Token grammar pieces and HTML void elements.
TOKEN_RE = (r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
            r"""|<[!?][^>]*>|</?[A-Za-z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>|</?[A-Za-z][^>]*>|[^<]+|<""")
VOID_TAGS = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
             "param", "source", "track", "wbr"]


def markup_tokens(pages: DataFrame, id_col: str = "page_id", body_col: str = "body") -> DataFrame:
    """``(page_id, pos, kind, name, attrs, text, delta, depth)``.

    kind: comment | cdata | raw (script/style, one token) | decl | open |
    close | selfclose | void (HTML void tag written open) | text.
    ``depth`` is the element depth at the token (a close tag counts at its
    open tag's level). A ``>`` in a quoted attribute value doesn't end the tag.

    Windows here are partitioned by page: every token of a page comes from
    that page's single body value, so a window partition never exceeds one
    input row's content (unlike comments, where one page can own an
    unbounded number of rows and the two-level scans of ``plans.scans`` are
    used).
    """
    toks = pages.select(F.col(id_col).alias("page_id"),
                        F.posexplode(F.regexp_extract_all(F.col(body_col), F.lit(TOKEN_RE), 0))
                        .alias("pos", "tok"))
    t = F.col("tok")
    name = F.lower(F.regexp_extract(t, r"^</?([A-Za-z][A-Za-z0-9:._-]*)", 1))
    kind = (F.when(t.startswith("<!--"), "comment")
            .when(t.startswith("<![CDATA["), "cdata")
            .when(t.rlike(r"^(?i)<(script|style)\b"), "raw")
            .when(t.startswith("<!") | t.startswith("<?"), "decl")
            .when(t.startswith("</"), "close")
            .when(t.startswith("<") & (F.length(t) > 1) & t.endswith("/>"), "selfclose")
            .when(t.startswith("<") & (F.length(t) > 1) & name.isin(*VOID_TAGS), "void")
            .when(t.startswith("<") & (F.length(t) > 1), "open")
            .otherwise("text"))
    toks = toks.select(
        "page_id", "pos", kind.alias("kind"), name.alias("name"),
        F.regexp_extract(t, r"(?s)^<[A-Za-z][A-Za-z0-9:._-]*\s*(.*?)/?>$", 1).alias("attrs"),
        F.when(kind.isin("text", "cdata", "raw"), t).alias("text"),
        F.when(kind == "open", 1).when(kind == "close", -1).otherwise(0).alias("delta"),
        t.alias("tok"))
    w = Window.partitionBy("page_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    toks = toks.withColumn("run", F.sum("delta").over(w))
    # depth before this token = run - delta; a close tag sits at run.
    return toks.withColumn("depth", F.when(F.col("kind") == "close", F.col("run"))
                           .otherwise(F.col("run") - F.col("delta"))).drop("run")


def well_formed(pages: DataFrame, id_col: str = "page_id", body_col: str = "body") -> DataFrame:
    """``(page_id, well_formed)`` as an XML parser with only the namespace declarations would decide, row by row."""
    return pages.select(F.col(id_col).alias("page_id"), is_well_formed(F.col(body_col)).alias("well_formed"))


def markup_blocks(tokens: DataFrame) -> DataFrame:
    """Top-level blocks ``(page_id, pos, kind, name)``: every depth-0
    element (open, self-closing or void tag) and every non-blank depth-0 text
    run, in document order."""
    t = tokens.filter((F.col("depth") == 0) & (
        F.col("kind").isin("open", "selfclose", "void")
        | ((F.col("kind") == "text") & (tx.strip(F.col("text")) != ""))))
    return t.select("page_id", "pos", F.when(F.col("kind") == "text", F.lit("text")).otherwise(F.lit("element"))
                    .alias("kind"), F.when(F.col("kind") == "text", F.lit(None)).otherwise(F.col("name")).alias("name"))


def _plain_inner(inner: Column) -> Column:
    """Plain text of a fragment: text pieces between tags, each T8-collapsed,
    then T9-joined (the reference's ``itertext`` + join)."""
    pieces = F.split(F.regexp_replace(inner, r"<[^>]*>", "\u0001"), "\u0001", -1)
    return tx.join_inline(F.transform(pieces, lambda p: tx.collapse_inline(p)))


HEADING_RE = r"(?is)<h([1-6])\b[^>]*>(.*?)</h[1-6]\s*>"
LINK_RE = r"(?is)<a\b([^>]*)>(.*?)</a\s*>"
HREF_RE = r"""(?is)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)')"""


def headings(pages: DataFrame, id_col: str = "page_id", body_col: str = "body") -> DataFrame:
    """D3: ``(page_id, heading_no, level, text)``; blank headings dropped."""
    b = F.col(body_col)
    h = pages.select(F.col(id_col).alias("page_id"), F.arrays_zip(
        F.regexp_extract_all(b, F.lit(HEADING_RE), 1).alias("level"),
        F.regexp_extract_all(b, F.lit(HEADING_RE), 2).alias("inner")).alias("hs"))
    h = h.select("page_id", F.posexplode("hs").alias("heading_no", "h"))
    return (h.select("page_id", "heading_no", F.col("h.level").cast("int").alias("level"),
                     _plain_inner(F.col("h.inner")).alias("text"))
            .filter(F.col("text") != ""))


def links(pages: DataFrame, id_col: str = "page_id", body_col: str = "body") -> DataFrame:
    """``(page_id, link_no, text, href)``; text defaults to the href."""
    b = F.col(body_col)
    h = pages.select(F.col(id_col).alias("page_id"), F.arrays_zip(
        F.regexp_extract_all(b, F.lit(LINK_RE), 1).alias("attrs"),
        F.regexp_extract_all(b, F.lit(LINK_RE), 2).alias("inner")).alias("ls"))
    h = h.select("page_id", F.posexplode("ls").alias("link_no", "l"))
    href = F.concat(F.regexp_extract(F.col("l.attrs"), HREF_RE, 1), F.regexp_extract(F.col("l.attrs"), HREF_RE, 2))
    text = _plain_inner(F.col("l.inner"))
    return h.select("page_id", "link_no", F.when(text != "", text).otherwise(href).alias("text"),
                    href.alias("href"))


IMAGE_RE = r"(?is)<ac:image\b[^>]*>(.*?)</ac:image\s*>"
ATTACHMENT_RE = r"""(?is)<ri:attachment\b(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""


def images(pages: DataFrame, base_url: str, id_col: str = "page_id", body_col: str = "body") -> DataFrame:
    """First attachment file name of each image -> T16 link; images
    without an attachment are dropped."""
    b = F.col(body_col)
    h = pages.select(F.col(id_col).alias("page_id"),
                     F.posexplode(F.regexp_extract_all(b, F.lit(IMAGE_RE), 1)).alias("image_no", "inner"))
    fn = attribute(F.regexp_extract("inner", ATTACHMENT_RE, 0), "ri:filename")
    h = h.select("page_id", "image_no", fn.alias("filename")).filter(F.col("filename") != "")
    link = tx.attachment_link(F.lit(base_url), F.col("page_id").cast("string"), F.col("filename"))
    return h.select("page_id", "image_no", "filename", link.alias("url"),
                    F.concat(F.lit("!["), F.col("filename"), F.lit("]("), link, F.lit(")")).alias("markdown"))


PARAM_RE = r"""(?is)(<ac:parameter\b(?:[^>"']++|"[^"]*+"|'[^']*+')*+(?<!/)>)(.*?)</ac:parameter\s*>"""


def macros(pages: DataFrame, id_col: str = "page_id", body_col: str = "body") -> DataFrame:
    """``(page_id, macro_no, name, params MAP, plain_body, rich_body)`` of every macro, in order of open tags.

    A macro inside another is a row of its own and part of the outer one's
    ``rich_body``; ``params`` and ``plain_body`` are a macro's own. Of
    parameters of one name the first counts.
    """
    m = pages.select(F.col(id_col).alias("page_id"), F.posexplode(macro_array(F.col(body_col))).alias("macro_no", "m"))
    own, inner = F.col("m.own"), F.col("m.inner")
    given = F.zip_with(F.regexp_extract_all(own, F.lit(PARAM_RE), 1), F.regexp_extract_all(own, F.lit(PARAM_RE), 2),
                       lambda tag, v: F.struct(attribute(tag, "ac:name").alias("k"), _plain_inner(v).alias("v")))
    names = F.transform(given, lambda g: g.getField("k"))
    first = F.filter(given, lambda g, i: F.array_position(names, g.getField("k")) == i + 1)
    plain = F.regexp_extract(own, r"(?is)<ac:plain-text-body\b[^>]*>(.*?)</ac:plain-text-body\s*>", 1)
    return m.select(
        "page_id", "macro_no", attribute(F.col("m.tag"), "ac:name").alias("name"),
        F.map_from_entries(first).alias("params"), tx.html_unescape(plain).alias("plain_body"),
        F.regexp_extract(inner, r"(?is)<ac:rich-text-body\b[^>]*>(.*)</ac:rich-text-body\s*>", 1).alias("rich_body"))


def render_status(title: Column, colour: Column, color: Column) -> Column:
    """``:status[title]{color=c}``; ``colour`` is preferred over ``color``."""
    c = F.coalesce(F.nullif(colour, F.lit("")), color, F.lit(""))
    return F.concat(F.lit(":status["), F.coalesce(title, F.lit("")), F.lit("]{color="),
                    tx.status_colour_export(c), F.lit("}"))


def status_tokens(pages: DataFrame, id_col: str = "page_id", body_col: str = "body") -> DataFrame:
    """D13 + D14: status macros rendered as Markdown tokens."""
    m = macros(pages, id_col, body_col).filter(F.col("name") == "status")
    p = F.col("params")
    return m.select("page_id", "macro_no",
                    F.try_element_at(p, F.lit("title")).alias("title"),
                    render_status(F.try_element_at(p, F.lit("title")), F.try_element_at(p, F.lit("colour")),
                                  F.try_element_at(p, F.lit("color"))).alias("markdown"))


# --------------------------------------------------------------------------
# Page export
# --------------------------------------------------------------------------

def _rx(c: Column, pattern: str, repl: str) -> Column:
    return F.regexp_replace(c, F.lit(pattern), F.lit(repl))


def export_markdown(pages: DataFrame, base_url: str, exported_at: str, diagram_macro: str | None = None,
                    strict: bool = True, hubs: DataFrame | None = None) -> DataFrame:
    """``(page_id, title, markdown)``, a row for each row of ``pages``.

    ``pages``: (page_id, title, body, version, webui_url, parent_page_id,
    page_kind, child_count). Bodies are checked and rendered within their row; only hub
    tables are joined, if given. Frontmatter omits a missing parent/kind and a zero
    child count; ``"`` in the title becomes ``'``; ``exported_at`` is a parameter.
    """
    from .storage_md import rendered
    p = pages
    if hubs is not None:  # D18 output (page_id, markdown) for hub pages
        p = p.join(hubs.withColumnRenamed("markdown", "hub_md"), "page_id", "left")
    else:
        p = p.withColumn("hub_md", F.lit(None).cast("string"))
    title = F.coalesce(F.nullif(F.col("title"), F.lit("")), F.lit("Untitled"))
    url = F.coalesce(F.col("webui_url"), F.lit(""))
    body = F.coalesce(F.col("body"), F.lit(""))
    body_md = (F.when((F.col("page_kind") == "hub") & F.col("hub_md").isNotNull(), F.col("hub_md"))
               .when(is_well_formed(body) | F.lit(not strict), rendered(base_url, diagram_macro))
               .otherwise(F.concat(tx.strip_tags(body), F.lit("\n"))))
    lines = F.concat_ws("\n",
                        F.lit("---"),
                        F.concat(F.lit('title: "'), F.replace(title, F.lit('"'), F.lit("'")), F.lit('"')),
                        F.concat(F.lit("confluence_page_id: "), F.col("page_id").cast("string")),
                        F.concat(F.lit("confluence_version: "), F.coalesce(F.col("version").cast("string"),
                                                                             F.lit("None"))),
                        F.when(F.coalesce(F.col("parent_page_id"), F.lit("")) != "",
                               F.concat(F.lit("confluence_parent_page_id: "), F.col("parent_page_id"))),
                        F.when(F.coalesce(F.col("page_kind"), F.lit("")) != "",
                               F.concat(F.lit("confluence_page_kind: "), F.col("page_kind"))),
                        F.when(F.coalesce(F.col("child_count"), F.lit(0)) != 0,
                               F.concat(F.lit("confluence_child_count: "), F.col("child_count").cast("string"))),
                        F.concat(F.lit("source_url: "), url),
                        F.lit("exported_at: " + exported_at),
                        F.lit("---"), F.lit(""),
                        F.concat(F.lit("# "), title), F.lit(""),
                        F.concat(F.lit("Source: "), url), F.lit(""),
                        tx.strip(body_md), F.lit(""))
    return p.select(F.col("page_id"), title.alias("title"), lines.alias("markdown"))
