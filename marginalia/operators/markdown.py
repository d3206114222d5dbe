"""Markdown corpus -> storage markup.

Block structure is a fold over a document's line array with a stack of open
containers (``markdown_fold``, M2-M7); the texts that it finds get their
inline markup here (M8 plain, M9 tokens, M11 status). All of it is one
expression of the row: no window, no shuffle, no pass count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from . import markdown_fold as mf
from .freshness import LINE_BREAKS

# Inline token grammar (image embed, wiki link, status, image, link, code).
INLINE_TOKEN_RE = (r"!\[\[[^\]]+\]\]|\[\[[^\]]+\]\]|:(?i:status)\[[^\]]+\]\{color\s*=\s*[^}]+\}"
                   r"|!\[[^\]]*\]\([^)]+\)|\[[^\]]+\]\([^)]+\)|`[^`]+`")


# --------------------------------------------------------------------------
# inline (M8, M9, M11, T18)
# --------------------------------------------------------------------------

def render_plain(c: Column) -> Column:
    """M8: escape, then ~~del~~, **strong**, __strong__, *em*, _em_."""
    def marked(v: Column) -> Column:
        v = F.regexp_replace(v, r"~~(.+?)~~", "<del>$1</del>")
        v = F.regexp_replace(v, r"\*\*(.+?)\*\*", "<strong>$1</strong>")
        v = F.regexp_replace(v, r"__(.+?)__", "<strong>$1</strong>")
        v = F.regexp_replace(v, r"(?<!\*)\*(?!\*)(.+?)(?<!\*)\*(?!\*)", "<em>$1</em>")
        return F.regexp_replace(v, r"(?<!_)_(?!_)(.+?)(?<!_)_(?!_)", "<em>$1</em>")

    def escaped(x: Column) -> Column:
        return F.when(x.rlike("[&<>\"']"), tx.html_escape(x, quote=True)).otherwise(x)

    # escapes hold none of the marks
    return tx.let(c, lambda x: F.when(x.rlike("[~*_]"), marked(escaped(x))).otherwise(escaped(x)))


def has_url_scheme(c: Column) -> Column:
    return c.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://")


def basename(c: Column) -> Column:
    return F.substring_index(c, "/", -1)


def looks_like_attachment(c: Column) -> Column:
    b = basename(c)
    ext = F.lower(F.substring_index(b, ".", -1))
    return (F.instr(b, ".") > 0) & ~ext.isin("md", "markdown")


def _attachment_link(filename: Column, text: Column) -> Column:
    return F.concat(F.lit('<ac:link><ri:attachment ri:filename="'), tx.html_escape(filename), F.lit('" />'),
                    F.lit("<ac:plain-text-link-body><![CDATA["), text,
                    F.lit("]]></ac:plain-text-link-body></ac:link>"))


def _image(target: Column) -> Column:
    t = F.trim(tx.strip(target), F.lit("<>"))
    return F.when(has_url_scheme(t), F.concat(F.lit('<ac:image><ri:url ri:value="'), tx.html_escape(t),
                                              F.lit('" /></ac:image>'))) \
        .otherwise(F.concat(F.lit('<ac:image><ri:attachment ri:filename="'), tx.html_escape(basename(t)),
                            F.lit('" /></ac:image>')))


def status_macro(title: Column, colour: Column) -> Column:
    """Status token -> status macro (colour Title-cased via T12)."""
    return F.concat(F.lit('<ac:structured-macro ac:name="status" ac:schema-version="1">'
                          '<ac:parameter ac:name="colour">'),
                    tx.html_escape(tx.status_colour_import(colour), quote=False),
                    F.lit('</ac:parameter><ac:parameter ac:name="title">'),
                    tx.html_escape(tx.strip(title), quote=False),
                    F.lit("</ac:parameter></ac:structured-macro>"))


def render_token(tok: Column) -> Column:
    """M9: one inline token -> storage markup."""
    def grp(pat: str, g: int) -> Column:
        return F.regexp_extract(tok, pat, g)

    code = grp(r"^`([^`]+)`$", 1)
    st_t, st_c = grp(r"^:(?i:status)\[([^\]]+)\]\{color\s*=\s*([^}]+)\}$", 1), \
        grp(r"^:(?i:status)\[([^\]]+)\]\{color\s*=\s*([^}]+)\}$", 2)
    obs_img = grp(r"^!\[\[([^\]]+)\]\]$", 1)
    obs_link = grp(r"^\[\[([^\]]+)\]\]$", 1)
    img_t = grp(r"^!\[([^\]]*)\]\(([^)]+)\)$", 2)
    link_text, link_t = grp(r"^\[([^\]]+)\]\(([^)]+)\)$", 1), grp(r"^\[([^\]]+)\]\(([^)]+)\)$", 2)

    def wikilink(v: Column) -> Column:
        return tx.let(v, lambda x: _wikilink_of(x))

    def link(text: Column, target: Column) -> Column:
        t = F.trim(tx.strip(target), F.lit("<>"))
        txt = F.coalesce(F.nullif(tx.strip(text), F.lit("")), t)
        return F.when(has_url_scheme(t), F.concat(F.lit('<a href="'), tx.html_escape(t), F.lit('">'),
                                                  render_plain(txt), F.lit("</a>"))) \
            .otherwise(_attachment_link(basename(t), txt))

    return (F.when(code != "", F.concat(F.lit("<code>"), tx.html_escape(code), F.lit("</code>")))
            .when(st_t != "", status_macro(st_t, st_c))
            .when(obs_img != "", _image(F.split(obs_img, r"\|", 2).getItem(0)))
            .when(obs_link != "", wikilink(obs_link))
            .when(img_t != "", _image(img_t))
            .when(link_t != "", link(link_text, link_t))
            .otherwise(F.lit("")))


def _wikilink_of(v: Column) -> Column:
    parts = F.split(v, r"\|", 2)
    target = tx.strip(parts.getItem(0))
    alias = F.nullif(tx.strip(F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit(""))), F.lit(""))
    text = F.coalesce(alias, target)
    text = F.coalesce(F.nullif(tx.strip(text), F.lit("")), target)
    return F.when(looks_like_attachment(target), _attachment_link(basename(target), text)).otherwise(
        F.concat(F.lit('<ac:link><ri:page ri:content-title="'), tx.html_escape(target),
                 F.lit('" /><ac:plain-text-link-body><![CDATA['), text,
                 F.lit("]]></ac:plain-text-link-body></ac:link>")))


def render_inline(c: Column) -> Column:
    """M9 + M8: split into plain segments and tokens, render each, join."""
    def go(x: Column) -> Column:
        toks = F.regexp_extract_all(x, F.lit(INLINE_TOKEN_RE), 0)
        plains = F.split(x, INLINE_TOKEN_RE, -1)
        rendered = F.zip_with(plains, F.concat(F.transform(toks, render_token), F.array(F.lit(""))),
                              lambda p, t: F.concat(render_plain(F.coalesce(p, F.lit(""))), F.coalesce(t, F.lit(""))))
        return F.array_join(rendered, "")
    # every token has a bracket or a backquote
    return tx.let(F.coalesce(c, F.lit("")), lambda x: F.when(x.rlike(r"[\[`]"), go(x)).otherwise(render_plain(x)))


def link_targets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, token_no, kind, target, text) for images, links and wiki
    links; kind is url | attachment | page. Frontmatter and code have none."""
    texts = F.flatten(F.transform(mf.fold(_normalized(F.col(text_col))).getField("pieces"), lambda p: p.getField("texts")))
    toks = F.flatten(F.transform(texts, lambda x: F.regexp_extract_all(x, F.lit(INLINE_TOKEN_RE), 0)))
    # a plain explode is guarded by a filter on its array's size, which folds the text once more
    t = docs.select(F.col(id_col).alias("doc_id"), F.posexplode_outer(toks).alias("token_no", "tok")).where("tok is not null")
    tok = F.col("tok")
    obs = F.regexp_extract(tok, r"^!?\[\[([^\]]+)\]\]$", 1)
    obs_target = tx.strip(F.split(obs, r"\|", 2).getItem(0))
    obs_alias = F.nullif(tx.strip(F.coalesce(F.try_element_at(F.split(obs, r"\|", 2), F.lit(2)), F.lit(""))),
                         F.lit(""))
    md_target = F.trim(tx.strip(F.regexp_extract(tok, r"^!?\[[^\]]*\]\(([^)]+)\)$", 1)), F.lit("<>"))
    md_text = F.regexp_extract(tok, r"^!?\[([^\]]*)\]\(", 1)
    is_obs = obs != ""
    is_img = tok.startswith("!")
    target = F.when(is_obs, obs_target).otherwise(md_target)
    kind = (F.when(is_obs & ~is_img & ~looks_like_attachment(obs_target), "page")
            .when(~is_obs & has_url_scheme(md_target), "url")
            .otherwise("attachment"))
    text = F.when(is_obs, F.coalesce(obs_alias, obs_target)).otherwise(
        F.coalesce(F.nullif(tx.strip(md_text), F.lit("")), md_target))
    out = t.filter(~tok.startswith("`") & ~F.lower(tok).startswith(":status"))
    return out.select("doc_id", "token_no", F.when(is_img, "image").otherwise("link").alias("token"),
                      kind.alias("kind"),
                      F.when(kind == "attachment", basename(target)).otherwise(target).alias("target"),
                      text.alias("text"))


# --------------------------------------------------------------------------
# lines and blocks (M1-M3)
# --------------------------------------------------------------------------

def strip_frontmatter(text: Column) -> Column:
    """Drop a leading ``---`` block when it is closed (line-based, as
    ``splitlines``); otherwise the text is unchanged."""
    def closed(t: Column, rest: Column, close: Column) -> Column:
        body = F.array_join(F.slice(rest, (close + 1).cast("int"), F.greatest(F.size(rest) - close, F.lit(0))
                                    .cast("int")), "\n")
        return F.when(close > 0, F.when(F.size(rest) > close, body).otherwise(F.lit(""))).otherwise(t)

    def opened(t: Column, lines: Column) -> Column:
        rest = F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(1)))
        return F.when(tx.strip(F.element_at(lines, 1)) == "---", tx.let(rest, lambda r: tx.let(
            F.array_position(F.transform(r, lambda l: tx.strip(l) == "---"), True), lambda close: closed(t, r, close)))).otherwise(t)

    lines = lambda t: F.split(F.regexp_replace(F.regexp_replace(t, LINE_BREAKS, "\n"), "\n\\z", ""), "\n")
    return tx.let(F.coalesce(text, F.lit("")), lambda t: F.when(
        F.contains(t, F.lit("---")), tx.let(lines(t), lambda x: opened(t, x))).otherwise(t))


def markdown_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   frontmatter: bool = True) -> DataFrame:
    """M1: (doc_id, ln, line) after frontmatter removal and newline normalization."""
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.posexplode(F.split(_normalized(F.col(text_col), frontmatter), "\n", -1)).alias("ln", "line"))


def _normalized(text: Column, frontmatter: bool = True) -> Column:
    t = strip_frontmatter(text) if frontmatter else F.coalesce(text, F.lit(""))
    return F.regexp_replace(F.regexp_replace(t, "\r\n", "\n"), "\r", "\n")


def classify_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """M2, M3: (doc_id, ln, line, kind, block_no, block_start) of every line after frontmatter.

    ``kind`` is blank, heading, hr, fence, code (and a closing fence),
    table_start, table_row, item, cont (goes on with an item), quote or text;
    ``block_no`` counts the top-level blocks.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), _normalized(F.col(text_col)).alias("t"))
    d = d.select("doc_id", F.split("t", "\n", -1).alias("ls"), mf.fold(F.col("t"), trace=True).getField("trace").alias("tr"))
    return d.select("doc_id", F.posexplode_outer(F.arrays_zip("ls", "tr")).alias("ln", "x")).where("x is not null").select(
        "doc_id", "ln", F.col("x.ls").alias("line"), F.col("x.tr.kind").alias("kind"), F.col("x.tr.block_no").alias("block_no"),
        F.col("x.tr.start").alias("block_start"))


def markdown_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """M3: (doc_id, block_no, kind, ln) of the first line of every top-level block."""
    return classify_lines(docs, id_col, text_col).where("block_start").select("doc_id", "block_no", "kind", "ln")


def storage_html(text: Column, mermaid_macro: str | None = None, frontmatter: bool = True) -> Column:
    """The storage markup of a Markdown text, as one expression of the row."""
    pieces = mf.fold(_normalized(text, frontmatter), mermaid_macro).getField("pieces")
    return tx.strip(mf.write(pieces, render_inline))


def import_markdown(docs: DataFrame, mermaid_macro: str | None = None, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``(doc_id, html)`` storage markup for every row, in the row; empty and null texts give an empty string."""
    return docs.select(F.col(id_col).alias("doc_id"), storage_html(F.col(text_col), mermaid_macro).alias("html"))
