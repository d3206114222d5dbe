"""SQL text for the DuckDB oracle.

These helpers spell, in plain ANSI/DuckDB SQL, the same column semantics the
Spark side computes with ``functions.text``. They are used only to build the
independent oracle queries in ``plans.catalog`` (DuckDB regexes are RE2: no
look-around, ``\\s`` is ASCII; the generated inputs avoid the differences).
"""

from __future__ import annotations

NL = "chr(10)"


def re(expr: str, pattern: str, repl: str, flags: str = "g") -> str:
    return f"regexp_replace({expr}, '{pattern}', {repl}, '{flags}')"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(expr: str) -> str:
    return re(expr, r"^\s+|\s+$", "''")


def unescape_basic(expr: str) -> str:
    """The entities that occur in the driver tables and generated markup."""
    v = expr
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
                    ("&copy;", "©"), ("&middot;", "·"), ("&nbsp;", " ")):
        v = f"replace({v}, {lit(ent)}, {lit(ch)})"
    return f"replace({v}, '&amp;', '&')"


def nbsp(expr: str) -> str:
    return f"replace({expr}, chr(160), ' ')"


def tag_rules(expr: str) -> str:
    v = re(expr, r"<br\s*/?>", NL, "gi")
    v = re(v, r"</p\s*>", f"{NL} || {NL}", "gi")
    v = re(v, r"<li[^>]*>", "'- '", "gi")
    v = re(v, r"</li\s*>", NL, "gi")
    return re(v, r"<[^>]+>", "' '")


def html_to_text(expr: str) -> str:
    v = nbsp(unescape_basic(tag_rules(expr)))
    v = re(v, r"[ \t]+\n", NL)
    v = re(v, r"\n{3,}", f"{NL} || {NL}")
    v = re(v, r"[ \t]{2,}", "' '")
    return strip(v)


def single_line(expr: str) -> str:
    return strip(re(expr, r"\s+", "' '"))


def truncate(expr: str, n: int) -> str:
    return (f"(CASE WHEN length({expr}) <= {n} THEN {expr} "
            f"ELSE rtrim(substr({expr}, 1, {n - 1})) || '…' END)")


def clean_text(expr: str) -> str:
    v = nbsp(unescape_basic(expr))
    v = re(v, r"[ \t]+\n", NL)
    v = re(v, r"\n{3,}", f"{NL} || {NL}")
    return strip(v)


def strip_tags(expr: str) -> str:
    return clean_text(re(expr, r"<[^>]+>", "''"))


def preview_text(expr: str, n: int = 240) -> str:
    return truncate(f"NULLIF({single_line(expr)}, '')", n)


def preview_html(expr: str, n: int = 240) -> str:
    return preview_text(nbsp(unescape_basic(tag_rules(expr))), n)


def sanitize_name(expr: str) -> str:
    v = f"translate({expr}, '<>:\"/\\|?*', '_________')"
    v = f"rtrim({strip(v)}, '.')"
    v = single_line(v)
    return f"COALESCE(NULLIF({v}, ''), 'untitled')"


def pages_cte(name: str = "pg") -> str:
    """The ``wiki_pages`` / ``child_edges`` adapter in SQL."""
    title = unescape_basic("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")
    return f"""{name} AS (
  SELECT page_id, CAST(page_id AS VARCHAR) AS id, {title} AS title,
    CASE WHEN page_id % 7 = 0 THEN '<p><br/></p>' WHEN page_id % 7 = 3 THEN '<!-- draft --><p>&nbsp;</p>'
         ELSE html END AS body,
    CASE WHEN page_id > 0 THEN CAST((page_id - 1) // 4 AS VARCHAR) END AS parent_id,
    'SP' || CAST(page_id % 3 AS VARCHAR) AS space_key,
    CAST(page_id % 5 + 1 AS BIGINT) AS version,
    CASE WHEN page_id % 6 = 5 THEN NULL ELSE 'https://wiki.example.com/pages/' || CAST(page_id AS VARCHAR) END
      AS webui_url
  FROM pages)"""


def is_empty_body(expr: str) -> str:
    v = f"replace(replace({expr}, chr(160), ' '), '&nbsp;', ' ')"
    v = re(v, r"<!--.*?-->", "''", "gs")
    v = re(v, r"<p>\s*(<br\s*/?>)?\s*</p>", "''", "gi")
    v = re(v, r"<br\s*/?>", "''", "gi")
    v = re(v, r"\s+", "''")
    return f"({expr} IS NULL OR {expr} = '' OR {v} = '')"


def collapse_inline(expr: str) -> str:
    return single_line(nbsp(unescape_basic(expr)))


def join_inline_list(lst: str) -> str:
    """T9 over a DuckDB list. ``:status[`` is shielded first because RE2 has
    no look-ahead."""
    v = f"array_to_string(list_filter({lst}, lambda x: x <> ''), ' ')"
    v = f"replace({v}, ':status[', chr(1))"
    v = re(v, r"\s+([,.;!?:])", r"'\1'")
    v = f"replace({v}, chr(1), ':status[')"
    v = re(v, r"\(\s+", "'('")
    v = re(v, r"\s+\)", "')'")
    v = f"replace(replace(replace({v}, ' ' || chr(10) || ' ', chr(10)), chr(10) || ' ', chr(10)), ' ' || chr(10), chr(10))"
    return strip(v)


def plain_inner(expr: str) -> str:
    pieces = f"string_split(regexp_replace({expr}, '<[^>]*>', chr(1), 'g'), chr(1))"
    return join_inline_list(f"list_transform({pieces}, lambda p: {collapse_inline('p')})")
