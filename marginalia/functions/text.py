"""Text scalars as native Column expressions (no Python UDFs).

Every function takes and returns a ``Column`` so it runs inside whole-stage
codegen (or the JVM higher-order-function evaluator) on the executors.

Regex notes (Java vs Python):
* strip uses trim-with-characters over Python's ``str.isspace`` set.
* ``\\z`` is used for "end of input" instead of ``$`` (Java's ``$`` also
  matches before a final line terminator).
"""

from __future__ import annotations

import html.entities

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _re(col: Column, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(col, F.lit(pattern), F.lit(replacement))


# --------------------------------------------------------------------------
# whitespace
# --------------------------------------------------------------------------

# Python's str.isspace() characters. Stripping uses Spark's trim-with-chars
# (no regex, exact Python parity); collapsing uses Java's (?U)\s, which is the
# same set except the separators U+001C..U+001F (Python counts them as space).
PY_SPACE_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
                  + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000")
WS = r"(?U)\s"


def strip(col: ColumnOrName) -> Column:
    """Python ``str.strip()``: drop leading/trailing Unicode whitespace."""
    return F.trim(_c(col), F.lit(PY_SPACE_CHARS))


def rstrip(col: ColumnOrName) -> Column:
    return F.rtrim(_c(col), F.lit(PY_SPACE_CHARS))


def lstrip(col: ColumnOrName) -> Column:
    return F.ltrim(_c(col), F.lit(PY_SPACE_CHARS))


def collapse_ws(col: ColumnOrName) -> Column:
    """Whitespace runs -> one space (no strip)."""
    return _re(_c(col), r"(?U)\s+", " ")


def single_line(col: ColumnOrName) -> Column:
    """Whitespace runs -> one space, stripped."""
    return strip(collapse_ws(col))


normalize_heading = single_line


def truncate(col: ColumnOrName, limit: int) -> Column:
    """At most ``limit`` chars; else first ``limit-1``, right-stripped, + ellipsis."""
    return let(_c(col), lambda c: F.when(F.length(c) <= limit, c).otherwise(
        F.concat(rstrip(F.substring(c, 1, limit - 1)), F.lit("…"))))


# --------------------------------------------------------------------------
# HTML entity codec
# --------------------------------------------------------------------------

# Names come from the Python standard library's HTML 5 table; the old names that
# also count without a semicolon are part of it. One literal holds each map:
# the optimizer folds it.
_OLD_NAMES = {n: c for n, c in html.entities.html5.items() if not n.endswith(";")}
_ENTRY, _VALUE = "\x02", "\x01"


def _literal_map(pairs: dict[str, str]) -> Column:
    return F.str_to_map(F.lit(_ENTRY.join(f"{k}{_VALUE}{v}" for k, v in sorted(pairs.items()))), F.lit(_ENTRY), F.lit(_VALUE))


def _codepoint_to_str(num: Column) -> Column:
    # chr() in Spark is modulo 256, so decode the code point as UTF-32.
    return F.decode(F.unhex(F.lpad(F.hex(num.cast("long")), 8, "0")), "UTF-32")


# One pass over the text: references, runs without '&', or a lone '&'.
_PIECE_RE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)|[^&]+|&"
# Numeric references 128 to 159 mean Windows-1252; the five it leaves open stand for themselves.
_WINDOWS = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(0x80, 0xA0))


def _numeric(s: Column) -> Column:
    """The character of a reference from its ``#`` on: none for control and other characters that no text has."""
    is_hex = s.startswith("#x") | s.startswith("#X")
    # leading zeros count for nothing; more than eight digits are beyond the last code point
    digits = _re(s, r"\A#[xX]?0*|;\z", "")
    digits = F.when(F.length(digits) > 8, F.lit("99999999")).when(digits == "", F.lit("0")).otherwise(digits)
    value = F.when(is_hex, F.conv(digits, 16, 10)).otherwise(digits).cast("long")

    def char(n: Column) -> Column:
        control = (n.between(1, 8) | n.isin(0xB, 0x7F) | n.between(0xE, 0x1F) | n.between(0xFDD0, 0xFDEF)
                   | (n.bitwiseAND(0xFFFE) == 0xFFFE))
        return (F.when(n.between(0x80, 0x9F), F.substring(F.lit(_WINDOWS), (n - 0x7F).cast("int"), F.lit(1)))
                .when((n == 0) | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF), F.lit("\ufffd"))
                .when(control, F.lit("")).otherwise(_codepoint_to_str(n)))

    return let(value, char)


def html_unescape(col: ColumnOrName) -> Column:
    """``html.unescape``: numeric references, all HTML 5 names, old names also without a semicolon.

    The text is split once into references and the rest, and each reference is
    decoded by itself, so the result is single-pass like Python's (``&amp;lt;``
    becomes ``&lt;``). A name that isn't known is matched by its longest known
    beginning (``&notit;`` is ``¬it;``); unknown ones are kept as written.
    """
    names, old = _literal_map(html.entities.html5), _literal_map(_OLD_NAMES)
    longest = max(map(len, _OLD_NAMES))

    def named(s: Column) -> Column:
        known = [F.try_element_at(names, s)]
        for x in range(longest, 1, -1):
            start = F.try_element_at(old, F.substring(s, 1, x))
            known.append(F.when(F.length(s) > x, F.concat(start, F.substring(s, F.lit(x + 1), F.length(s)))))
        return F.coalesce(*known, F.concat(F.lit("&"), s))

    def piece(p: Column) -> Column:
        s = F.substring(p, F.lit(2), F.length(p))
        return F.when(~p.startswith("&") | (F.length(p) == 1), p).when(s.startswith("#"), _numeric(s)).otherwise(named(s))

    def decoded(c: Column) -> Column:
        pieces = F.regexp_extract_all(c, F.lit(_PIECE_RE), 0)
        return F.when(F.instr(c, "&") > 0, F.array_join(F.transform(pieces, piece), "")).otherwise(c)

    return let(_c(col), decoded)


def let(expr: Column, fn) -> Column:
    """Evaluate ``expr`` once and bind it for ``fn`` (avoids duplicating an
    expensive sub-expression that ``fn`` references several times). Neither is
    copied, as a transform would do with each of its results."""
    return F.aggregate(F.array().cast("array<int>"), expr, lambda same, _: same, fn)


def html_escape(col: ColumnOrName, quote: bool = True) -> Column:
    """``html.escape``: ``&`` first, then ``< >`` and (if quote) ``" '``."""
    out = F.replace(_c(col), F.lit("&"), F.lit("&amp;"))
    out = F.replace(out, F.lit("<"), F.lit("&lt;"))
    out = F.replace(out, F.lit(">"), F.lit("&gt;"))
    if quote:
        out = F.replace(out, F.lit('"'), F.lit("&quot;"))
        out = F.replace(out, F.lit("'"), F.lit("&#x27;"))
    return out


def _nbsp_to_space(col: Column) -> Column:
    return F.replace(col, F.lit("\u00a0"), F.lit(" "))


# --------------------------------------------------------------------------
# markup -> text
# --------------------------------------------------------------------------

def tag_rules(col: Column) -> Column:
    v = _re(col, r"(?i)<br\s*/?>", "\n")
    v = _re(v, r"(?i)</p\s*>", "\n\n")
    v = _re(v, r"(?i)<li[^>]*>", "- ")
    v = _re(v, r"(?i)</li\s*>", "\n")
    return _re(v, r"<[^>]+>", " ")


def html_to_text(col: ColumnOrName) -> Column:
    """Block tags to newlines / bullets, other tags to spaces, unescape, tidy."""
    v = _nbsp_to_space(html_unescape(tag_rules(_c(col))))
    v = _re(v, r"[ \t]+\n", "\n")
    v = _re(v, r"\n{3,}", "\n\n")
    v = _re(v, r"[ \t]{2,}", " ")
    return strip(v)


def preview_text(col: ColumnOrName, limit: int = 240) -> Column:
    """T4: null when blank, else whitespace-collapsed and truncated."""
    return let(single_line(_c(col)), lambda v: truncate(F.when(v != "", v), limit))


def preview_html(col: ColumnOrName, limit: int = 240) -> Column:
    """T5: T1's tag rules + unescape, then T4."""
    return preview_text(_nbsp_to_space(html_unescape(tag_rules(_c(col)))), limit)


def comment_preview(col: ColumnOrName, limit: int = 280) -> Column:
    """Collapse (structs/arrays as JSON) and truncate."""
    return truncate(single_line(_c(col)), limit)


def clean_text(col: ColumnOrName) -> Column:
    """Unescape, nbsp, trailing blanks before NL, >=3 NL -> 2, strip."""
    v = _nbsp_to_space(html_unescape(_c(col)))
    v = _re(v, r"[ \t]+\n", "\n")
    v = _re(v, r"\n{3,}", "\n\n")
    return strip(v)


def collapse_inline(col: ColumnOrName) -> Column:
    """Unescape, nbsp, whitespace collapsed, stripped."""
    return single_line(_nbsp_to_space(html_unescape(_c(col))))


def join_inline(pieces: ColumnOrName) -> Column:
    """Space-join non-empty pieces, then tighten punctuation and newlines."""
    arr = F.filter(_c(pieces), lambda p: p.isNotNull() & (p != ""))
    return let(F.array_join(arr, " "), tighten)


def tighten(text: Column) -> Column:
    """T9's second half, of a bound text; only one that has such a place is searched rule by rule."""
    v = _re(text, r"(?U)\s+([,.;!?]|:(?!status\[))", "$1")
    v = _re(v, r"(?U)\(\s+", "(")
    v = _re(v, r"(?U)\s+\)", ")")
    v = F.replace(v, F.lit(" \n "), F.lit("\n"))
    v = F.replace(v, F.lit("\n "), F.lit("\n"))
    v = F.replace(v, F.lit(" \n"), F.lit("\n"))
    return strip(F.when(text.rlike(r"(?U)\s[,.;!?:)]|\(\s|\n"), v).otherwise(text))


def strip_tags(col: ColumnOrName) -> Column:
    """Fallback for unparseable markup: drop tags, then T7."""
    return clean_text(_re(_c(col), r"<[^>]+>", ""))


# --------------------------------------------------------------------------
# names, headers, cells
# --------------------------------------------------------------------------

# Characters not allowed in exported file/folder names.
_UNSAFE_NAME_CHARS = '<>:"/\\|?*'


def sanitize_name(col: ColumnOrName) -> Column:
    """Unsafe chars -> '_', strip, drop trailing dots, collapse, default 'untitled'."""
    v = F.translate(_c(col), _UNSAFE_NAME_CHARS, "_" * len(_UNSAFE_NAME_CHARS))
    v = F.rtrim(strip(v), F.lit("."))
    v = single_line(v)
    return F.coalesce(F.nullif(v, F.lit("")), F.lit("untitled"))


def export_filename(title: ColumnOrName, filename: ColumnOrName | None = None) -> Column:
    """Given file name, else sanitized title; ensure a ``.md`` suffix."""
    base = F.concat(sanitize_name(title), F.lit(".md"))
    if filename is not None:
        given = F.nullif(_c(filename), F.lit(""))
        base = F.coalesce(given, base)
    return F.when(base.endswith(".md"), base).otherwise(F.concat(base, F.lit(".md")))


def normalize_header(col: ColumnOrName) -> Column:
    """T8, lower-case, strip ':' / fullwidth colon at both ends, collapse."""
    v = F.lower(collapse_inline(col))
    v = _re(v, "^[:：]+|[:：]+\\z", "")
    return collapse_ws(v)


def escape_cell(col: ColumnOrName) -> Column:
    """Escape pipes, strip."""
    return strip(F.replace(_c(col), F.lit("|"), F.lit("\\|")))


# Status macro colour aliases (alias -> canonical colour).
STATUS_COLOURS = {
    "blue": "blue", "green": "green", "grey": "grey", "gray": "grey",
    "purple": "purple", "red": "red", "yellow": "yellow",
}


def _colour_map(title_case: bool) -> Column:
    args = []
    for alias, canon in STATUS_COLOURS.items():
        args.extend([F.lit(alias), F.lit(canon.title() if title_case else canon)])
    return F.create_map(*args)


def status_colour_export(col: ColumnOrName) -> Column:
    """T12 (export side): lower-case canonical; unknown lower-cased; blank -> grey."""
    v = strip(F.coalesce(_c(col), F.lit("")))
    low = F.lower(v)
    return F.when(v == "", F.lit("grey")).otherwise(
        F.coalesce(F.try_element_at(_colour_map(False), low), low))


def status_colour_import(col: ColumnOrName) -> Column:
    """T12 (import side): Title-case canonical; unknown kept; blank -> Grey."""
    v = strip(F.coalesce(_c(col), F.lit("")))
    return F.when(v == "", F.lit("Grey")).otherwise(
        F.coalesce(F.try_element_at(_colour_map(True), F.lower(v)), v))


def url_quote(col: ColumnOrName) -> Column:
    """``urllib.parse.quote`` with the default safe set ``/`` (plus ``_.-~``)."""
    v = F.url_encode(_c(col))  # form encoding: space -> '+', '~' -> %7E, '*' kept
    v = F.replace(v, F.lit("+"), F.lit("%20"))
    v = F.replace(v, F.lit("%2F"), F.lit("/"))
    v = F.replace(v, F.lit("%7E"), F.lit("~"))
    return F.replace(v, F.lit("*"), F.lit("%2A"))


def attachment_link(base_url: ColumnOrName, page_id: ColumnOrName, filename: ColumnOrName) -> Column:
    """``{base}/download/attachments/{page}/{quoted filename}``."""
    base = _re(_c(base_url), "/+\\z", "")
    return F.concat(base, F.lit("/download/attachments/"), _c(page_id), F.lit("/"), url_quote(filename))
