"""Storage markup as a shift-reduce fold over a row's token array.

``tokens`` cuts a body into tags and text; attribute values may hold ``>``.
``aggregate`` then reads the tokens with a stack of open elements: an open tag
is shifted, a close tag reduces the element on top into its parent. A reduced
element is known in every form that a parent may ask for (as a block, inline,
as plain text, as list lines, as a table cell), so containers of any kind
nest to any depth in one pass. All of it is one expression of the row: no
shuffle, no pass count, no Python.
"""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as tx

# The grammar of a fragment that an XML parser accepts.
_NAME = r"[\p{L}_][\p{L}\p{N}_.·-]*"
_QNAME = rf"{_NAME}(?::{_NAME})?"
_ENTITY = r"&(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9a-fA-F]+);"
_ATTRIBUTE = rf"""\s+{_QNAME}\s*=\s*(?:"(?:[^"<&]++|{_ENTITY})*+"|'(?:[^'<&]++|{_ENTITY})*+')"""
_COMMENT, _CDATA = r"<!--(?:[^-]++|-(?!-))*+-->", r"(?s:<!\[CDATA\[.*?\]\]>)"
_INSTRUCTION = rf"(?s:<\?(?!(?i:xml)[\s?]){_NAME}(?:\s.*?)?\?>)"
_VALID = "|".join([rf"<{_QNAME}(?:{_ATTRIBUTE})*+\s*/?>", rf"</{_QNAME}\s*>", _COMMENT, _CDATA, _INSTRUCTION,
                   rf"(?:[^<&\]]++|\](?!\]>)|{_ENTITY})++"])
_UNSEEN = f"(?s:<!--.*?-->)|{_CDATA}|" + r"(?s:<\?.*?\?>)"
# A tag; quoted values are taken whole.
_TAG = r"""<(?:[^>"'<]++|"[^"]*+"|'[^']*+')*+>"""
_ATTRIBUTES = r"""(?:[^>"'/]++|/(?!>)|"[^"]*+"|'[^']*+')*+"""
_ALONE = rf"<[^\s/>]+{_ATTRIBUTES}/>"
_LEVELS = 3
_NOT_XML = r"[\x00-\x08\x0B\x0C\x0E-\x1F￾￿]"

# Macros that become callouts, emphasis and table words of the reference.
CALLOUTS = ["info", "note", "tip", "warning", "expand"]
_EMPHASIS = ["strong", "b", "em", "i"]
_HEADINGS = ["h1", "h2", "h3", "h4", "h5", "h6"]
_SECTIONS = ["tbody", "thead", "tfoot"]
_CELL_BLOCKS = ["p", "ul", "ol", "table", "pre", "div", "image"]
KEY_HEADERS = [
    "category", "component", "feature", "field", "flow", "group", "item", "label", "name", "option",
    "screen", "section", "setting", "step", "title",
    "구분", "기능", "단계", "명칭", "분류", "설정", "섹션", "순서", "옵션", "이름", "항목명", "카테고리",
    "컴포넌트", "타이틀", "항목", "화면", "흐름", "필드",
]
CONTENT_HEADERS = [
    "content", "definition", "description", "detail", "details", "overview", "summary",
    "내용", "상세", "설명", "요약",
]

# Marks at the start of a list's lines until its indent is known: an item, and one more level. No XML holds them.
_ITEM, _LEVEL = "\x01", "\x02"


def _decode(x: Column) -> Column:
    return tx.html_unescape(x)


def _one_of(name: Column, names: list[str]) -> Column:
    """``isin`` for a few names as comparisons, which stop at the first that holds; in a fold a list is walked much slower."""
    return reduce(lambda a, b: a | b, [name == n for n in names])


def _collapse(x: Column) -> Column:
    return tx.single_line(F.replace(_decode(x), F.lit(" "), F.lit(" ")))


def _written(tag: Column, name: str) -> Column:
    """Value of an attribute in either kind of quotes, as written; empty without it."""
    pattern = rf"""\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)')"""
    return F.concat(F.regexp_extract(tag, pattern, 1), F.regexp_extract(tag, pattern, 2))


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute, decoded."""
    return _decode(_written(tag, name))


def _seen(body: Column) -> Column:
    """Without comments and instructions; CDATA as escaped text."""
    parts, unseen = F.split(body, _UNSEEN, -1), F.regexp_extract_all(body, F.lit(_UNSEEN), 0)
    told = F.transform(unseen, lambda u: F.when(u.startswith("<![CDATA["), tx.html_escape(
        F.substring(u, F.lit(10), F.length(u) - 12), quote=False)).otherwise(F.lit("")))
    joined = F.array_join(F.zip_with(parts, told, lambda p, t: F.concat(F.coalesce(p, F.lit("")), F.coalesce(t, F.lit("")))), "")
    return F.when((F.instr(body, "<!") > 0) | (F.instr(body, "<?") > 0), joined).otherwise(body)


# -- well-formedness (D1) -----------------------------------------------------------------------------------------

def _balanced(core: Column) -> Column:
    """Whether every close tag names the element opened last, and none stays open.

    Pairs of tags without a tag between them are taken out a few levels deep, siblings at once; the stack reads what is left.
    """
    tags = F.when(F.contains(core, F.lit("/>")), F.regexp_replace(core, _ALONE, "")).otherwise(core)
    tags = F.regexp_replace(tags, rf"<(/?[^\s/>]+){_ATTRIBUTES}>[^<]*", "<$1>")
    for _ in range(_LEVELS):
        tags = F.regexp_replace(tags, r"<([^/>]+)></\1>", "")
    return tx.let(tags, lambda t: ~F.contains(t, F.lit("<")) | _stack_balanced(F.regexp_extract_all(t, F.lit("<[^>]*>"), 0)))


def _stack_balanced(tags: Column) -> Column:
    name = lambda t: F.regexp_extract(t, rf"^</?({_QNAME})", 1)
    start = F.struct(F.array().cast("array<string>").alias("open"), F.lit(True).alias("ok"))

    def step(s: Column, t: Column) -> Column:
        stack, top = s.getField("open"), F.try_element_at(s.getField("open"), F.lit(-1))
        shifted = F.struct(F.concat(stack, F.array(name(t))).alias("open"), F.lit(True).alias("ok"))
        reduced = F.struct(F.slice(stack, 1, F.greatest(F.size(stack) - 1, F.lit(0))).alias("open"),
                           F.coalesce(top == name(t), F.lit(False)).alias("ok"))
        return F.when(~s.getField("ok") | t.endswith("/>"), s).when(t.startswith("</"), reduced).otherwise(shifted)

    return F.aggregate(tags, start, step, lambda s: s.getField("ok") & (F.size(s.getField("open")) == 0))


def _names_known(core: Column, tags: Column) -> Column:
    """Whether all prefixes are declared and no tag has an attribute twice. A prefix declared anywhere counts everywhere."""
    declared = F.concat(F.array(*[F.lit(p) for p in ("", "ac", "ri", "xml", "xmlns")]),
                        F.regexp_extract_all(core, F.lit(rf"\sxmlns:({_NAME})\s*="), 1))
    prefix = lambda n: F.regexp_extract(n, r"^([^:]*):", 1)
    own = lambda t: F.regexp_extract_all(
        t, F.lit(rf"""\s({_QNAME})\s*=\s*(?:"[^"]*"|'[^']*')"""), 1)
    bad = lambda t: (~F.array_contains(declared, prefix(F.regexp_extract(t, rf"^</?({_QNAME})", 1)))
                     | tx.let(own(t), lambda a: (F.size(F.array_distinct(a)) != F.size(a))
                              | F.exists(a, lambda n: ~F.array_contains(declared, prefix(n)))))
    named = F.filter(tags, lambda t: F.contains(t, F.lit(":")) | F.contains(t, F.lit("=")))
    return ~(F.contains(core, F.lit(":")) | F.contains(core, F.lit("="))) | ~F.exists(named, bad)


def _references_known(core: Column) -> Column:
    """Whether numeric references name characters that XML allows."""
    def allowed(r: Column) -> Column:
        digits = F.concat(F.lit("0"), F.regexp_replace(r, r"^x?0*", ""))
        value = F.when(F.length(digits) > 8, F.lit(1 << 30)).otherwise(
            F.when(r.startswith("x"), F.conv(digits, 16, 10)).otherwise(digits).cast("long"))
        return tx.let(value, lambda v: v.isin(9, 10, 13) | v.between(0x20, 0xD7FF) | v.between(0xE000, 0xFFFD)
                      | v.between(0x10000, 0x10FFFF))

    return (F.instr(core, "&#") == 0) | F.forall(F.regexp_extract_all(core, F.lit("&#(x?[0-9a-fA-F]+);"), 1), allowed)


def is_well_formed(body: Column) -> Column:
    """Whether an XML parser that knows the prefixes ``ac`` and ``ri`` accepts the body as a fragment."""
    def read(b: Column) -> Column:
        grammar = (F.regexp_replace(b, _VALID, "") == "") & ~b.rlike(_NOT_XML)
        core = F.when(F.contains(b, F.lit("<!")) | F.contains(b, F.lit("<?")), F.regexp_replace(b, _UNSEEN, "")).otherwise(b)
        # what breaks the grammar isn't read further
        return F.when(~grammar, F.lit(False)).otherwise(tx.let(core, lambda c: _balanced(c) & _names_known(
            c, F.regexp_extract_all(c, F.lit(_TAG), 0)) & _references_known(c)))

    return tx.let(F.coalesce(body, F.lit("")), read)


# -- the fold -----------------------------------------------------------------------------------------------------

_CELL = "struct<f:string,c:string>"
_TYPES = {
    "n": "string", "at1": "string", "pos": "int", "kids": "int",  # local name, its attribute, its token, children so far
    "ic": "string", "pt": "string", "raw": "string",  # inline pieces, collapsed text pieces, all text as it is
    "bl": "string", "out": "array<string>",           # children as blocks; the root keeps them apart
    "em": "boolean", "at": "string", "pb": "string", "rb": "string",  # emphasis inside, first attachment, macro bodies
    "p1": "string", "p2": "string", "p3": "string",   # macro parameters title, colour, color
    "li": "string", "ln": "string", "num": "int",     # an item's text, its or a list's lines, items so far
    "fc": "string", "cc": "string", "ci": "string",   # a cell's pieces, its blocks, inline pieces after them
    "row": f"array<{_CELL}>", "rows": f"array<array<{_CELL}>>",
    "tabs": f"array<struct<pos:int,rows:array<array<{_CELL}>>>>",
}
_EMPTY = {"string": lambda: F.lit(""), "int": lambda: F.lit(0), "boolean": lambda: F.lit(False)}
_UNSET = {"at", "pb", "rb", "p1", "p2", "p3"}


def _frame(**given: Column) -> Column:
    def field(name: str, kind: str) -> Column:
        if name in given:
            value = given[name]
        elif name in _UNSET:
            value = F.lit(None)
        else:
            value = _EMPTY[kind]() if kind in _EMPTY else F.array()
        return value.cast(kind).alias(name)

    return F.struct(*[field(n, k) for n, k in _TYPES.items()])


def _put(frame: Column, **changes: Column) -> Column:
    return F.struct(*[changes.get(n, frame.getField(n)).alias(n) for n in _TYPES])


def _with_top(stack: Column, drop: int, frame: Column) -> Column:
    return F.concat(F.slice(stack, 1, F.size(stack) - drop), F.array(frame))


def _add(a: Column, b: Column, between: str = " ") -> Column:
    return F.when(b == "", a).when(a == "", b).otherwise(F.concat(a, F.lit(between), b))


def _tidy(pieces: Column) -> Column:
    return F.when(pieces == "", pieces).otherwise(tx.tighten(pieces))


def _indented(lines: Column, base: int) -> Column:
    """List lines with the indent they get where the list itself stands at ``base``."""
    def line(x: Column) -> Column:
        k = F.length(F.regexp_extract(x, f"^{_LEVEL}*", 0))
        item = F.substring(x, k + 1, F.lit(1)) == _ITEM
        spaces = 2 * base * k + k * (k + 1) + F.when(item, 2 * (base + k)).otherwise(0)
        return F.concat(F.repeat(F.lit(" "), spaces), F.substring(x, k + 1 + item.cast("int"), F.length(x)))

    return F.array_join(F.transform(F.split(lines, "\n", -1), line), "\n")


def table_markdown(rows: Column) -> Column:
    """A Markdown table, or sections where the first two headers say key and content; empty without rows."""
    def line(cells: Column) -> Column:
        return F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))

    def written(flat: Column, headers: Column) -> Column:
        width = F.array_max(F.transform(flat, lambda r: F.size(r)))
        keyed = (F.size(headers) >= 2) & F.forall(
            F.transform(F.slice(headers, 1, 2), lambda h, i: F.struct(tx.normalize_header(h).alias("h"), i.alias("i"))),
            lambda x: F.when(x.getField("i") == 0, x.getField("h").isin(KEY_HEADERS)).otherwise(x.getField("h").isin(CONTENT_HEADERS)))

        def plain(w: Column) -> Column:
            padded = F.transform(flat, lambda r: line(F.concat(r, F.array_repeat(F.lit(""), w - F.size(r)))))
            return tx.let(padded, lambda all_lines: F.array_join(F.concat(
                F.slice(all_lines, 1, 1), F.array(line(F.array_repeat(F.lit("---"), w))),
                F.slice(all_lines, 2, F.size(flat))), "\n"))

        def section(row: Column) -> Column:
            def part(c: Column, i: Column) -> Column:
                text = tx.strip(c.getField("c"))
                label = F.coalesce(F.nullif(tx.strip(F.try_element_at(headers, i + 1)), F.lit("")),
                                   F.concat(F.lit("Note "), i.cast("string")))
                below = (F.instr(text, "\n") > 0) | text.rlike(r"\A(-|\||!\[|#|```)")
                return (F.when(i == 0, F.concat(F.lit("#### "), F.when(c.getField("f") == "", "Item").otherwise(c.getField("f")),
                                                F.lit("\n\n")))
                        .when((text == "") | ((i > 1) & (i >= F.size(headers))), F.lit(""))
                        .when(i == 1, F.concat(text, F.lit("\n\n")))
                        .when(below, F.concat(F.lit("**"), label, F.lit("**\n\n"), text, F.lit("\n\n")))
                        .otherwise(F.concat(F.lit("**"), label, F.lit(":** "), text, F.lit("\n\n"))))

            return F.array_join(F.transform(row, part), "")

        sections = tx.strip(F.array_join(F.transform(F.slice(rows, 2, F.size(rows)), section), ""))
        return F.when(keyed, sections).otherwise(tx.let(width, plain))

    flat = F.transform(rows, lambda r: F.transform(r, lambda c: c.getField("f")))
    return F.when(F.size(rows) == 0, F.lit("")).otherwise(
        tx.let(flat, lambda x: tx.let(F.element_at(x, 1), lambda headers: written(x, headers))))


def _flat_cell(f: Column) -> Column:
    """A cell in one line."""
    v = F.replace(F.replace(_tidy(f.getField("fc")), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit("<br>"))
    return tx.strip(F.regexp_replace(F.regexp_replace(v, r"(?U)\s{2,}", " "), r"\A(<br>\s*)+\z", ""))


def _content_cell(f: Column) -> Column:
    return tx.strip(_add(f.getField("cc"), _tidy(f.getField("ci")), "\n\n"))


class Renderer:
    """The fold's steps for pages of one site."""

    def __init__(self, page_id: Column, base_url: str, diagram_macro: str | None):
        self.page_id, self.base_url, self.diagram_macro = page_id.cast("string"), F.lit(base_url), diagram_macro
        self._built: dict[tuple[str, str], Column] = {}

    def _image(self, f: Column) -> Column:
        name = F.coalesce(f.getField("at"), F.lit(""))
        return F.when(name == "", F.lit("")).otherwise(F.concat(
            F.lit("!["), name, F.lit("]("), tx.attachment_link(self.base_url, self.page_id, name), F.lit(")\n\n")))

    @staticmethod
    def _status(f: Column) -> Column:
        given = lambda p: F.coalesce(f.getField(p), F.lit(""))
        colour = F.coalesce(F.nullif(given("p2"), F.lit("")), given("p3"))
        return F.concat(F.lit(":status["), given("p1"), F.lit("]{color="), tx.status_colour_export(colour), F.lit("}"))

    @staticmethod
    def _callout(f: Column) -> Column:
        title, body = F.coalesce(f.getField("p1"), F.lit("")), tx.strip(F.coalesce(f.getField("rb"), F.lit("")))
        head = F.concat(F.lit("> [!"), F.upper(f.getField("at1")), F.lit("]"),
                        F.when(title == "", "").otherwise(F.concat(F.lit(" "), title)))

        def quoted(b: Column) -> Column:
            lines = F.transform(F.split(b, "\n", -1), lambda x: F.when(x == "", ">").otherwise(F.concat(F.lit("> "), x)))
            return F.when(b == "", "").otherwise(F.concat(F.lit("\n"), F.array_join(lines, "\n")))

        return F.concat(head, tx.let(body, quoted), F.lit("\n\n"))

    def _made(self, f: Column) -> Column:
        """What the forms of an element are made of, each once: inline and plain text, special content."""
        n = f.getField("n")
        macro = F.when(f.getField("at1") == "status", self._status(f)).when(
            _one_of(f.getField("at1"), CALLOUTS), self._callout(f)).otherwise(F.lit(""))
        special = (F.when(n == "table", table_markdown(f.getField("rows"))).when(n == "image", self._image(f))
                   .when(n == "structured-macro", macro).when(_one_of(n, ["td", "th"]), _flat_cell(f))
                   .when(n == "parameter", _collapse(f.getField("raw"))).otherwise(F.lit("")))
        plain = F.when(f.getField("em") | _one_of(n, _HEADINGS), _tidy(f.getField("pt"))).otherwise(F.lit(""))
        # the forms of these don't read their inline text
        unread = _one_of(n, ["ul", "ol", "table", "structured-macro", "image", "attachment", "br"])
        own = F.when(unread, F.lit("")).otherwise(_tidy(f.getField("ic")))
        return F.struct(own.alias("own"), plain.alias("plain"), special.alias("special"))

    @staticmethod
    def _inline(f: Column, made: Column) -> Column:
        n, own, special, value = f.getField("n"), made.getField("own"), made.getField("special"), f.getField("at1")
        # Emphasis in emphasis is plain
        text = F.when(_one_of(n, _EMPHASIS) & f.getField("em"), made.getField("plain")).otherwise(own)
        mark = (F.when(f.getField("em"), "").when(_one_of(n, ["strong", "b"]), "**").when(_one_of(n, ["em", "i"]), "*").otherwise(""))
        mark = F.when(n == "code", "`").otherwise(mark)
        listed = F.concat(F.lit("\n"), tx.strip(_indented(f.getField("ln"), 1)), F.lit("\n"))
        return (F.when(_one_of(n, ["code", *_EMPHASIS]), F.when(text == "", "").otherwise(F.concat(mark, text, mark)))
                .when(n == "br", F.lit("\n"))
                .when((n == "a") & (value != ""), F.concat(F.lit("["), F.when(own == "", value).otherwise(own), F.lit("]("), value,
                                                           F.lit(")")))
                .when(n == "image", tx.strip(special))
                .when(n == "attachment", value)
                .when(n == "structured-macro", F.when(value == "status", special).otherwise(F.lit("")))
                .when(_one_of(n, ["ul", "ol"]), listed)
                .when(n == "table", F.concat(F.lit("\n"), tx.strip(special), F.lit("\n")))
                .otherwise(own))

    def _block(self, f: Column, made: Column) -> Column:
        n, own, special, value = f.getField("n"), made.getField("own"), made.getField("special"), f.getField("at1")
        end = F.lit("\n\n")
        kinds = F.when(value == "toc", F.lit(""))
        if self.diagram_macro:
            code = F.regexp_replace(F.coalesce(f.getField("pb"), F.lit("")), r"\A\n+|\n+\z", "")
            kinds = kinds.when(value == self.diagram_macro, F.concat(
                F.lit("```mermaid\n"), tx.let(code, lambda t: F.when(t == "", t).otherwise(F.concat(t, F.lit("\n")))), F.lit("```\n\n")))
        kinds = (kinds.when(value == "status", F.concat(special, end)).when(_one_of(value, CALLOUTS), special)
                 .otherwise(f.getField("bl")))
        pre = F.regexp_replace(f.getField("raw"), r"\A\n+|\n+\z", "")
        return (F.when(n == "structured-macro", kinds)
                .when(_one_of(n, _HEADINGS), F.when(made.getField("plain") == "", "").otherwise(F.concat(
                    F.repeat(F.lit("#"), F.substring(n, 2, 1).cast("int")), F.lit(" "), made.getField("plain"), end)))
                .when(n == "p", F.when(own == "", F.lit("\n")).otherwise(F.concat(own, end)))
                .when(n == "hr", F.lit("---\n\n"))
                .when(_one_of(n, ["ul", "ol"]), F.concat(_indented(f.getField("ln"), 0), F.lit("\n")))
                .when(n == "table", F.concat(special, end))
                .when(n == "pre", tx.let(pre, lambda t: F.when(t == "", t).otherwise(
                    F.concat(F.lit("```\n"), t, F.lit("\n```\n\n")))))
                .when(_one_of(n, ["image", "td", "th"]), special)
                .when(n == "br", F.lit("\n"))
                .otherwise(f.getField("bl")))

    def _text(self, stack: Column, token: Column) -> Column:
        raw, c, root = token.getField("x"), token.getField("c"), F.size(stack) == 1

        def into(top: Column) -> Column:
            g = top.getField
            cell = _one_of(g("n"), ["td", "th"])
            tail = F.when((c == "") | (g("kids") == 0), F.lit("")).otherwise(F.concat(c, F.lit("\n")))
            some = lambda when, a, b: F.when(when, b).otherwise(a)
            return _with_top(stack, 1, _put(
                top, raw=some(~root, g("raw"), F.concat(g("raw"), raw)), ic=some(~root, g("ic"), _add(g("ic"), c)),
                pt=some(~root, g("pt"), _add(g("pt"), c)), bl=some(~root, g("bl"), F.concat(g("bl"), tail)),
                out=some(root & (tail != ""), g("out"), F.concat(g("out"), F.array(tail))),
                li=some(g("n") == "li", g("li"), F.concat(g("li"), c)),
                fc=some(cell, g("fc"), _add(g("fc"), c)), ci=some(cell, g("ci"), _add(g("ci"), c))))

        return tx.let(F.element_at(stack, -1), into)

    def _reduce(self, stack: Column) -> Column:
        def into(f: Column, p: Column, made: Column, forms: Column) -> Column:
            g, c = p.getField, f.getField
            inline, block, special = forms.getField("inline"), forms.getField("block"), made.getField("special")
            n, pn, root = c("n"), g("n"), F.size(stack) == 2
            some = lambda when, a, b: F.when(when, b).otherwise(a)
            is_list, cell = _one_of(n, ["ul", "ol"]), _one_of(pn, ["td", "th"])

            # parameters and the body of a macro: the first of a name counts
            given = (pn == "structured-macro") & (n == "parameter")
            value = lambda name, a: F.coalesce(a, F.when(given & (c("at1") == name), special))
            # list items
            below = F.when(is_list, F.regexp_replace(tx.rstrip(c("ln")), r"(?dm)^(?=[^\n])", _LEVEL)).otherwise(
                tx.rstrip(block))
            nests = is_list | (n == "table")
            number = F.when(pn == "ol", F.concat((g("num") + 1).cast("string"), F.lit(". "))).otherwise(F.lit("- "))
            item = _add(tx.rstrip(F.concat(F.lit(_ITEM), number, tx.strip(c("li")))), c("ln"), "\n")
            takes_item = _one_of(pn, ["ul", "ol"]) & (n == "li")
            # cells
            flat = F.when(nests, F.replace(tx.strip(block), F.lit("\n"), F.lit("<br>"))).otherwise(inline)
            ends_run = _one_of(n, _CELL_BLOCKS) | n.startswith("h")
            flushed = _add(g("cc"), _tidy(g("ci")), "\n\n")
            breaks = cell & (ends_run | (n == "br"))
            takes_cell = (pn == "tr") & _one_of(n, ["td", "th"])
            takes_row = _one_of(pn, ["table", *_SECTIONS]) & (n == "tr") & (F.size(c("row")) > 0)
            new = _put(
                p, kids=g("kids") + 1,
                ic=some(~root, g("ic"), _add(g("ic"), inline)), pt=some(~root, g("pt"), _add(g("pt"), c("pt"))),
                raw=some(~root, g("raw"), F.concat(g("raw"), c("raw"))), bl=some(~root, g("bl"), F.concat(g("bl"), block)),
                out=some(root, g("out"), F.concat(g("out"), F.array(block))),
                em=g("em") | c("em") | _one_of(n, _EMPHASIS),
                at=F.coalesce(g("at"), F.when(n == "attachment", c("at1")), c("at")),
                pb=F.coalesce(g("pb"), F.when(n == "plain-text-body", c("raw")), c("pb")),
                rb=F.coalesce(g("rb"), F.when((pn == "structured-macro") & (n == "rich-text-body"), c("bl"))),
                p1=value("title", g("p1")), p2=value("colour", g("p2")), p3=value("color", g("p3")),
                li=some((pn == "li") & ~nests, g("li"), F.concat(g("li"), inline)),
                ln=F.when((pn == "li") & nests, _add(g("ln"), below, "\n")).when(takes_item, _add(g("ln"), item, "\n")).otherwise(g("ln")),
                num=g("num") + takes_item.cast("int"),
                fc=some(cell, g("fc"), _add(g("fc"), flat)),
                cc=some(breaks, g("cc"), _add(flushed, F.when(n == "br", "").otherwise(tx.strip(block)), "\n\n")),
                ci=F.when(breaks, F.lit("")).when(cell, _add(g("ci"), inline)).otherwise(g("ci")),
                row=some(takes_cell, g("row"), F.concat(g("row"), F.array(F.struct(
                    special.alias("f"), _content_cell(f).alias("c"))))),
                rows=F.when(takes_row, F.concat(g("rows"), F.array(c("row")))).when(
                    (pn == "table") & _one_of(n, _SECTIONS), F.concat(g("rows"), c("rows"))).otherwise(g("rows")),
                tabs=F.concat(g("tabs"), c("tabs"), F.when((n == "table") & (F.size(c("rows")) > 0), F.array(F.struct(
                    c("pos").alias("pos"), c("rows").alias("rows")))).otherwise(F.array().cast(_TYPES["tabs"]))))
            return _with_top(stack, 2, new)

        def forms(f: Column, made: Column) -> Column:
            return F.struct(self._inline(f, made).alias("inline"), self._block(f, made).alias("block"))

        return tx.let(F.element_at(stack, -1), lambda f: tx.let(self._made(f), lambda made: tx.let(
            forms(f, made), lambda x: tx.let(F.element_at(stack, -2), lambda p: into(f, p, made, x)))))

    def root(self, body: Column) -> Column:
        """The frame of the whole body after the fold; what is left open in malformed markup is closed at its end."""
        items = tokens(body)

        def step(stack: Column, t: Column) -> Column:
            opened = _frame(n=t.getField("n"), at1=t.getField("x"), pos=t.getField("pos"))
            return (F.when(t.getField("k") == "t", self._text(stack, t))
                    .when(t.getField("k") == "o", F.concat(stack, F.array(opened)))
                    .when(F.size(stack) > 1, self._reduce(stack)).otherwise(stack))

        def closed(all_items: Column) -> Column:
            missing = F.size(F.filter(all_items, lambda t: t.getField("k") == "o")) - F.size(
                F.filter(all_items, lambda t: t.getField("k") == "c"))
            end = F.struct(F.lit("c").alias("k"), F.lit("").alias("n"), F.lit("").alias("x"), F.lit("").alias("c"), F.lit(0).alias("pos"))
            return F.concat(all_items, F.array_repeat(end, F.greatest(missing, F.lit(0))))

        return F.aggregate(tx.let(items, closed), F.array(_frame()), step, lambda stack: F.element_at(stack, 1))

    def markdown(self, body: Column) -> Column:
        """All blocks of a body, before the line rules of the export."""
        return F.array_join(self.root(body).getField("out"), "")

    @staticmethod
    def of(page_id: str, base_url: str, diagram_macro: str | None) -> Renderer:
        """The renderer of a column of page ids; building its steps takes seconds, so each is kept for its application."""
        return _renderer(SparkContext._active_spark_context.applicationId, page_id, base_url, diagram_macro)

    def of_column(self, form: str, body: str) -> Column:
        """``markdown`` or ``tables`` of a column, built once."""
        if (form, body) not in self._built:
            self._built[form, body] = getattr(self, form)(F.coalesce(F.col(body), F.lit("")))
        return self._built[form, body]

    def tables(self, body: Column) -> Column:
        """Rows of cells (f: in one line, c: as blocks) of every table, in order of their open tags."""
        return F.array_sort(self.root(body).getField("tabs"))


@lru_cache(maxsize=32)
def _renderer(application: str, page_id: str, base_url: str, diagram_macro: str | None) -> Renderer:
    return Renderer(F.col(page_id), base_url, diagram_macro)


def tokens(body: Column) -> Column:
    """(k, n, x, c, pos): text, open and close tags in order; an empty element is opened and closed.

    ``n``: name without prefix; ``x``: decoded text, or the one attribute that the export reads of such an element;
    ``c``: text with its white space collapsed.
    """
    cut = F.regexp_extract_all(_seen(F.coalesce(body, F.lit(""))), F.lit(rf"{_TAG}|[^<]+|<"), 0)
    empty = F.array().cast("array<struct<k:string,n:string,x:string,c:string,pos:int>>")

    def read(t: Column, i: Column) -> Column:
        kind = (F.when(~t.startswith("<") | (F.length(t) == 1), "t").when(t.startswith("</"), "c")
                .when(t.startswith("<!") | t.startswith("<?"), "").when(t.endswith("/>"), "oc").otherwise("o"))
        name = F.when(kind == "t", "").otherwise(F.regexp_extract(t, r"^</?(?:[^\s/>:]*:)?([^\s/>]+)", 1))

        def with_value(h: Column) -> Column:
            k, n = h.getField("k"), h.getField("n")
            value = (F.when(k == "t", t).when(n == "a", _written(t, "href")).when(n == "attachment", _written(t, "ri:filename"))
                     .when(_one_of(n, ["structured-macro", "parameter"]), _written(t, "ac:name")).otherwise(F.lit("")))

            def parts(x: Column) -> Column:
                one = lambda kind: F.struct(F.lit(kind).alias("k"), n.alias("n"), x.alias("x"), F.when(
                    F.lit(kind == "t"), _collapse(x) if kind == "t" else F.lit("")).alias("c"), i.alias("pos"))
                return (F.when(k == "t", F.array(one("t"))).when(k == "o", F.array(one("o"))).when(k == "c", F.array(one("c")))
                        .when(k == "oc", F.array(one("o"), one("c"))).otherwise(empty))

            return tx.let(_decode(value), parts)

        return tx.let(F.struct(kind.alias("k"), name.alias("n")), with_value)

    return F.flatten(F.transform(cut, read))


# -- macros as rows (D13) -----------------------------------------------------------------------------------------

_MACRO_TAG = r"""</?ac:structured-macro(?=[\s/>])(?:[^>"'<]++|"[^"]*+"|'[^']*+')*+>"""


def macro_array(body: Column) -> Column:
    """(tag, inner, own) of every macro in order of open tags: all of its inside, and the inside without macros in it."""
    seen = _seen(F.coalesce(body, F.lit("")))

    def build(b: Column) -> Column:
        tags, texts = F.regexp_extract_all(b, F.lit(_MACRO_TAG), 0), F.split(b, _MACRO_TAG, -1)
        change = F.transform(tags, lambda t: F.when(t.startswith("</"), -1).when(t.endswith("/>"), 0).otherwise(1))
        depth = F.aggregate(change, F.array(F.lit(0)), lambda d, c: F.concat(d, F.array(F.element_at(d, -1) + c)))

        def with_depth(d: Column) -> Column:
            # text i stands before tag i, at depth d[i]
            def macro(t: Column, i: Column) -> Column:
                level = F.element_at(d, i + 2)
                rest = F.slice(d, i + 2, F.size(d))
                n = F.array_position(F.transform(rest, lambda x: x < level), F.lit(True)).cast("int")
                n = F.when(t.endswith("/>"), 0).when(n == 0, F.size(rest)).otherwise(n - 1)
                own_texts, own_tags, own_depth = F.slice(texts, i + 2, n), F.slice(tags, i + 2, n), F.slice(d, i + 2, n)
                whole = F.array_join(F.zip_with(own_texts, F.slice(own_tags, 1, F.greatest(n - 1, F.lit(0))), lambda x, y: F.concat(
                    F.coalesce(x, F.lit("")), F.coalesce(y, F.lit("")))), "")
                direct = F.array_join(F.transform(F.filter(F.arrays_zip(own_texts.alias("x"), own_depth.alias("d")),
                                                           lambda z: z.getField("d") == level), lambda z: z.getField("x")), "")
                return F.struct(t.alias("tag"), whole.alias("inner"), direct.alias("own"))

            return F.filter(F.transform(tags, lambda t, i: F.when(~t.startswith("</"), macro(t, i))), lambda m: m.isNotNull())

        return tx.let(depth, with_depth)

    return tx.let(seen, build)
