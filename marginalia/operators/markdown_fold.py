"""Markdown block structure as one fold over a document's line array (M2-M7).

``aggregate`` reads the lines with a stack of open quotes and the block that
is open in the innermost of them (paragraph, fence, table, or a stack of
lists). A line first says how many quotes go on, then goes to the open block
or ends it, and may open further quotes and a block. So containers nest to
any depth in one pass, in the row: no window, no shuffle, no Python.

The fold writes pieces (markup around texts that are still plain); inline
markup of all texts is rendered afterwards by one expression.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as tx

# Markdown line grammar.
LIST_ITEM_RE = r"^(\s*)([-+*]|\d+\.)\s+(.*)$"
HEADING_RE = r"^(#{1,6})\s+(.*)$"
HR_RE = r"^ {0,3}([-*_])(?:\s*\1){2,}\s*$"
TABLE_SEP_RE = r"^\s*\|?(?:\s*:?-{3,}:?\s*\|)+\s*:?-{3,}:?\s*\|?\s*$"
CALLOUT_RE = r"(?i)^\[!(INFO|NOTE|TIP|WARNING|EXPAND)\](?:\s+(.*))?$"
_MARK_RE = rf"\G{tx.WS}*> ?"

_PIECE = "struct<pre:string,texts:array<string>,sep:string,post:string>"
_LIST = "struct<indent:int,ordered:boolean,open:boolean,bare:boolean>"
_TRACE = "struct<kind:string,block_no:int,start:boolean>"
# pieces so far; close tags of the open quotes; the open block with its lines, a fence's language or the open lists;
# number of top-level blocks; what each line was
_STATE = {"pieces": f"array<{_PIECE}>", "quotes": "array<string>", "mode": "string", "lines": "array<string>",
          "lang": "string", "lists": f"array<{_LIST}>", "n": "int", "trace": f"array<{_TRACE}>"}
_QUOTE_END, _CALLOUT_END = "</blockquote>", "</ac:rich-text-body></ac:structured-macro>"
_CALLOUT_BODY = "<ac:rich-text-body>"


def _none(kind: str) -> Column:
    return F.array().cast(kind)


def _with(s: Column, **fields: Column) -> Column:
    """The state with some fields set."""
    return F.struct(*[fields.get(f, s.getField(f)).alias(f) for f in _STATE])


def _let(x: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of ``x``, evaluated once. Neither is copied, as a transform would do with all pieces at each line."""
    return F.aggregate(_none("array<int>"), x, lambda same, _: same, fn)


def _piece(pre: Column | str, texts: Column | None = None, sep: str = "", post: Column | str = "") -> Column:
    as_column = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.array(F.struct(as_column(pre).alias("pre"), (_none("array<string>") if texts is None else texts).alias("texts"),
                            F.lit(sep).alias("sep"), as_column(post).alias("post"))).cast(f"array<{_PIECE}>")


def _added(s: Column, *pieces: Column) -> Column:
    return F.concat(s.getField("pieces"), *pieces)


def _last(items: Column) -> Column:
    return F.try_element_at(items, F.lit(-1))


def _first(items: Column, n: Column) -> Column:
    return F.slice(items, F.lit(1), n)


def _backwards(items: Column, after: Column, write: Callable[[Column], Column]) -> Column:
    """Texts of the items past position ``after``, the last first."""
    return F.array_join(F.transform(F.reverse(F.slice(items, after + 1, F.size(items) - after)), write), "")


def _ends(item: Column) -> Column:
    return F.concat(F.lit("</li></"), _tag(item), F.lit(">"))


def _tag(item: Column) -> Column:
    return F.when(item.getField("ordered"), F.lit("ol")).otherwise(F.lit("ul"))


# -- a line -------------------------------------------------------------------------------------------------------

def _line(line: Column) -> Column:
    marks = F.when(F.contains(line, F.lit(">")), F.regexp_extract_all(line, F.lit(_MARK_RE), 0)).otherwise(_none("array<string>"))
    return F.struct(line.alias("line"), marks.alias("marks"))


def _inside(line: Column, level: Column) -> Column:
    """The line within so many quotes."""
    marks = F.array_join(_first(line.getField("marks"), level), "")
    rest = F.substring(line.getField("line"), F.length(marks) + 1, F.length(line.getField("line")))
    return F.when(level == 0, line.getField("line")).otherwise(rest)


def _facts(e: Column, level: Column) -> Column:
    """What a line is within ``level`` quotes, whatever is open. Its text, stripped too, is bound: every fact reads it."""
    def of(t: Column, s: Column, item: Column) -> Column:
        rule = (s.startswith("-") | s.startswith("*") | s.startswith("_")) & s.rlike(HR_RE)
        return F.struct(
            t.alias("t"), s.alias("s"), (F.length(t) - F.length(F.ltrim(t, F.lit(" ")))).alias("indent"), item.alias("item"),
            (item & F.regexp_extract(t, LIST_ITEM_RE, 2).endswith(".")).alias("ordered"),
            F.when(item, tx.strip(F.regexp_extract(t, LIST_ITEM_RE, 3))).otherwise("").alias("said"),
            (s.startswith("#") & s.rlike(HEADING_RE)).alias("heading"), rule.alias("rule"), s.startswith("```").alias("fence"),
            _is_table(e, level, t).alias("table"), (F.size(e.getField("this").getField("marks")) > level).alias("quote"))
    return _let(_inside(e.getField("this"), level), lambda t: _let(tx.strip(t), lambda s: _let(
        t.rlike(LIST_ITEM_RE), lambda item: of(t, s, item))))


def _is_table(e: Column, level: Column, t: Column | None = None) -> Column:
    """A pipe, and a separator in the same quotes next; ``t``: the line within them, if it is known."""
    after = e.getField("next")
    return (F.contains(_inside(e.getField("this"), level) if t is None else t, F.lit("|"))
            & F.coalesce((F.size(after.getField("marks")) >= level)
                         & tx.strip(_inside(after, level)).rlike(TABLE_SEP_RE), F.lit(False)))


# -- the open block -----------------------------------------------------------------------------------------------

def _code(lines: Column, lang: Column, top: Column, mermaid_macro: str | None) -> Column:
    """M4: a code macro; a diagram macro for mermaid outside of quotes, if there is one."""
    code = F.replace(F.array_join(lines, "\n"), F.lit("]]>"), F.lit("]]]]><![CDATA[>"))
    plain = F.concat(F.lit("<ac:plain-text-body><![CDATA["), code, F.lit("]]></ac:plain-text-body></ac:structured-macro>"))
    head = F.concat(F.lit('<ac:structured-macro ac:name="code" ac:schema-version="1"><ac:parameter ac:name="language">'),
                    tx.html_escape(lang), F.lit('</ac:parameter><ac:parameter ac:name="theme">Default</ac:parameter>'))
    if mermaid_macro:
        diagram = F.concat(F.lit('<ac:structured-macro ac:name="'), tx.html_escape(F.lit(mermaid_macro)),
                           F.lit('" ac:schema-version="1">'))
        head = F.when(top & (F.lower(lang) == "mermaid"), diagram).otherwise(head)
    return F.concat(head, plain)


def _ended(s: Column, mermaid_macro: str | None) -> Column:
    """The state without an open block: what it held is written."""
    mode, lines = s.getField("mode"), s.getField("lines")
    piece = (F.when(mode == "text", _piece("<p>", F.array(F.array_join(lines, " ")), post="</p>"))
             .when(mode.isin("fence", "fenced"),
                   _piece(_code(lines, s.getField("lang"), F.size(s.getField("quotes")) == 0, mermaid_macro)))
             .when(mode == "table", _piece("</tbody></table>"))
             .when(mode == "list", _piece(_backwards(s.getField("lists"), F.lit(0), _ends)))
             .otherwise(_none(f"array<{_PIECE}>")))
    done = _with(s, pieces=_added(s, piece), mode=F.lit(""), lines=_none("array<string>"), lists=_none(f"array<{_LIST}>"))
    return F.when(mode == "", s).otherwise(done)


def _left(s: Column, level: Column) -> Column:
    """The state after the quotes past ``level`` have ended; a callout without a body gets an empty paragraph."""
    quotes = s.getField("quotes")
    bare = _last(s.getField("pieces")).getField("pre").endswith(_CALLOUT_BODY)
    closing = F.concat(F.when((_last(quotes) == _CALLOUT_END) & bare, "<p></p>").otherwise(""),
                       _backwards(quotes, level, lambda q: q))
    return F.when(F.size(quotes) > level, _with(s, pieces=_added(s, _piece(closing)), quotes=_first(quotes, level))).otherwise(s)


def _holds(s: Column, f: Column) -> Column:
    """How many of the open lists go on with this line."""
    lists, indent = s.getField("lists"), f.getField("indent")

    def takes(x: Column) -> Column:
        deeper, same = indent > x.getField("indent"), f.getField("ordered") == x.getField("ordered")
        item = (deeper & (x.getField("open") | same)) | ((indent == x.getField("indent")) & same)
        return (F.when(f.getField("s") == "", x.getField("open"))
                .when(f.getField("item"), item).otherwise(x.getField("open") & deeper))

    places = F.sequence(F.lit(1), F.greatest(F.size(lists), F.lit(1)))
    return F.coalesce(F.array_max(F.filter(places, lambda i: F.coalesce(takes(F.try_element_at(lists, i)), F.lit(False)))),
                      F.lit(0))


def _goes_on(s: Column, f: Column) -> Column:
    """Whether the line belongs to the open block."""
    blank = f.getField("s") == ""
    starts = f.getField("heading") | f.getField("fence") | f.getField("rule") | f.getField("table") | f.getField("item")
    mode = s.getField("mode")
    return (F.when(mode == "fence", F.lit(True)).when(mode == "table", ~blank & F.contains(f.getField("t"), F.lit("|")))
            .when(mode == "text", ~(blank | starts | f.getField("quote"))).when(mode == "list", _holds(s, f) > 0)
            .otherwise(F.lit(False)))


def _item(f: Column) -> Column:
    return F.struct(f.getField("indent").cast("int").alias("indent"), f.getField("ordered").alias("ordered"),
                    F.lit(True).alias("open"), (f.getField("said") == "").alias("bare"))


def _listed(s: Column, f: Column) -> Column:
    """M6: a line within a list: a blank line closes an item (an item may follow), deeper items nest, other lines go on."""
    def at(held: Column) -> Column:
        lists = s.getField("lists")
        own = F.element_at(lists, held)
        ends = _backwards(lists, held, _ends)
        outer = _first(lists, held - 1)
        now = lambda is_open, bare: F.array(F.struct(
            own.getField("indent").alias("indent"), own.getField("ordered").alias("ordered"), is_open.alias("open"),
            bare.alias("bare")))
        deeper = f.getField("indent") > own.getField("indent")
        nested = F.concat(outer, now(own.getField("open"), F.lit(False)), F.array(_item(f)))
        sibling = F.concat(outer, F.array(_item(f)))
        opened = F.when(deeper, F.concat(F.lit("<"), _tag(f), F.lit("><li>"))).otherwise(F.lit("</li><li>"))
        space = F.when(own.getField("bare"), "").otherwise(" ")
        return (F.when(f.getField("s") == "", _with(
                    s, pieces=_added(s, _piece(ends)), lists=F.concat(outer, now(F.lit(False), own.getField("bare")))))
                .when(f.getField("item"), _with(
                    s, pieces=_added(s, _piece(F.concat(ends, opened), F.array(f.getField("said")))),
                    lists=F.when(deeper, nested).otherwise(sibling)))
                .otherwise(_with(s, pieces=_added(s, _piece(F.concat(ends, space), F.array(f.getField("s")))),
                                 lists=F.concat(outer, now(F.lit(True), F.lit(False))))))
    return _let(_holds(s, f), at)


def _cells(line: Column) -> Column:
    s = tx.strip(line)
    s = F.regexp_replace(F.regexp_replace(s, r"^\|", ""), r"\|$", "")
    return F.transform(F.split(s, r"\|", -1), lambda c: tx.strip(c))


def _taken(s: Column, f: Column) -> Column:
    """The state after the open block has taken the line."""
    mode = s.getField("mode")
    row = F.when(f.getField("s").rlike(TABLE_SEP_RE), _none(f"array<{_PIECE}>")).otherwise(
        _piece("<tr><td>", _cells(f.getField("t")), "</td><td>", "</td></tr>"))
    held = F.concat(s.getField("lines"), F.array(F.when(mode == "fence", f.getField("t")).otherwise(f.getField("s"))))
    return (F.when((mode == "fence") & f.getField("fence"), _with(s, mode=F.lit("fenced")))
            .when(mode == "table", _with(s, pieces=_added(s, row))).when(mode == "list", _listed(s, f))
            .otherwise(_with(s, lines=held)))


# -- a line that starts something ---------------------------------------------------------------------------------

def _opened(s: Column, e: Column, level: Column, f: Column) -> Column:
    """The state after a line outside of any block within ``level`` quotes: quotes that it opens, then a block.

    ``f``: what the line is within these quotes, read again only if it opens more.
    """
    this = e.getField("this")
    n_marks = F.size(this.getField("marks"))

    def title(x: Column) -> Column:
        return tx.strip(_inside(this, x))

    # quotes open up to the first table or callout, or to the last mark
    stop = F.array_min(F.filter(F.sequence(level, F.greatest(n_marks, level)), lambda x: (x >= n_marks) | _is_table(e, x) | (
        (x > level) & title(x).rlike(CALLOUT_RE))))

    def deeper(upto: Column, said: Column) -> Column:
        n = upto - level
        callout = (n > 0) & said.rlike(CALLOUT_RE)
        name = F.lower(F.regexp_extract(said, CALLOUT_RE, 1))
        text = tx.strip(F.regexp_extract(said, CALLOUT_RE, 2))
        label = F.when(text != "", F.concat(F.lit('<ac:parameter ac:name="title">'), tx.html_escape(text, quote=False),
                                            F.lit("</ac:parameter>"))).otherwise("")
        plain = F.repeat(F.lit("<blockquote>"), n - callout.cast("int"))
        head = F.concat(plain, F.when(callout, F.concat(
            F.lit('<ac:structured-macro ac:name="'), name, F.lit('" ac:schema-version="1">'), label,
            F.lit(_CALLOUT_BODY))).otherwise(""))
        ends = F.concat(F.array_repeat(F.lit(_QUOTE_END), n - callout.cast("int")),
                        F.when(callout, F.array(F.lit(_CALLOUT_END))).otherwise(_none("array<string>")))
        q = F.when(n > 0, _with(s, pieces=_added(s, _piece(head)), quotes=F.concat(s.getField("quotes"), ends))).otherwise(s)
        return _let(q, lambda q: F.when(callout, q).otherwise(_let(_facts(e, upto), lambda f: _block(q, f))))

    return F.when(n_marks <= level, _block(s, f)).otherwise(_let(stop, lambda upto: F.when(upto == level, _block(s, f)).otherwise(
        _let(title(upto), lambda said: deeper(upto, said)))))


def _block(s: Column, f: Column) -> Column:
    line = f.getField("s")
    level = F.length(F.regexp_extract(line, HEADING_RE, 1)).cast("string")
    heading = _piece(F.concat(F.lit("<h"), level, F.lit(">")), F.array(tx.strip(F.regexp_extract(line, HEADING_RE, 2))),
                     post=F.concat(F.lit("</h"), level, F.lit(">")))
    lang = F.coalesce(F.nullif(tx.strip(F.substring(line, 4, 1 << 30)), F.lit("")), F.lit("none"))
    header = _piece("<table><tbody><tr><th>", _cells(f.getField("t")), "</th><th>", "</th></tr>")
    first = _piece(F.concat(F.lit("<"), _tag(f), F.lit("><li>")), F.array(f.getField("said")))
    return (F.when(line == "", s).when(f.getField("heading"), _with(s, pieces=_added(s, heading)))
            .when(f.getField("rule"), _with(s, pieces=_added(s, _piece("<hr />"))))
            .when(f.getField("fence"), _with(s, mode=F.lit("fence"), lang=lang))
            .when(f.getField("table"), _with(s, mode=F.lit("table"), pieces=_added(s, header)))
            .when(f.getField("item"), _with(s, mode=F.lit("list"), pieces=_added(s, first), lists=F.array(_item(f))))
            .otherwise(_with(s, mode=F.lit("text"), lines=F.array(line))))


def _kind(f: Column) -> Column:
    kinds = [("heading", "heading"), ("rule", "hr"), ("fence", "fence"), ("table", "table_start"), ("item", "item")]
    out = F.when(f.getField("s") == "", "blank")
    for flag, name in kinds:
        out = out.when(f.getField(flag), name)
    return out.otherwise("text")


def _traced(before: Column, s: Column, f: Column, on: Column) -> Column:
    """``s`` with what the line was at top level: its kind, the number of its block, whether the block starts here."""
    blank, mode = f.getField("s") == "", before.getField("mode")
    within = (F.when(mode == "fence", "code").when(blank, "blank").when(mode == "table", "table_row")
              .when(mode == "text", "text").when(f.getField("item"), "item").otherwise("cont"))
    quoted = F.size(s.getField("quotes")) > 0
    start = F.when(quoted, F.size(before.getField("quotes")) == 0).otherwise(~on & ~blank)
    kind = F.when(quoted, "quote").otherwise(F.when(on, within).otherwise(_kind(f)))
    n = s.getField("n") + start.cast("int")
    return _with(s, n=n, trace=F.concat(s.getField("trace"), F.array(F.struct(
        kind.alias("kind"), n.alias("block_no"), start.alias("start")))))


def fold(text: Column, mermaid_macro: str | None = None, trace: bool = False) -> Column:
    """State after all lines of ``text`` (frontmatter off, lines end with \\n): ``pieces`` and, if asked for, ``trace``."""
    start = F.struct(*[(F.lit("") if t == "string" else F.lit(0).cast(t) if t == "int" else _none(t)).alias(f)
                       for f, t in _STATE.items()])

    def step(s: Column, e: Column) -> Column:
        def read(level: Column, f: Column) -> Column:
            on = (level == F.size(s.getField("quotes"))) & _goes_on(s, f)

            def act(on: Column) -> Column:
                begun = _let(_ended(s, mermaid_macro), lambda x: _let(_left(x, level), lambda y: _opened(y, e, level, f)))
                after = F.when(on, _taken(s, f)).otherwise(begun)
                return _let(after, lambda x: _traced(s, x, f, on)) if trace else after
            return _let(on, act)

        held = F.least(F.size(s.getField("quotes")), F.size(e.getField("this").getField("marks")))
        return _let(held, lambda level: _let(_facts(e, level), lambda f: read(level, f)))

    def finish(s: Column) -> Column:
        return _let(_ended(s, mermaid_macro), lambda x: _left(x, F.lit(0)))

    def run(lines: Column) -> Column:
        pairs = F.transform(lines, lambda x, i: F.struct(x.alias("this"), F.get(lines, i + 1).alias("next")))
        return F.aggregate(pairs, start, step, finish)

    return _let(F.transform(F.split(text, "\n", -1), lambda x: _line(x)), run)


def write(pieces: Column, inline: Callable[[Column], Column]) -> Column:
    """The markup of all pieces, with the inline markup of their texts."""
    def one(p: Column) -> Column:
        texts = F.call_function("array_join", F.transform(p.getField("texts"), inline), p.getField("sep"))
        return F.concat(p.getField("pre"), texts, p.getField("post"))

    return F.array_join(F.transform(pieces, one), "")
