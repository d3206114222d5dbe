"""Section edits in bulk.

A section is a top-level heading plus the top-level elements after it, up to
the next heading whose level is <= its own. Top-level elements are found by
one pattern, or one fold over the row's tokens, so sections are an array of the row: pages meet
their edits in one join by page, and several edits of a page are folded in
``seq`` order over the elements that each leaves. Untouched markup is kept as
written; only the section is spliced. As in the reference, text right after a heading
belongs to the heading, and loose text before the first element of a page or
of a replacement is dropped on write.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from .markup_fold import _ATTRIBUTES, _TAG, _UNSEEN, _decode, _seen, is_well_formed

# Error texts of the reference.
PARSE_ERROR = "Failed to parse Confluence storage HTML fragment."


def top_elements(body: Column) -> Column:
    """(level, start, end) of the top-level elements, 0-based; level 0 for all but headings."""
    toks = F.regexp_extract_all(body, F.lit(rf"{_UNSEEN}|{_TAG}|[^<]+|<"), 0)
    element = "array<struct<level:int,start:int,end:int>>"
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("off"), F.array().cast(element).alias("els"))

    def step(s: Column, t: Column) -> Column:
        depth, off, els = (s.getField(n) for n in ("depth", "off", "els"))
        after = off + F.length(t)
        tag = t.startswith("<") & ~t.startswith("<!") & ~t.startswith("<?") & (F.length(t) > 1)
        closing, alone = t.startswith("</"), t.endswith("/>")
        level = F.coalesce(F.regexp_extract(t, r"^<h([1-6])[\s/>]", 1).try_cast("int"), F.lit(0))
        opened = F.concat(els, F.array(F.struct(level.alias("level"), off.alias("start"), after.alias("end"))))
        last = F.element_at(els, -1)
        closed = F.concat(F.slice(els, 1, F.size(els) - 1), F.array(F.struct(
            last.getField("level").alias("level"), last.getField("start").alias("start"), after.alias("end"))))
        return F.struct(
            (depth + F.when(~tag | alone, 0).when(closing, -1).otherwise(1)).alias("depth"), after.alias("off"),
            F.when(tag & ~closing & (depth == 0), opened).when(tag & closing & (depth == 1), closed).otherwise(els).alias("els"))

    return F.aggregate(toks, start, step, lambda s: s.getField("els"))


def section_array(body: Column) -> Column:
    """E1 in the row: (heading_no, level, heading_text, h_start, h_end, sec_start, sec_end, first) of each top-level heading.

    Offsets are 0-based; [h_end, sec_start) is the heading's tail, [sec_start, sec_end)
    the section, ``first`` where the first element of the page starts.
    """
    def build(els: Column) -> Column:
        def heading(e: Column, i: Column) -> Column:
            level, a, b = (e.getField(n) for n in ("level", "start", "end"))
            rest = F.slice(els, i + 2, F.size(els))
            up = F.filter(rest, lambda x: (x.getField("level") > 0) & (x.getField("level") <= level))
            element = F.substring(body, a + 1, b - a)
            text = tx.normalize_heading(_decode(F.regexp_replace(_seen(element), _TAG, "")))
            end = F.length(body)
            return F.struct(i.alias("heading_no"), level.alias("level"), text.alias("heading_text"), a.alias("h_start"),
                            b.alias("h_end"), F.coalesce(F.try_element_at(rest, F.lit(1)).getField("start"), end).alias("sec_start"),
                            F.coalesce(F.try_element_at(up, F.lit(1)).getField("start"), end).alias("sec_end"),
                            F.element_at(els, 1).getField("start").alias("first"))

        found = F.transform(els, lambda e, i: F.when(e.getField("level") > 0, heading(e, i)))
        return F.filter(found, lambda h: h.isNotNull())

    return tx.let(top_elements(body), build)


def sections(pages: DataFrame, id_col: str = "page_id", body_col: str = "body") -> DataFrame:
    """``(page_id, heading_no, level, heading_text, h_start, h_end, sec_start, sec_end)`` of top-level headings."""
    found = pages.select(F.col(id_col).alias("page_id"), F.explode(section_array(F.coalesce(F.col(body_col), F.lit("")))).alias("s"))
    return found.select("page_id", "s.*").drop("first")


def match_sections(edits: DataFrame, secs: DataFrame) -> DataFrame:
    """Per edit ``(seq, page_id, heading, match_count, status)``;
    exact whitespace-normalized, case-sensitive heading match."""
    e = edits.withColumn("target", tx.normalize_heading(F.col("heading")))
    m = e.join(secs, (e["page_id"] == secs["page_id"]) & (e["target"] == secs["heading_text"]), "left") \
        .drop(secs["page_id"])
    g = m.groupBy("seq", "page_id", "heading").agg(F.count("heading_text").alias("match_count"))
    return g.withColumn("status", F.when(F.col("match_count") == 0, "not_found")
                        .when(F.col("match_count") > 1, "ambiguous").otherwise("ok"))


# An element up to the first close tag of its name, with the text after it.
_ELEMENT = rf"<([^\s/>!?][^\s/>]*+){_ATTRIBUTES}(?:/>|>(?s:.*?)</\1\s*>)[^<]*"
_PIECES = "array<struct<level:int,heading:string,text:string>>"


def pieces_of(body: Column) -> Column:
    """(level, heading, text) of the top-level elements of a well-formed body, each with the text after it; level 0 for all but
    headings. Together the texts are the body from its first element on.

    One pattern finds them where no element holds another of its own name, which shows in that nothing is left over; other
    bodies are folded.
    """
    def piece(element: Column, text: Column) -> Column:
        level = F.when(text.startswith("<h"), F.coalesce(F.regexp_extract(text, r"^<h([1-6])[\s/>]", 1).try_cast("int"), F.lit(0)))
        return tx.let(F.coalesce(level, F.lit(0)), lambda n: F.struct(n.alias("level"), F.when(n > 0, tx.normalize_heading(
            _decode(F.regexp_replace(_seen(element), _TAG, "")))).alias("heading"), text.alias("text")))

    def whole(b: Column) -> Column:
        def found(texts: Column) -> Column:
            covered = F.length(F.array_join(texts, "")) == F.length(b) - F.instr(b, "<") + 1
            plain = F.transform(texts, lambda t: piece(F.regexp_extract(t, r"(?s)\A.*</[^<>]*>", 0), t)).cast(_PIECES)
            return F.when(covered, plain).otherwise(tx.let(top_elements(b), folded))

        def folded(els: Column) -> Column:
            def one(e: Column, i: Column) -> Column:
                start, end = e.getField("start"), F.coalesce(F.get(els, i + 1).getField("start"), F.length(b))
                return piece(F.substring(b, start + 1, e.getField("end") - start), F.substring(b, start + 1, end - start))
            return F.transform(els, one).cast(_PIECES)

        unseen = F.contains(b, F.lit("<!")) | F.contains(b, F.lit("<?"))
        return F.when(unseen, tx.let(top_elements(b), folded)).otherwise(
            tx.let(F.regexp_extract_all(b, F.lit(_ELEMENT), 0), found))

    return tx.let(body, whole)


def _text(some: Column) -> Column:
    return F.array_join(F.transform(some, lambda p: p.getField("text")), "")


def _target(found: Column, target: Column) -> Column:
    """``(status, at, upto)`` of a heading: its place and where its section ends (1-based, null unless ok)."""
    places = F.filter(F.sequence(F.lit(1), F.greatest(F.size(found), F.lit(1))),
                      lambda i: F.try_element_at(found, i).getField("heading") == target)

    def ends(at: Column) -> Column:
        level = F.element_at(found, at).getField("level")
        after = F.filter(F.sequence(at, F.size(found)), lambda i: (i > at) & tx.let(
            F.element_at(found, i).getField("level"), lambda n: (n > 0) & (n <= level)))
        return F.struct(F.lit("ok").alias("status"), at.alias("at"), F.coalesce(F.get(after, F.lit(0)), F.size(found) + 1).alias("upto"))

    def outcome(status: str) -> Column:
        return F.struct(F.lit(status).alias("status"), F.lit(None).cast("int").alias("at"), F.lit(None).cast("int").alias("upto"))

    return tx.let(places, lambda x: F.when(F.size(x) == 0, outcome("not_found")).when(F.size(x) > 1, outcome("ambiguous")).otherwise(
        ends(F.element_at(x, 1))))


def _replacement(html: Column) -> Column:
    """The pieces of a replacement, null if it doesn't parse; space at the end is dropped."""
    return tx.let(html, lambda h: F.when(is_well_formed(h), _stripped(pieces_of(h))))


def _stripped(found: Column) -> Column:
    """Pieces without space at their end."""
    def cut(x: Column) -> Column:
        last = F.element_at(x, -1)
        end = F.struct(last.getField("level").alias("level"), last.getField("heading").alias("heading"),
                       tx.rstrip(last.getField("text")).alias("text"))
        return F.when(F.size(x) == 0, x).otherwise(F.concat(F.slice(x, 1, F.size(x) - 1), F.array(end)))
    return tx.let(found, cut)


def _edited(found: Column, target: Column, new: Column) -> Column:
    """E2 + E3 of one edit of a page's pieces (null: malformed) by those of a replacement (null: malformed): status, level, old
    section and next pieces (all but the status null unless ok)."""
    def outcome(status: Column, *values: Column) -> Column:
        names, kinds = ("level", "old", "next"), ("int", "string", _PIECES)
        return F.struct(status.alias("status"), *[v.cast(k).alias(n) for n, k, v in zip(
            names, kinds, values or (F.lit(None),) * len(names))])

    def splice(t: Column) -> Column:
        at, upto = t.getField("at"), t.getField("upto")
        old = tx.strip(_text(F.slice(found, at + 1, upto - at - 1)))
        following = _stripped(F.concat(F.slice(found, F.lit(1), at), new, F.slice(found, upto, F.size(found) - upto + 1)))
        return outcome(F.lit("ok"), F.element_at(found, at).getField("level"), old, following)

    def choose(t: Column) -> Column:
        return F.when(t.getField("status") != "ok", outcome(t.getField("status"))).when(
            new.isNull(), outcome(F.lit("malformed"))).otherwise(splice(t))

    return F.when(found.isNull(), outcome(F.lit("malformed"))).otherwise(
        tx.let(_target(found, target), choose))


def _error(status: Column, heading: Column) -> Column:
    named = F.concat(F.lit('replace-section target heading "'), heading, F.lit('"'))
    return (F.when(status == "not_found", F.concat(named, F.lit(" was not found.")))
            .when(status == "ambiguous", F.concat(named, F.lit(" is ambiguous because it appears multiple times.")))
            .when(status == "malformed", F.lit(PARSE_ERROR))
            .when(status == "no_page", F.lit("Page not found.")))


def replace_sections(pages: DataFrame, edits: DataFrame, id_col: str = "page_id", body_col: str = "body") -> DataFrame:
    """E3 + B3: keep the heading, swap its section; every edit on the page as it is now.

    Returns per edit: status (ok, not_found, ambiguous, malformed, no_page), error, matched heading and level, old and new
    section html, updated body and the three B3 previews. A page or replacement that doesn't parse is an error row.
    """
    body = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(body_col), F.lit("")).alias("__body"))
    j = edits.select("seq", "page_id", "heading", F.coalesce("replacement_html", F.lit("")).alias("__new")).join(body, "page_id", "left")
    read = j.select("seq", "page_id", "heading", F.col("__body").isNotNull().alias("__page"),
                    F.when(is_well_formed(F.col("__body")), pieces_of(F.col("__body"))).alias("__pieces"),
                    tx.normalize_heading("heading").alias("__target"), _replacement(F.col("__new")).alias("__new"))
    done = F.when(F.col("__page"), tx.let(F.col("__target"), lambda t: _edited(F.col("__pieces"), t, F.col("__new"))))
    r = read.select("seq", "page_id", "heading", done.alias("r"), tx.strip(_text(F.col("__new"))).alias("__new"))
    ok = F.col("r.status") == "ok"
    r = r.select("seq", "page_id", "heading", F.coalesce("r.status", F.lit("no_page")).alias("status"), F.col("r.level").alias("level"),
                 F.when(ok, tx.normalize_heading("heading")).alias("matched"), F.col("r.old").alias("old"),
                 F.when(ok, F.col("__new")).alias("new"), F.when(ok, tx.strip(_text(F.col("r.next")))).alias("body"))
    return r.select(
        "seq", "page_id", "heading", "status", _error(F.col("status"), F.col("heading")).alias("error"),
        F.col("matched").alias("matched_heading"), F.col("level").alias("heading_level"),
        F.col("old").alias("old_section_html"), F.col("new").alias("new_section_html"),
        F.col("body").alias("updated_body_html"), tx.preview_html("old").alias("old_section_preview"),
        tx.preview_html("new").alias("new_section_preview"), tx.preview_html("body").alias("resulting_body_preview"))


def fold_section_edits(pages: DataFrame, edits: DataFrame, id_col: str = "page_id", body_col: str = "body") -> DataFrame:
    """E3 with several edits per page: ``(page_id, body, results)`` of every page, and of edits without a page (body null).

    A page and each replacement are parsed once, in their own rows, to pieces. A page's edits (seq, heading, replacement_html
    and its pieces) come as an array and are folded in ``seq`` order, each on the pieces that the one before left, so headings
    that an edit brings or removes count for the next. ``results`` holds seq, heading, status, error, matched_heading,
    heading_level, old_section_html, new_section_html of each. The array holds the change set's fragments of one page, never
    bodies.
    """
    html = F.coalesce("replacement_html", F.lit(""))
    own = edits.select("page_id", "seq", "heading", html.alias("new"), tx.normalize_heading("heading").alias("target"),
                       _replacement(html).alias("parts"))
    own = own.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("seq", "heading", "new", "target", "parts"))).alias("edits"))
    body = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(body_col), F.lit("")).alias("body"))
    body = body.select("page_id", "body", F.when(is_well_formed(F.col("body")), pieces_of(F.col("body"))).alias("found"))
    j = body.join(own, "page_id", "full").withColumn("edits", F.coalesce(
        "edits", F.array().cast(own.schema["edits"].dataType)))
    # a namespace that a section declares counts for the whole page, and goes with it
    declares = F.contains("body", F.lit("xmlns:")) | F.exists("edits", lambda e: F.contains(e.getField("new"), F.lit("xmlns:")))
    slim = "array<struct<status:string,level:int,old:string>>"

    def step(s: Column, e: Column) -> Column:
        found = s.getField("found")

        def put(r: Column) -> Column:
            g = r.getField
            ok = g("status") == "ok"
            parses = F.when(ok & s.getField("declares"), is_well_formed(_text(g("next")))).otherwise(s.getField("parses"))
            return F.struct(F.when(ok, g("next")).otherwise(found).alias("found"), s.getField("declares").alias("declares"), parses.alias("parses"),
                            (s.getField("changed") | ok).alias("changed"), F.concat(s.getField("done"), F.array(F.struct(
                                g("status").alias("status"), g("level").alias("level"), g("old").alias("old")))).alias("done"))

        return tx.let(_edited(F.when(s.getField("parses"), found), e.getField("target"), e.getField("parts")), put)

    start = F.struct(F.col("found").alias("found"), declares.alias("declares"), F.lit(True).alias("parses"), F.lit(False).alias("changed"),
                     F.array().cast(slim).alias("done"))
    unread = F.transform("edits", lambda e: F.struct(
        F.when(F.col("body").isNull(), "no_page").otherwise("malformed").alias("status"), F.lit(None).cast("int").alias("level"),
        F.lit(None).cast("string").alias("old")))
    unfolded = F.struct(F.col("found").alias("found"), F.lit(False).alias("declares"), F.lit(True).alias("parses"), F.lit(False).alias("changed"),
                        unread.cast(slim).alias("done"))
    folded = j.select("page_id", "body", "edits", F.when(
        F.col("found").isNull() | (F.size("edits") == 0), unfolded).otherwise(F.aggregate("edits", start, step)).alias("s"))

    def result(e: Column, r: Column) -> Column:
        status = r.getField("status")
        given = lambda c: F.when(status == "ok", c)
        return F.struct(
            e.getField("seq").cast("bigint").alias("seq"), e.getField("heading").alias("heading"), status.alias("status"),
            _error(status, e.getField("heading")).alias("error"), given(e.getField("target")).alias("matched_heading"),
            r.getField("level").alias("heading_level"), r.getField("old").alias("old_section_html"),
            given(_text(e.getField("parts"))).alias("new_section_html"))

    return folded.select("page_id", F.when(F.col("s.changed"), tx.strip(_text(F.col("s.found")))).otherwise(F.col("body")).alias("body"),
                         F.zip_with("edits", "s.done", result).alias("results"))


def replace_sections_folded(pages: DataFrame, edits: DataFrame, id_col: str = "page_id",
                            body_col: str = "body") -> tuple[DataFrame, DataFrame]:
    """``(results, next bodies)`` of ``fold_section_edits``."""
    folded = fold_section_edits(pages, edits, id_col, body_col)
    # a plain explode is guarded by a filter on its array's size, which folds all edits once more
    return (folded.select("page_id", F.explode_outer("results").alias("r")).where("r is not null").select("page_id", "r.*"),
            folded.where(F.col("body").isNotNull()).select("page_id", "body"))
