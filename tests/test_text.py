"""Text scalars (T1-T19, N1) against hand-derived expectations."""

import html

from pyspark.sql import functions as F

from marginalia.functions import text as tx
from marginalia.operators.navigation import is_empty_body


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v")).alias("r")).first()["r"]


def test_truncate_boundary(spark):
    assert one(spark, lambda c: tx.truncate(c, 5), "abcde") == "abcde"
    assert one(spark, lambda c: tx.truncate(c, 5), "abc  ef") == "abc…"
    assert one(spark, lambda c: tx.truncate(c, 5), "abcdef") == "abcd…"


def test_sanitize_name(spark):
    assert one(spark, tx.sanitize_name, "A/B:C*D?") == "A_B_C_D_"
    # strip -> "x . ."; trailing dots dropped -> "x . "; collapsed -> "x ."
    assert one(spark, tx.sanitize_name, "  x . . ") == "x ."
    assert one(spark, tx.sanitize_name, " ... ") == "untitled"
    assert one(spark, tx.sanitize_name, "a   b.") == "a b"


def test_unescape_matches_python(spark):
    for s in ["a &amp;lt; b", "&#233;&#x1F600;&copy;", "&bogus; & &&", "x&quot;y&apos;z", "&#0;"]:
        assert one(spark, tx.html_unescape, s) == html.unescape(s), s


def test_html_to_text(spark):
    v = "<p>Hello<br/>World</p><ul><li>One</li><li>Two</li></ul>&amp; done"
    assert one(spark, tx.html_to_text, v) == "Hello\nWorld\n\n - One\n- Two\n & done"


def test_preview_blank_is_null(spark):
    assert one(spark, tx.preview_text, "   \n ") is None
    assert one(spark, tx.preview_html, "<p> a </p>") == "a"


def test_join_inline(spark):
    df = spark.createDataFrame([(["Hello", "", "world", ",", "(", "x", ")", ":status[A]{color=grey}"],)], "a array<string>")
    assert df.select(tx.join_inline("a")).first()[0] == "Hello world, (x) :status[A]{color=grey}"


def test_status_colours(spark):
    assert one(spark, tx.status_colour_export, "Gray") == "grey"
    assert one(spark, tx.status_colour_export, " ") == "grey"
    assert one(spark, tx.status_colour_export, "Teal") == "teal"
    assert one(spark, tx.status_colour_import, "yellow") == "Yellow"
    assert one(spark, tx.status_colour_import, "Teal") == "Teal"


def test_attachment_link_quoting(spark):
    df = spark.createDataFrame([("https://x.example.com/", "42", "my chart~v1*.png")], "b string, p string, f string")
    r = df.select(tx.attachment_link("b", "p", "f")).first()[0]
    assert r == "https://x.example.com/download/attachments/42/my%20chart~v1%2A.png"


def test_is_empty_body(spark):
    cases = {"<!-- x -->": True, "&nbsp;": True, '<p class="a"></p>': False, "<p><br/></p>": True,
             "": True, "<p>x</p>": False}
    for body, expected in cases.items():
        assert one(spark, is_empty_body, body) is expected, body


def test_entities_as_the_standard_library_reads_them(spark):
    """Names without semicolon, longest known beginnings, HTML 5 names, numeric references of every kind."""
    import html
    cases = ["&copy 2020", "&notit;", "&ampamp;", "&notin;", "&amp", "&", "a & b", "&;", "&#65 x", "&#x41;&#X42", "&#150;", "&#0;",
             "&#x110000;", "&#55296;", "&#11;", "&#xFFFE;", "&CounterClockwiseContourIntegral;", "&nope;", "&lt&gt;", "&#;", "&#x;",
             "&hellip;&bull", "&frac12x", "&fjlig;", "&amp;lt;", "plain"]
    df = spark.createDataFrame([(c,) for c in cases], "c string")
    got = {r.c: r.u for r in df.select("c", tx.html_unescape("c").alias("u")).collect()}
    assert got == {c: html.unescape(c) for c in cases}
