"""Containers of any depth: documents built together with the markup they must give."""

import random

from pyspark.sql import functions as F

from marginalia.operators import markdown as md


def _html(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    return [r.html for r in md.import_markdown(df).orderBy("doc_id").collect()]


def _list(rng, indent, depth):
    """Lines and markup of lists at one indent, all within one parent item."""
    lines, html = [], ""
    for ordered in rng.choice([[False], [True], [False, True]]):
        tag, items = "ol" if ordered else "ul", ""
        for n in range(rng.randint(1, 3)):
            word = f"w{rng.randint(0, 99)}"
            lines.append(" " * indent + ("1. " if ordered else "- ") + word)
            inner = ""
            if rng.random() < 0.3:
                lines.append(" " * (indent + 2) + "more")
                word += " more"
            if depth and rng.random() < 0.5:
                sub, inner = _list(rng, indent + rng.randint(1, 4), depth - 1)
                lines += sub
            items += f"<li>{word}{inner}</li>"
        html += f"<{tag}>{items}</{tag}>"
    return lines, html


def _blocks(rng, depth):
    lines, html = [], ""
    for _ in range(rng.randint(1, 4)):
        kind = rng.choice(["p", "h", "list", "code", "table", "quote", "quote", "callout", "hr"])
        word = f"w{rng.randint(0, 99)}"
        if kind == "p":
            own, out = [word, f"and *{word}*"], f"<p>{word} and <em>{word}</em></p>"
        elif kind == "h":
            own, out = [f"## {word}"], f"<h2>{word}</h2>"
        elif kind == "hr":
            own, out = ["---"], "<hr />"
        elif kind == "list":
            own, out = _list(rng, 0, 3)
            own = own + [""] * 6  # each open list takes one
        elif kind == "code":
            own = ["```py", "> not a quote", "", "- no item", "```"]
            out = ('<ac:structured-macro ac:name="code" ac:schema-version="1"><ac:parameter ac:name="language">py'
                   '</ac:parameter><ac:parameter ac:name="theme">Default</ac:parameter><ac:plain-text-body><![CDATA['
                   + "\n".join(own[1:-1]) + "]]></ac:plain-text-body></ac:structured-macro>")
        elif kind == "table":
            own = [f"| {word} | b |", "|---|---|", "| 1 | **2** |"]
            out = (f"<table><tbody><tr><th>{word}</th><th>b</th></tr><tr><td>1</td><td><strong>2</strong></td></tr>"
                   "</tbody></table>")
        else:
            sub, inner = _blocks(rng, depth - 1) if depth > 0 else (["deep"], "<p>deep</p>")
            if kind == "quote":
                out = f"<blockquote>{inner}</blockquote>"
            else:
                sub = [f"[!Warning] {word} & co"] + sub
                out = (f'<ac:structured-macro ac:name="warning" ac:schema-version="1"><ac:parameter ac:name="title">{word} &amp; co'
                       f"</ac:parameter><ac:rich-text-body>{inner}</ac:rich-text-body></ac:structured-macro>")
            own = [rng.choice(["> ", "  > "]) + line if line or rng.random() < 0.5 else ">" for line in sub]
        lines += own + [""]
        html += out
    return lines, html


def test_random_containers(spark):
    made = [_blocks(random.Random(seed), 7) for seed in range(150)]
    got = _html(spark, *["\n" + "\n".join(lines) for lines, _ in made])  # a rule in the first line were frontmatter
    for (lines, want), html in zip(made, got):
        assert html == want, "\n".join(lines)


def test_blank_lines_and_types_of_lists(spark):
    assert _html(spark, "- a\n  - b\n  1. c", "- a\n\n- b\n\n\n- c", "- a\n  - b\n\n  - c\n\n  text", "- a\n\n  1. b", "-  \n  x") == [
        "<ul><li>a<ul><li>b</li></ul><ol><li>c</li></ol></li></ul>",
        "<ul><li>a</li><li>b</li></ul><ul><li>c</li></ul>",
        "<ul><li>a<ul><li>b</li><li>c</li></ul> text</li></ul>",
        "<ul><li>a</li></ul><ol><li>b</li></ol>",
        "<ul><li>x</li></ul>"]


def test_quotes_end_what_they_hold(spark):
    assert _html(spark, "> a\nb", "> ```\n> x\ny", "> | a | b\n> |--|--\n> |---|---|\nend", "> - a\n> > b\n- c",
                 "> a | b\n|---|---|\n> c | d", "> [!expand]", "> [!other] x") == [
        "<blockquote><p>a</p></blockquote><p>b</p>",
        '<blockquote><ac:structured-macro ac:name="code" ac:schema-version="1"><ac:parameter ac:name="language">none</ac:parameter>'
        '<ac:parameter ac:name="theme">Default</ac:parameter><ac:plain-text-body><![CDATA[x]]></ac:plain-text-body>'
        "</ac:structured-macro></blockquote><p>y</p>",
        "<blockquote><p>| a | b</p><table><tbody><tr><th>--</th><th>--</th></tr></tbody></table></blockquote><p>end</p>",
        "<blockquote><ul><li>a</li></ul><blockquote><p>b</p></blockquote></blockquote><ul><li>c</li></ul>",
        "<table><tbody><tr><th>&gt; a</th><th>b</th></tr><tr><td>&gt; c</td><td>d</td></tr></tbody></table>",
        '<ac:structured-macro ac:name="expand" ac:schema-version="1"><ac:rich-text-body><p></p></ac:rich-text-body>'
        "</ac:structured-macro>",
        "<blockquote><p>[!other] x</p></blockquote>"]


def test_empty_long_and_repeated(spark):
    deep = "".join("> " * (i + 1) + f"{i}\n" for i in range(40))
    long = "\n".join(f"- item {i}" for i in range(5000))
    got = _html(spark, None, "", deep, long, long)
    assert got[:2] == ["", ""]
    assert got[2] == "".join(f"<blockquote><p>{i}</p>" for i in range(40)) + "</blockquote>" * 40
    assert got[3] == got[4] == "<ul>" + "".join(f"<li>item {i}</li>" for i in range(5000)) + "</ul>"


def test_plan_and_links(spark):
    docs = spark.createDataFrame([(1, "---\nx: [[Secret]]\n---\n[[A]]\n```\n[[B]]\n```\n> [[C|c]]")], "doc_id int, text string")
    plan = md.import_markdown(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan
    assert [r.target for r in md.link_targets(docs).orderBy("token_no").collect()] == ["A", "C"]
    kinds = md.classify_lines(docs).orderBy("ln").agg(F.collect_list("kind")).first()[0]
    assert kinds == ["text", "fence", "code", "code", "quote"]
