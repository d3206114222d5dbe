"""Storage markup -> Markdown (D2-D19): whole outputs for small bodies of our own."""

import pytest

from marginalia.operators import storage_md as sm

BASE = "https://wiki.example.org"


def macro(name, body="", **parameters):
    given = "".join(f'<ac:parameter ac:name="{k}">{v}</ac:parameter>' for k, v in parameters.items())
    rich = f"<ac:rich-text-body>{body}</ac:rich-text-body>" if body else ""
    return f'<ac:structured-macro ac:name="{name}">{given}{rich}</ac:structured-macro>'


def image(name):
    return f'<ac:image><ri:attachment ri:filename="{name}" /></ac:image>'


def rows(*lines):
    return "<table><tbody>" + "".join("<tr>" + "".join(line) + "</tr>" for line in lines) + "</tbody></table>"


def th(*cells):
    return [f"<th>{c}</th>" for c in cells]


def td(*cells):
    return [f"<td>{c}</td>" for c in cells]


CASES = {
    "heading_and_list": ("<h3>River levels</h3><p>Gauge <strong>seven</strong> rose</p><ul><li>north bank</li>"
                         "<li>south bank</li></ul>",
                         "### River levels\n\nGauge **seven** rose\n\n- north bank\n- south bank\n"),
    "plain_table": (rows(th("Boat", "Crew"), td("Heron", "4"), td("a|b", "")),
                    "| Boat | Crew |\n| --- | --- |\n| Heron | 4 |\n| a\\|b |  |\n"),
    "key_table": (rows(th("Item", "Description", "Owner"),
                       td("Lock gate", "<p>Opens at dawn</p><ul><li>east</li></ul>", "Mara")),
                  "#### Lock gate\n\nOpens at dawn\n\n- east\n\n**Owner:** Mara\n"),
    "inline_image": (f"<p>Chart below{image('tide.png')}</p>",
                     f"Chart below\n\n![tide.png]({BASE}/download/attachments/inline_image/tide.png)\n"),
    "callout": (macro("tip", "<p>Use two ropes.</p><p>Check at noon.</p>", title="Mooring"),
                "> [!TIP] Mooring\n> Use two ropes.\n>\n> Check at noon.\n"),
    "status": (f"<p>Lock is {macro('status', colour='Red', title='Shut')}</p>", "Lock is :status[Shut]{color=red}\n"),
    "emphasis_in_emphasis": ("<p><em>slow <strong>water</strong></em> ahead</p>", "slow water ahead\n"),
    "mixed_lists": ("<ol><li>cast off<ul><li>bow</li><li>stern</li></ul></li><li>steer</li></ol>",
                    "1. cast off\n    - bow\n    - stern\n2. steer\n"),
    "link_with_emphasis": ('<p>Read <a href="https://tides.example.org/a">the <em>tide</em> table</a>, then go.</p>',
                           "Read [the *tide* table](https://tides.example.org/a), then go.\n"),
    "callout_in_callout": (macro("info", "<p>a</p>" + macro("tip", "<p>b</p>", title="Inner"), title="Outer"),
                           "> [!INFO] Outer\n> a\n>\n> > [!TIP] Inner\n> > b\n"),
    "expand_with_list": (macro("expand", "<ul><li>oar</li></ul>", title="More"), "> [!EXPAND] More\n> - oar\n"),
    "five_lists": ("<ul><li>1<ol><li>2<ul><li>3<ol><li>4<ul><li>5</li></ul></li></ol></li></ul></li></ol></li></ul>",
                   "- 1\n    1. 2\n        - 3\n        1. 4\n        - 5\n"),
    "table_in_item": ("<ul><li>x" + rows(th("A", "B"), td("1", "2")) + "</li><li>y</li></ul>",
                      "- x\n| A | B |\n| --- | --- |\n| 1 | 2 |\n- y\n"),
    "table_in_cell": (rows(th("A"), td(rows(th("B"), td("2")))),
                      "| A |\n| --- |\n| \\| B \\|<br>\\| --- \\|<br>\\| 2 \\| |\n"),
    "korean_key_table": (rows(th("항목", "설명"), td("닻", "무겁다")), "#### 닻\n\n무겁다\n"),
    "status_in_cell": (rows(th("A"), td(macro("status", title="S", colour="Red") + " now")),
                       "| A |\n| --- |\n| :status[S]{color=red} now |\n"),
    "list_in_paragraph": ("<p>a<ul><li>b</li><li>c</li></ul>d</p>", "a\n- b\n - c\nd\n"),
    "encoded_pipe": (rows(th("A"), td("x&#124;y")), "| A |\n| --- |\n| x\\|y |\n"),
    "quote_in_file_name": ('<ac:image><ri:attachment ri:filename="John\'s a &amp; b.png"/></ac:image>',
                           f"![John's a & b.png]({BASE}/download/attachments/quote_in_file_name/John%27s%20a%20%26%20b.png)\n"),
    "loose_text": ("lost<p>a</p> tail <p>b</p>", "a\n\ntail\nb\n"),
    "inline_macro": ("<p>a " + macro("jira", key="X-1") + " b</p>", "a b\n"),
    "angle_in_attribute": ('<p>see <a href="x" title="a > b">t</a></p>', "see [t](x)\n"),
    "preformatted": ("<pre>\na &amp; b\n  c\n</pre>", "```\na & b\n  c\n```\n"),
    "cdata_and_comment": ("<p>a <![CDATA[<b> & c]]><!-- no --> d</p>", "a <b> & c d\n"),
    "unknown_macro": (macro("panel", "<p>in</p>") + "<p>out</p>", "in\n\nout\n"),
    "nothing": ("", "\n"),
}


@pytest.fixture(scope="module")
def rendered(spark):
    bodies = spark.createDataFrame([(k, body) for k, (body, _) in CASES.items()], "page_id string, body string")
    return {r.page_id: r.markdown for r in sm.render_markdown(bodies, BASE, "chart").collect()}


@pytest.mark.parametrize("name", sorted(CASES))
def test_whole_output(rendered, name):
    assert rendered[name] == CASES[name][1]


def test_diagram_macro_needs_its_name(spark):
    body = ('<ac:structured-macro ac:name="chart"><ac:plain-text-body><![CDATA[pie\n"a": 1]]></ac:plain-text-body>'
            "</ac:structured-macro>")
    bodies = spark.createDataFrame([("1", body)], "page_id string, body string")
    assert sm.render_markdown(bodies, BASE, "chart").first().markdown.strip() == '```mermaid\npie\n"a": 1\n```'
    assert sm.render_markdown(bodies, BASE, None).first().markdown.strip() == ""


def test_repeated_page_ids_keep_their_rows(spark):
    bodies = spark.createDataFrame([("1", "<p>a</p>"), ("1", "<p>b</p>"), ("2", None)], "page_id string, body string")
    assert sorted(r.markdown for r in sm.render_markdown(bodies, BASE).collect()) == ["\n", "a\n", "b\n"]


def test_rendering_and_checks_need_no_shuffle(spark):
    from marginalia.operators import markup as mk
    pages = spark.createDataFrame([("1", "<p>a</p>", "T")], "page_id string, body string, title string")
    for df in (sm.render_markdown(pages, BASE), sm.table_cells(pages), mk.well_formed(pages), mk.macros(pages)):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
