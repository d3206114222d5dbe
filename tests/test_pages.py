"""Pages: summaries, tree, freshness, sections, change sets, batches."""

import collections
import hashlib
import os

from pyspark.sql import functions as F

from marginalia.operators import changes as ch
from marginalia.operators import freshness as fr
from marginalia.operators import sections as se
from marginalia.operators import summaries as sm
from marginalia.operators import tree as tr
from marginalia.sources.readers import merge_offset_batches
from marginalia.sources.schemas import ISSUE_DDL, struct_type


def test_recent_comments_slice(spark):
    issue = {"id": "1", "key": "TEST-9", "fields": {"comment": {"total": None, "comments": [
        {"id": "1001", "body": "a"}, {"id": "1002", "body": "b"}]}}}
    df = spark.createDataFrame([issue], struct_type(ISSUE_DDL))
    assert [c.id for c in sm.recent_comments(df, 1).first().recent_comments] == ["1002"]
    assert [c.id for c in sm.recent_comments(df, 3).first().recent_comments] == ["1001", "1002"]
    assert [c.id for c in sm.recent_comments(df, 0).first().recent_comments] == ["1001", "1002"]
    assert sm.recent_comments(df, 1).first().comment_count == 2


def test_merge_fields():
    assert sm.merge_fields(None, ["summary", "status"]) == "summary,status"
    assert sm.merge_fields(" comment ,summary", ["summary"]) == "comment,summary"
    assert sm.merge_fields("", []) is None


def test_tree_paths_and_cycle_guard(spark):
    nodes = spark.createDataFrame([("1", "Root Page", "u1"), ("2", "Child Page", "u2"), ("3", "A/B", None)],
                                  "id string, title string, webui_url string")
    edges = spark.createDataFrame([("1", 1, "2"), ("2", 1, "3"), ("3", 1, "1")],
                                  "parent_id string, ordinal long, id string")
    t = {r.page_id: r for r in tr.export_tree(nodes, edges, "1", "out").collect()}
    assert t["1"].output_file == "out/Root Page/index.md"
    assert t["2"].output_file == "out/Root Page/Child Page/index.md" and t["2"].parent_page_id == "1"
    assert t["3"].output_file == "out/Root Page/Child Page/A_B/index.md"
    assert len(t) == 3


def test_deep_chain_takes_log_rounds(spark):
    """A chain of 5,000 pages is complete after at most 13 rounds; a ring below it and an unknown parent add nothing."""
    ids = spark.range(5001).selectExpr("cast(id as string) page_id", "'n' || id name")
    edges = spark.range(1, 5001).selectExpr("cast(id - 1 as string) parent_id", "id ordinal", "cast(id as string) id")
    more = spark.createDataFrame([("5000", 1, "a"), ("a", 1, "b"), ("b", 1, "a"), ("c", 1, "d"), ("d", 1, "c"), ("gone", 1, "e")],
                                 "parent_id string, ordinal long, id string")
    names = ids.unionByName(spark.createDataFrame([(x, x) for x in "abcde"], "page_id string, name string"))
    ways, rounds = tr.root_paths(names, edges.unionByName(more), "0")
    assert rounds <= 13
    depth = {r.page_id: r.n for r in ways.selectExpr("page_id", "size(ids) n").collect()}
    assert len(depth) == 5002 and all(depth[str(k)] == k for k in range(1, 5001)) and (depth["a"], depth["b"]) == (5001, 5002)


def _stored(spark) -> int:
    from marginalia.session import ensure_checkpoint_dir
    top = ensure_checkpoint_dir(spark).removeprefix("file:")
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(top) for f in files)


def test_deep_paths_are_not_stored(spark):
    """The paths of a chain of 3,000 pages are 25 MB of text; less than 1 kB a page is written for them, and no join or sort has them."""
    n = 3000
    nodes = spark.range(n).selectExpr("cast(id as string) id", "'page' || id title", "cast(null as string) webui_url")
    edges = spark.range(1, n).selectExpr("cast(id - 1 as string) parent_id", "id ordinal", "cast(id as string) id")
    before = _stored(spark)
    t = tr.export_tree(nodes, edges, "0", "out").select("page_id", "depth", "parent_page_id", F.md5("output_file").alias("digest"))
    got = {r.page_id: (r.depth, r.parent_page_id, r.digest) for r in t.collect()}
    assert _stored(spark) - before < 1000 * n
    path, want = "out", {}
    for k in range(n):
        path += f"/page{k}"
        want[str(k)] = (k, str(k - 1) if k else None, hashlib.md5(f"{path}/index.md".encode()).hexdigest())
    assert got == want


def test_ways_in_pieces_are_all_simple_ways(spark, monkeypatch):
    """Pages with several parents, rings through and beside posts, pages and edges that come twice: the ways a plain walk finds."""
    monkeypatch.setattr(tr, "POST_EVERY", 2)
    monkeypatch.setattr(tr, "POSTS_PER_BLOCK", 2)
    links = [(k - 1, k, k) for k in range(1, 60)] + [(k, k + 100, k + 2) for k in range(3, 50, 9)]
    links += [(20, 200, 14), (41, 200, 33), (59, 1, 58), (30, 7, 30), (70, 1, 71), (71, 1, 70), (72, 1, 73), (45, 9, 0), (11, 11, 12)]
    ids = [*range(60), 70, 71, 72, 73, 25]
    nodes = spark.createDataFrame([(str(k), f"p{k % 50}", f"u{i}") for i, k in enumerate(ids)], "id string, title string, webui_url string")
    edges = spark.createDataFrame([(str(a), o, str(b)) for a, o, b in links] + [(None, 1, "5"), ("5", 1, None), ("5", 1, "lost")],
                                  "parent_id string, ordinal long, id string")
    want, todo = collections.Counter(), [((0,), (0,), 1)]
    while todo:
        way, key, times = todo.pop()
        path = "/".join(["out", *(f"p{k % 50}" for k in way), "index.md"])
        for i in (i for i, k in enumerate(ids) if k == way[-1]):
            want[str(way[-1]), len(way) - 1, str(way[-2]) if len(way) > 1 else None, key, path, f"u{i}"] += times
        todo += [((*way, b), (*key, o), times * ids.count(b)) for a, o, b in links if a == way[-1] and b not in way]
    t = tr.export_tree(nodes, edges, "0", "out")
    got = collections.Counter((r.page_id, r.depth, r.parent_page_id, tuple(r.order_key), r.output_file, r.source_url) for r in t.collect())
    assert got == want and want.total() > 1000


def test_freshness_rules(spark):
    meta = spark.createDataFrame([(f"f{i}", str(i), lv, None, "t", None) for i, lv in enumerate([7, 8, 9, None, 7])],
                                 "path string, page_id string, local_version long, source_url string, title string,"
                                 " error string")
    remote = spark.createDataFrame([(str(i), "T", rv, "u") for i, rv in enumerate([8, 8, 8, 8, None])],
                                   "page_id string, remote_title string, remote_version long, remote_url string")
    got = {r.page_id: r.is_stale for r in fr.check_freshness(meta, remote).collect()}
    assert got == {"0": True, "1": False, "2": False, "3": False, "4": False}
    broken = spark.createDataFrame([("x", None, None, None, None, "no header")], meta.schema)
    kept = fr.check_freshness(broken, remote).first()
    assert (kept.file, kept.is_stale, kept.error) == ("x", False, "no header")


def test_export_metadata_errors(spark):
    docs = spark.createDataFrame([
        ("a.md", '---\ntitle: "Demo"\nconfluence_page_id: 12345\nconfluence_version: 7\n'
                 "source_url: https://x.example.com/p?a=1:2\n---\nbody"),
        ("b.md", "---\ntitle: x\n---\n"), ("c.md", "no frontmatter"), ("d.md", "---\nconfluence_page_id: 1\n")],
        "path string, text string")
    m = {r.path: r for r in fr.export_metadata(docs).collect()}
    assert (m["a.md"].page_id, m["a.md"].local_version, m["a.md"].title) == ("12345", 7, "Demo")
    assert m["a.md"].source_url == "https://x.example.com/p?a=1:2"
    assert "missing" in m["b.md"].error and "not found" in m["c.md"].error and "not closed" in m["d.md"].error


def test_replace_section(spark):
    body = "<h1>T</h1><h2>Install</h2><p>old</p><h3>Deep</h3><p>x</p><h2>Usage</h2><p>u</p>"
    pages = spark.createDataFrame([("1", body), ("2", "<h2>A</h2><h2>A</h2>")], "page_id string, body string")
    edits = spark.createDataFrame([(1, "1", "Install", "<p>new</p>"), (2, "1", "Missing", "<p/>"),
                                   (3, "2", "A", "<p/>")],
                                  "seq long, page_id string, heading string, replacement_html string")
    r = {x.seq: x for x in se.replace_sections(pages, edits).collect()}
    assert r[1].status == "ok" and r[1].heading_level == 2
    assert r[1].updated_body_html == "<h1>T</h1><h2>Install</h2><p>new</p><h2>Usage</h2><p>u</p>"
    assert r[1].old_section_html == "<p>old</p><h3>Deep</h3><p>x</p>"
    assert r[2].status == "not_found" and r[3].status == "ambiguous"


def test_replace_section_edges(spark):
    """Inline markup in a heading, its tail, loose text, malformed pages and replacements, an unknown page."""
    pages = spark.createDataFrame([("1", "lost<h2>Inst<b>all</b></h2>tail<p>a</p>x<h2 class='a > b'>Next</h2>end"), ("2", "<h2>A</h2><br>"),
                                   ("3", None)], "page_id string, body string")
    edits = spark.createDataFrame([(1, "1", " Install ", "lost <p>n</p>after"), (2, "1", "Next", None), (3, "2", "A", "<p/>"),
                                   (4, "1", "Next", "<p>"), (5, "3", "A", ""), (6, "9", "A", "")],
                                  "seq long, page_id string, heading string, replacement_html string")
    r = {x.seq: x for x in se.replace_sections(pages, edits).collect()}
    assert r[1].matched_heading == "Install" and r[1].old_section_html == "<p>a</p>x" and r[1].new_section_html == "<p>n</p>after"
    assert r[1].updated_body_html == "<h2>Inst<b>all</b></h2>tail<p>n</p>after<h2 class='a > b'>Next</h2>end"
    assert r[2].updated_body_html == "<h2>Inst<b>all</b></h2>tail<p>a</p>x<h2 class='a > b'>Next</h2>end"
    assert [r[k].status for k in (3, 4, 5, 6)] == ["malformed", "malformed", "not_found", "no_page"]
    assert r[3].error == r[4].error == se.PARSE_ERROR


def test_apply_updates_fold(spark):
    pages = spark.createDataFrame([("1", "T", "<p>a</p>", 7, None), ("2", "U", "b", None, None)],
                                  "id string, title string, body string, version long, parent_id string")
    ups = spark.createDataFrame([(1, "1", "", None, "<p>z</p>", None), (2, "2", None, None, "", "900")],
                                "seq long, page_id string, title string, body_html string, append_html string,"
                                " new_parent_id string")
    n = {r.id: r for r in ch.apply_updates(pages, ups).collect()}
    assert (n["1"].title, n["1"].body, n["1"].version) == ("T", "<p>a</p><p>z</p>", 8)
    assert (n["2"].version, n["2"].parent_id, n["2"].body) == (1, "900", "b")


def test_apply_keeps_columns_and_replaced_bodies_vanish(spark):
    pages = spark.createDataFrame([("1", "T", "a", 7, "p", "S", "x"), ("1", "T2", None, 1, None, None, "y"), ("3", "U", None, 2, "q", "S", "z")],
                                  "id string, title string, body string, version long, parent_id string, space_key string, more string")
    ups = spark.createDataFrame([(1, "1", None, "gone", "gone too", None), (3, "1", "N", "b", "+c", "r"), (4, "1", "", None, "+d", None),
                                 (2, "1", "M", None, "gone", "s"), (5, "9", "X", None, None, None), (6, None, "X", None, None, None)],
                                "seq long, page_id string, title string, body_html string, append_html string,"
                                " new_parent_id string")
    n = sorted(tuple(r) for r in ch.apply_updates(pages, ups).collect())
    assert n == [("1", "N", "b+c+d", 5, "r", None, "y", 4), ("1", "N", "b+c+d", 11, "r", "S", "x", 4),
                 ("3", "U", None, 2, "q", "S", "z", 0)]
    lost = {r.seq: r.error for r in ch.unapplied(pages, ups).collect()}
    assert lost == {5: "Page 9 was not found.", 6: "Page None was not found."}
    assert ch.apply_updates(pages, ups.limit(0)).count() == 3 and ch.apply_updates(pages.limit(0), ups).count() == 0


def test_create_guard_requires_parent(spark):
    from marginalia.sources.schemas import CHANGE_DDL
    schema = struct_type(CHANGE_DDL)
    row = {f.name: None for f in schema.fields}
    row.update(request_id="r", seq=1, action="create-page", allow_write=True, dry_run=False, space_key="S")
    changes = spark.createDataFrame([row], schema)
    allow = spark.createDataFrame([("space", "S"), ("parent", "9")], "kind string, value string")
    err = ch.validate_changes(changes, allow).first().error
    assert err == "Write blocked: parent ID is required by CONFLUENCE_ALLOWED_PARENT_IDS."


def test_offset_batches(spark):
    def mk(rows):
        return spark.createDataFrame([("e", s, [{"id": i, "title": None} for i in ids]) for s, ids in rows],
                                     "entity_id string, start long, results array<struct<id:string,title:string>>")
    got = merge_offset_batches(mk([(0, ["1", "2"]), (2, ["3"])]), 2, bucket_width=1)
    assert [r.item.id for r in got.orderBy("position").collect()] == ["1", "2", "3"]
    assert merge_offset_batches(mk([(0, ["1", "2"]), (2, ["3", "4"]), (4, [])]), 2).count() == 4
    assert merge_offset_batches(mk([(0, ["1"]), (1, ["2", "3"])]), 2).count() == 1


def _change_rows(spark, rows):
    from marginalia.sources.schemas import CHANGE_DDL
    schema = struct_type(CHANGE_DDL)
    full = []
    for r in rows:
        base = {f.name: None for f in schema.fields}
        base.update(r)
        full.append(base)
    return spark.createDataFrame(full, schema)


def test_markdown_create_preview(spark):
    changes = _change_rows(spark, [dict(request_id="r1", seq=1, action="create-page", allow_write=False,
                                        dry_run=True, space_key="DOCS", parent_id="100001", title="Demo Page",
                                        body_markdown="# Demo\n\n- Item A")])
    allow = spark.createDataFrame([], "kind string, value string")
    v = ch.resolve_bodies(ch.validate_changes(changes, allow))
    p = ch.preview_create(v).first()
    assert p.body_source == "markdown" and "Demo" in p.body_preview
    assert v.first().body_html == "<h1>Demo</h1><ul><li>Item A</li></ul>"


def test_update_preview_with_markdown_append(spark):
    changes = _change_rows(spark, [dict(request_id="r2", seq=1, action="update-page", allow_write=True,
                                        dry_run=True, page_id="1", title="New title", append_markdown="More **text**")])
    allow = spark.createDataFrame([], "kind string, value string")
    v = ch.resolve_bodies(ch.validate_changes(changes, allow))
    live = spark.createDataFrame([("1", "Old", "<p>a</p>", 3, "S", None)],
                                 "id string, title string, body string, version long, space_key string,"
                                 " webui_url string")
    p = ch.preview_update(v, live).first()
    assert p.body_appended and p.next_title == "New title" and p.title_changed
    assert p.append_source == "markdown" and p.next_body_length == len("<p>a</p><p>More <strong>text</strong></p>")


def test_replace_sections_folded(spark):
    body = "<h2>A</h2><p>a</p><h2>B</h2><p>b</p>"
    pages = spark.createDataFrame([("1", body)], "page_id string, body string")
    edits = spark.createDataFrame([(2, "1", "B", "<p>b2</p>"), (1, "1", "A", "<p>a2</p>"),
                                   (3, "1", "A", "<p>a3</p>")],
                                  "seq long, page_id string, heading string, replacement_html string")
    res, nxt = se.replace_sections_folded(pages, edits)
    assert nxt.first().body == "<h2>A</h2><p>a3</p><h2>B</h2><p>b2</p>"
    assert sorted((r.seq, r.status) for r in res.collect()) == [(1, "ok"), (2, "ok"), (3, "ok")]


def test_a_hundred_edits_of_a_page(spark):
    """Each edit sees what the one before left; headings that an edit brings in can be edited by the next."""
    pages = spark.createDataFrame([("1", "<h1>T</h1>"), ("2", "<p>as it is</p>")], "page_id string, body string")
    rows = [(k, "1", "T" if k == 0 else f"H{k}", f"<h1>H{k + 1}</h1>") for k in range(100)]
    edits = spark.createDataFrame(rows, "seq long, page_id string, heading string, replacement_html string")
    results, bodies = se.replace_sections_folded(pages, edits)
    assert {x.status for x in results.collect()} == {"ok"} and results.count() == 100
    got = {x.page_id: x.body for x in bodies.collect()}
    assert got == {"1": "<h1>T</h1>" + "".join(f"<h1>H{k}</h1>" for k in range(1, 101)), "2": "<p>as it is</p>"}
