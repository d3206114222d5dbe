"""Comment threads (C1-C8): reference test cases and code-derived cases."""

from pyspark.sql import functions as F

from marginalia.operators import threads as th
from marginalia.sources.schemas import COMMENT_DDL, struct_type


def comments(spark, rows):
    """rows: (position, id, marker, selection, status, created, author, body)."""
    data = [("P", pos, cid, {"createdDate": created, "createdBy": {"displayName": author}},
             {"storage": {"value": body}},
             {"inlineProperties": {"originalSelection": sel, "markerRef": marker}, "resolution": {"status": st}},
             {"webui": f"/c/{cid}"})
            for pos, cid, marker, sel, st, created, author, body in rows]
    return spark.createDataFrame(data, struct_type(COMMENT_DDL))


def run(spark, rows, bucket=1 << 16):
    norm = th.normalize_comments(comments(spark, rows), "https://w.example.com/")
    assigned = th.assign_threads(norm, bucket_width=bucket)
    return assigned, th.thread_rollup(assigned)


def groups(assigned):
    out = {}
    for r in assigned.select("thread_key", "id").collect():
        out.setdefault(r.thread_key, set()).add(r.id)
    return sorted(out.values(), key=lambda s: sorted(s))


def test_reference_reply_thread(spark):
    rows = [(1, "1", "m1", "Selected", "resolved", "2024-01-01T00:00:00", "Ann", "<p>first</p>"),
            (2, "2", None, None, "open", "2024-01-02T00:00:00", "Bob", "<p>reply</p>")]
    _, t = run(spark, rows)
    r = t.collect()
    assert len(r) == 1
    assert r[0].comment_count == 2 and r[0].status == "open"
    assert r[0].latest_comment_excerpt == "reply"
    assert r[0].participants == "Ann, Bob"
    assert r[0].latest_comment_url == "https://w.example.com/c/2"


def test_marker_return_and_blank(spark):
    rows = [(1, "1", "a", None, "open", None, "x", ""), (2, "2", "b", None, "open", None, "x", ""),
            (3, "3", "a", None, "open", None, "x", ""), (4, "4", None, None, "open", None, "x", "")]
    for bucket in (1, 2, 1 << 16):
        a, _ = run(spark, rows, bucket)
        assert groups(a) == [{"1", "3", "4"}, {"2"}]


def test_leading_blanks_orphan(spark):
    rows = [(1, "1", None, None, "open", None, "x", ""), (2, "2", None, None, "open", None, "x", ""),
            (3, "3", "a", None, "open", None, "x", "")]
    a, t = run(spark, rows, bucket=1)
    assert groups(a) == [{"1", "2"}, {"3"}]
    ids = {r.thread_id: r.selection for r in t.collect()}
    assert ids == {"orphan-1": "(Reply without quoted selection)", "a": "(No quoted selection)"}


def test_equal_selections_never_merge(spark):
    rows = [(1, "1", None, "x", "open", None, "u", ""), (2, "2", None, "x", "open", None, "u", "")]
    _, t = run(spark, rows)
    assert sorted(r.thread_id for r in t.collect()) == ["selection-1", "selection-2"]


def test_latest_ties_and_nulls(spark):
    rows = [(1, "1", "m", None, "open", "2024-01-01", "u", "<p>one</p>"),
            (2, "2", None, None, "open", "2024-01-01", "u", "<p>two</p>"),
            (3, "3", None, None, "open", None, "u", "<p>three</p>")]
    _, t = run(spark, rows)
    assert t.first().latest_comment_excerpt == "one"


def test_status_ladder_and_last(spark):
    rows = [(1, "1", "m", None, None, None, "u", ""), (2, "2", None, None, "custom", None, "u", "")]
    _, t = run(spark, rows)
    assert t.first().status == "custom"


def test_filter_and_counts(spark):
    rows = [(1, "1", "m", None, "open", None, "u", ""), (2, "2", None, None, "resolved", None, "u", ""),
            (3, "3", "n", None, "dangling", None, "u", "")]
    a, t = run(spark, rows)
    sel = th.filter_threads(t, "resolved").collect()
    assert [(r.thread_id, r.status) for r in sel] == [("m", "open")]
    s = th.page_comment_summary(t, "resolved").first()
    assert (s.total_comments, s.matching_comment_count, s.open_thread_count, s.all_comment_count) == (2, 1, 1, 3)
    assert s.anchored_comment_count + s.reply_comment_count == s.total_comments


def test_excerpt_truncation(spark):
    body = "<p>" + "word " * 60 + "</p>"
    _, t = run(spark, [(1, "1", "m", None, "open", None, "u", body)])
    ex = t.first().latest_comment_excerpt
    assert len(ex) == 160 and ex.endswith("…") and not ex[:-1].endswith(" ")


def test_digest_lines(spark):
    rows = [(1, "1", "m", "Sel", "open", "2024-01-01", "Ann", "<p>hi</p>")]
    a, t = run(spark, rows)
    pages = spark.createDataFrame([("P", "Demo", {"base": "https://w", "webui": "/p"})],
                                  "id string, title string, _links struct<base:string,webui:string>")
    lines = th.digest_lines(t, pages, "2024-01-01T00:00:00+00:00")
    md = th.assemble_lines(lines).first().markdown
    for h in ("# Demo - Inline Comment Summary", "## Quick Summary", "## Threads", "### Open", "- `Sel`"):
        assert h in md


def test_latest_parsed_time_opt_in(spark):
    # 10:00+09:00 is 01:00Z, earlier than 09:00+00:00, but sorts later as a string
    rows = [(1, "1", "m", None, "open", "2024-01-01T10:00:00+09:00", "u", "<p>tokyo</p>"),
            (2, "2", None, None, "open", "2024-01-01T09:00:00+00:00", "u", "<p>london</p>")]
    a, t = run(spark, rows)
    assert t.first().latest_comment_excerpt == "tokyo"
    assert th.thread_rollup(a, parsed_time=True).first().latest_comment_excerpt == "london"


def test_digest_of_a_filter_without_threads(spark):
    # page Q has no record; P has no resolved comment, R is a page without comments
    t = run(spark, [(1, "1", "m", "Sel", "open", "2024-01-01", "Ann", "<p>hi</p>"),
                    (2, "2", "n", "B", "custom", None, "", "<p>x</p>")])[1]
    both = t.unionByName(t.withColumn("page_id", F.lit("Q")).withColumn("statuses", F.array(F.lit("resolved"))))
    pages = spark.createDataFrame([("P", "De\"mo", {"base": "https://w", "webui": "/p"}), ("R", "Empty", None)],
                                  "id string, title string, _links struct<base:string,webui:string>")
    docs = {r.page_id: r.markdown for r in th.assemble_lines(
        th.digest_lines(both, pages, "2024", "resolved")).collect()}
    assert set(docs) == {"P", "Q"}
    assert docs["P"].endswith("## Threads\n\n- No inline comment threads matched the requested filter.\n")
    assert "title: \"De'mo - Inline Comment Summary\"" in docs["P"] and "- Threads to review: 0\n" in docs["P"]
    assert "# Untitled - Inline Comment Summary" in docs["Q"] and "- Threads to review: 2\n" in docs["Q"]
    assert docs["Q"].index("### Open") < docs["Q"].index("### Other")


def test_digest_reads_threads_once(spark):
    t = run(spark, [(1, "1", "m", "Sel", "open", "2024-01-01", "Ann", "<p>hi</p>")])[1]
    pages = spark.createDataFrame([], "id string, title string, _links struct<base:string,webui:string>")
    plan = th.digest_lines(t, pages, "2024")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1 and "Join" not in plan.split("Expand")[0]
