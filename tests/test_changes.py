"""Uploads, issue comments and content types of change sets."""

import mimetypes

from pyspark.sql import functions as F

from marginalia.operators import changes as ch


def test_content_types(spark):
    names = ["a.png", "A.PNG", "a.tar.gz", "b.tgz", "c.Z", "d", ".bashrc", "..png", "e.", "f.unknown", "g.txt.bz2", "h.jpeg",
             "i.tar", "x y.csv", "j.gz", "K.HTML", "l.svgz", "m.md", "..a.pdf"]
    known = mimetypes.MimeTypes(filenames=())
    got = spark.createDataFrame([(n,) for n in names], "n string").select("n", ch.content_type(F.col("n")).alias("t")).collect()
    assert {r.n: r.t for r in got} == {n: known.guess_type(n)[0] or "application/octet-stream" for n in names}


def test_last_of_several_uploads_stays(spark):
    att = spark.createDataFrame([("p", "a.png", "1", 5, 10, "x/y"), ("p", "a.png", "2", 7, 11, "x/y")],
                                "page_id string, title string, id string, ordinal long, file_size long, media_type string")
    ups = spark.createDataFrame([("r1", "p", "a.png", 100, 1), ("r2", "p", "a.png", 200, 2), ("r3", "p", "b.txt", 1, 9),
                                 ("r4", "p", "b.txt", 2, 8)],
                                "request_id string, page_id string, file_name string, file_size long, seq long")
    got = {r.id: (r.title, r.file_size, r.media_type, r.change) for r in ch.apply_attachments(att, ups).collect()}
    assert got == {"1": ("a.png", 200, "image/png", "replaced"), "2": ("a.png", 11, "x/y", "unchanged"),
                   "new-r4": ("b.txt", 1, "text/plain", "created")}


def test_comments_are_numbered_on(spark):
    old = spark.createDataFrame([("A", 1, "1", "x"), ("A", 4, "2", "y")], "issue_key string, ordinal long, id string, body string")
    new = spark.createDataFrame([("A", 9, "r9", "z"), ("A", 3, "r3", "w"), ("B", 5, "r5", "v")],
                                "issue_key string, seq long, request_id string, comment_body string").selectExpr(
        "*", "'jira-add-comment' AS action", "cast(null AS string) AS error", "'apply' AS mode")
    got = {r.id: (r.issue_key, r.ordinal) for r in ch.apply_comments(old, new).collect()}
    assert got == {"1": ("A", 1), "2": ("A", 4), "new-r3": ("A", 5), "new-r9": ("A", 6), "new-r5": ("B", 1)}
