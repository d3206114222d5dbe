"""Readers (R1, R2, R4, R7) and sinks (Z1, Z2) round trips."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from marginalia.sources import readers as rd


def _write_lines(path, records):
    with open(path, "w", encoding="utf-8") as fh:
        for r in records:
            fh.write(json.dumps(r, ensure_ascii=False) + "\n")


def test_read_pages_and_comments_with_missing_fields(spark):
    d = tempfile.mkdtemp(prefix="marginalia-io-", dir="/tmp")
    _write_lines(f"{d}/pages.json", [
        {"id": "123", "type": "page", "title": "Demo", "space": {"key": "TEST"}, "version": {"number": 7},
         "_links": {"base": "https://example.com", "webui": "/spaces/TEST/pages/123/Demo"}},
        {"id": "124", "title": "No links"}])
    _write_lines(f"{d}/comments.json", [
        {"page_id": "123", "position": 1, "id": "c1", "extensions": {"resolution": {"status": "open"}}}])
    pages = rd.read_pages(spark, f"{d}/pages.json")
    got = {r.id: r for r in pages.select("id", "version.number", "_links.base", "ancestors").collect()}
    assert got["123"].number == 7 and got["124"].base is None and got["124"].ancestors is None
    c = rd.read_comments(spark, f"{d}/comments.json").first()
    assert c.extensions.inlineProperties is None and c.extensions.resolution.status == "open"


def test_read_issues_keeps_updated_string(spark):
    d = tempfile.mkdtemp(prefix="marginalia-io-", dir="/tmp")
    _write_lines(f"{d}/issues.json", [{"id": "9", "key": "TEST-9", "fields": {
        "summary": "S", "updated": "2024-01-02T03:04:05.000+0900", "status": {"name": "Open"}}}])
    r = rd.read_issues(spark, f"{d}/issues.json").first()
    assert r.fields.updated == "2024-01-02T03:04:05.000+0900"


def test_read_markdown_whole_text(spark):
    d = tempfile.mkdtemp(prefix="marginalia-io-", dir="/tmp")
    with open(f"{d}/a.md", "w", encoding="utf-8") as fh:
        fh.write("---\ntitle: A\n---\nline 1\nline 2\n")
    r = rd.read_markdown(spark, f"{d}/*.md").first()
    assert r.path.endswith("a.md") and r.text.count("\n") == 5


def test_sinks_round_trip(spark):
    d = tempfile.mkdtemp(prefix="marginalia-io-", dir="/tmp")
    df = spark.createDataFrame([("1", "Ünïcode", None)], "page_id string, title string, parent_page_id string")
    rd.write_rows(df, f"{d}/rows")
    assert spark.read.json(f"{d}/rows").first().title == "Ünïcode"
    rd.write_rows(df, f"{d}/text", fmt="text")
    assert [r.value for r in spark.read.text(f"{d}/text").collect()] == [
        "page_id: 1", "title: Ünïcode", "parent_page_id: None"]
    content = df.select("page_id", F.lit("out/x/index.md").alias("output_file"), F.lit("# x").alias("markdown"))
    manifest = df.select("page_id", "title", F.lit("out/x/index.md").alias("output_file"),
                         F.lit(None).cast("string").alias("source_url"), "parent_page_id")
    rd.write_export(content, manifest, f"{d}/export")
    assert os.path.isdir(f"{d}/export/content") and spark.read.parquet(f"{d}/export/manifest").count() == 1


def test_a_crash_before_publishing_leaves_the_old_snapshot(spark):
    d = tempfile.mkdtemp(prefix="marginalia-io-", dir="/tmp") + "/out"
    one, two = (spark.createDataFrame([("1", x)], "page_id string, markdown string") for x in ("old", "new"))
    rd.publish_snapshot(one, d, manifest=one.select("page_id"))
    # the content of the next snapshot is there, but nothing names it
    two.write.parquet(f"{d}/snapshots/unpublished/content")
    assert rd.read_snapshot(spark, d).first().markdown == "old"
    rd.publish_snapshot(two, d)
    assert rd.read_snapshot(spark, d).first().markdown == "new"
