"""What the folds of a row cost: nothing is read twice."""

from marginalia.operators import markdown as md
from marginalia.operators import sections as se
from marginalia.plans import markdown_queries as mq


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _filters(df):
    return [x for x in _plan(df).splitlines() if x.lstrip(" :+-").startswith("Filter")]


def test_line_is_cut_once_for_all_its_facts(spark):
    docs = spark.createDataFrame([(1, "> a\n")], "doc_id long, text string")
    assert _plan(md.import_markdown(docs)).count("array_join(slice(") < 20


def test_documents_are_spread_over_the_cores(spark, tmp_path):
    rows = spark.createDataFrame([(i, "n", "b", "t", 1, 1.0) for i in range(8)],
                                 "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    rows.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    for query in (mq.q_link_targets, mq.q_markdown_blocks):
        assert query(spark, str(tmp_path)).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_folds_are_not_repeated_in_filters(spark):
    docs = spark.createDataFrame([(1, "# a\n\n[x](https://y)\n"), (2, ""), (3, None)], "doc_id long, text string")
    links, blocks = md.link_targets(docs), md.markdown_blocks(docs)
    pages = spark.createDataFrame([("1", "<h1>A</h1><p>a</p>")], "page_id string, body string")
    edits = spark.createDataFrame([(1, "1", "A", "<p>b</p>")], "seq long, page_id string, heading string, replacement_html string")
    results, _ = se.replace_sections_folded(pages, edits)
    for df in (links, blocks, results):
        assert not any("aggregate(" in f for f in _filters(df))
    assert [(r.doc_id, r.target) for r in links.collect()] == [(1, "https://y")]
    assert [(r.doc_id, r.kind) for r in blocks.orderBy("block_no").collect()] == [(1, "heading"), (1, "text")]
