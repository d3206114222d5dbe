"""The pipeline equals its stages applied one by one, and its decisions take effect."""

import corpus_pipeline
from marginalia.llm import queries


def test_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf)
        assert after.columns == docs.columns
        sizes.append(after.count())
        docs = after
    assert sizes == sorted(sizes, reverse=True) and sizes[0] > sizes[1] > sizes[-1] > 0
    assert corpus_pipeline.run(spark, sf).count() == sizes[-1]


def test_queries_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
