"""Streaming thread rollup equals the batch rollup over the same comments."""

import tempfile

from pyspark.sql import functions as F

from marginalia.operators import threads as th
from marginalia.sources import driver_tables as dt
from marginalia.sources.schemas import COMMENT_DDL, struct_type
from marginalia.streaming.threads import start_thread_rollup_stream

SF = "/root/testdata/sf0.001"


def test_stream_matches_batch(spark):
    root = tempfile.mkdtemp(prefix="marginalia-stream-", dir="/tmp")
    comments = dt.comments_from_events(dt.table(spark, SF, "events"))
    # two arrivals, the second holding replies to threads of the first
    comments.filter(F.col("position") % 2 == 0).write.parquet(f"{root}/src/a")
    comments.filter(F.col("position") % 2 == 1).write.parquet(f"{root}/src/b")
    src = (spark.readStream.schema(struct_type(COMMENT_DDL)).option("maxFilesPerTrigger", 1)
           .option("recursiveFileLookup", "true").parquet(f"{root}/src"))
    q = start_thread_rollup_stream(spark, src, f"{root}/store", f"{root}/out", f"{root}/ckpt",
                                   dt.WIKI_BASE, buckets=8, available_now=True)
    q.awaitTermination(300)
    got = spark.read.parquet(f"{root}/out").select("page_id", "thread_id", "comment_count", "status",
                                                   "latest_comment_excerpt")
    batch = th.thread_rollup(th.assign_threads(th.normalize_comments(comments, dt.WIKI_BASE)))
    want = batch.select("page_id", "thread_id", "comment_count", "status", "latest_comment_excerpt")
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
