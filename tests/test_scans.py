"""The range scans equal the plain (unbounded) window results."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from marginalia.plans.scans import ordered_carry, ordered_running_sum, range_bounds, range_index, range_tails
from marginalia.sources import driver_tables as dt

SF = "/root/testdata/sf0.001"


def _events(spark):
    ev = dt.table(spark, SF, "events")
    # a hot page: every third event goes to page 0
    return ev.select(F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")).alias("page"),
                     F.col("event_id").alias("pos"),
                     F.when(F.col("event_type") == "click", F.col("event_id").cast("string")).alias("v"),
                     (F.col("event_id") % 5).alias("x"))


def test_carry_matches_window(spark):
    e = _events(spark)
    w = Window.partitionBy("page").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    want = e.select("page", "pos", F.last("v", ignorenulls=True).over(w).alias("v_carry"),
                    F.first("v", ignorenulls=False).over(Window.partitionBy("page").orderBy("pos")
                                                         .rowsBetween(Window.unboundedPreceding,
                                                                      Window.unboundedFollowing)).alias("v_first"))
    for width in (1, 7, 1 << 20):
        got = ordered_carry(e, ["page"], "pos", ["v"], bucket_width=width, first=["v"]).select(
            "page", "pos", "v_carry", "v_first")
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, width


def test_running_sum_matches_window(spark):
    e = _events(spark)
    w = Window.partitionBy("page").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    want = e.select("page", "pos", F.sum("x").over(w).alias("s"))
    for width in (1, 13, 1 << 20):
        got = ordered_running_sum(e, ["page"], "pos", "x", "s", bucket_width=width).select("page", "pos", "s")
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, width


def test_ranges_are_even_and_summaries_few(spark):
    # one page holds 90 % of the rows, the other pages hold few rows each
    n = 20_000
    e = spark.range(n).select(F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("p"), "id")).alias("page"),
                              F.col("id").alias("pos"))
    bounds = range_bounds(e, ["page", "pos"], 1000)
    assert len(bounds) == 19
    b = e.withColumn("__range", range_index(e, ["page", "pos"], bounds))
    sizes = {r[0]: r[1] for r in b.groupBy("__range").count().collect()}
    assert sorted(sizes) == list(range(20)) and max(sizes.values()) < 2500
    assert range_tails(b, ["page"], "pos", []).count() == 20
    # ranges follow the order of (page, pos)
    ends = b.groupBy("__range").agg(F.min(F.struct("page", "pos")).alias("lo"), F.max(F.struct("page", "pos")).alias("hi"))
    rows = ends.orderBy("__range").collect()
    assert all(tuple(a.hi) < tuple(z.lo) for a, z in zip(rows, rows[1:]))


def test_null_groups_and_empty_tables(spark):
    rows = [(None, k, "a" if k == 1 else None, k) for k in range(6)] + [("p", k, None, k) for k in range(3)]
    df = spark.createDataFrame(rows, "page string, pos long, v string, x long")
    for width in (1, 2, 100):
        got = ordered_carry(df, ["page"], "pos", ["v"], bucket_width=width, first=["x"]).collect()
        assert {(r.page, r.pos): r.v_carry for r in got} == {
            (p, k): "a" if p is None and k >= 1 else None for p, k, _, _ in rows}
        assert len(got) == 9 and {r.x_first for r in got} == {0}
        sums = ordered_running_sum(df, ["page"], "pos", "x", "s", bucket_width=width).collect()
        assert {(r.page, r.pos): r.s for r in sums} == {(p, k): k * (k + 1) // 2 for p, k, _, _ in rows}
    assert ordered_carry(df.limit(0), ["page"], "pos", ["v"], first=["x"]).count() == 0
