"""Connected components of a link table, by rounds of star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

_LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64())])


class Union:
    """Union-find over any keys; the smaller root wins."""

    def __init__(self):
        self.parent: dict = {}

    def find(self, x):
        root = x
        while (up := self.parent.get(root, root)) != root:
            root = up
        while x != root:
            self.parent[x], x = root, self.parent.get(x, x)
        return root

    def join(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a partition that join something, the others being implied."""
    seen = Union()
    for batch in batches:
        kept = [(u, v) for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if seen.join(u, v)]
        if kept:
            yield pa.RecordBatch.from_arrays([pa.array([k[j] for k in kept], pa.int64()) for j in (0, 1)], schema=_LINKS)


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root): the least node reachable by ``links`` (u, v), for every node that has a link.

    Rounds of large-star and small-star: every node points at its least
    neighbour until the links are stars. Only two numbers per round reach the
    driver. Each round is a table in the shared folder.
    """
    slim = links.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v")).where("u <> v")
    table = materialize(slim.mapInArrow(_forest, "u long, v long"), "links")
    before = None
    while True:
        # large star: neighbours above u move to the least of u and its neighbours
        both = table.union(table.select("v", "u").toDF("u", "v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: neighbours below u, and u itself, move to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        table = materialize(small, "links")
        state = tuple(table.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                                                              F.lit(0))).first())
        if state == before:
            break
        before = state
    return table.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root").union(
        table.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
