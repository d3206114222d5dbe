"""Partition-count guards for CPU-heavy row-wise stages."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition only when the input has fewer partitions than
    the cluster has cores (e.g. one small parquet file with one row group).

    Large inputs already arrive split into many more partitions than cores,
    so on a cluster this adds no shuffle; on a tiny input it keeps regex-heavy
    projections from running in a single task.
    """
    spark = df.sparkSession
    target = min_partitions or spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df
