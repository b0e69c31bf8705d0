"""Positions in a global order without a single-task window: range partitions, written once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotelens.session import materialize


def ranged(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` dealt by ranges of the order, with its range number as ``part`` (written, so that a
    retried task can't deal anew)."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(df.repartitionByRange(n, *order).withColumn("part", F.spark_partition_id()), "ranges")


def with_rank(df: DataFrame, *order: Column) -> DataFrame:
    """Adds ``rank`` from 0 in the order. Only one row for each range meets in one task."""
    parts = ranged(df, *order)
    count = parts.groupBy("part").agg(F.count("*").alias("n"))
    before = count.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    local = parts.withColumn("rank", F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1)
    return local.join(before, "part").withColumn("rank", F.col("rank") + F.col("before")).drop("part", "before")
