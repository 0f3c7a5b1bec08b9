"""Positions of rows in an order, over many tasks: no window is wider than a range partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliospark.operators import lineage


def numbered(rows: DataFrame, order: list[str], by: list[str] | None = None, position: str = "position", size: str | None = None) -> DataFrame:
    """``rows`` with their ``position`` (from 0) in ``order`` among those that are equal in ``by``, and the ``size`` of that group where it is named.

    Rows are dealt out by ranges of (by, order), so that a group of any size
    is spread over several tasks; each range is numbered for itself, and what
    the ranges before it hold of the group is added. Nulls come first, as in
    Spark's ascending order; equal rows get positions of their own in any
    order. Names that begin with ``_n_`` are used up.
    """
    by = by or []
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tied = lineage.written(rows.withColumn("_n_tie", F.monotonically_increasing_id()), "rows")
    dealt = lineage.written(tied.repartitionByRange(n, *by, *order, "_n_tie").withColumn("_n_part", F.spark_partition_id()), "ranges")
    counts = dealt.groupBy(*by, "_n_part").agg(F.count(F.lit(1)).alias("_n_count"))
    group = Window.partitionBy(*by)
    before = F.sum("_n_count").over(group.orderBy("_n_part").rowsBetween(Window.unboundedPreceding, -1))
    whole = [F.sum("_n_count").over(group).alias("_n_size")] if size else []
    offsets = counts.select(*(F.col(c).alias(f"_n_by{i}") for i, c in enumerate(by)), F.col("_n_part").alias("_n_at"), F.coalesce(before, F.lit(0)).alias("_n_before"), *whole)
    inside = F.row_number().over(Window.partitionBy(*by, "_n_part").orderBy(*order, "_n_tie"))
    same = F.col("_n_part") == F.col("_n_at")
    for i, c in enumerate(by):
        same &= F.col(c).eqNullSafe(F.col(f"_n_by{i}"))
    out = dealt.withColumn("_n_inside", inside).join(offsets, same)
    return out.select(*rows.columns, (F.col("_n_before") + F.col("_n_inside") - 1).alias(position), *([F.col("_n_size").alias(size)] if size else []))
