"""Trends and run metrics: medians, modes, rates, drift, dense axes, text charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Glyphs of text charts.
EIGHTHS, BRAILLE, FLAT = " ▏▎▍▌▋▊▉", "⠀⣀⣄⣤⣦⣶⣷⣿", "⠤"


def upper_median(rows: DataFrame, group: str, value: str) -> DataFrame:
    """(group, median): the element at half the count of ascending values, never between two.

    Distinct values are counted and summed up in order, so no group's values
    are gathered in one array.
    """
    counts = rows.groupBy(group, value).agg(F.count("*").alias("_n"))
    run = Window.partitionBy(group).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(group)
    placed = counts.withColumn("_upto", F.sum("_n").over(run)).withColumn("_all", F.sum("_n").over(whole))
    return placed.where(F.col("_upto") > F.floor(F.col("_all") / 2)).groupBy(group).agg(F.min(value).alias("median"))


def common_scope(rows: DataFrame, value: str) -> DataFrame:
    """One row (scope): the most frequent value, of equals the larger."""
    counts = rows.groupBy(value).agg(F.count("*").alias("_n"))
    return counts.agg(F.max_by(value, F.struct("_n", F.col(value))).alias("scope"))


def dense_years(counts: DataFrame, year: str, n: str) -> DataFrame:
    """Every year from the first to the last, with 0 where there is none."""
    span = counts.agg(F.min(year).alias("a"), F.max(year).alias("b"))
    axis = span.where("a is not null").select(F.explode(F.sequence("a", "b")).alias("_y"))
    return axis.join(counts, F.col("_y") == F.col(year), "left").select(F.col("_y").alias(year), F.coalesce(n, F.lit(0)).alias(n))


def activity(counts: DataFrame, year: str, n: str) -> DataFrame:
    """One row: total, span in years, mean a year, peak year (the earliest of equals), share of the last five years."""
    span = counts.agg(F.max(year).alias("_last"))  # one row
    rows = counts.crossJoin(F.broadcast(span))
    total = F.sum(n)
    years = F.max(year) - F.min(year) + 1
    return rows.agg(
        total.cast("long").alias("total"), years.cast("long").alias("span"), (total / years).alias("per_year"), F.max_by(year, F.struct(F.col(n), -F.col(year))).cast("long").alias("peak_year"),
        (F.sum(F.when(F.col(year) >= F.col("_last") - 4, F.col(n)).otherwise(0)) / total).alias("recent_share"),
    )


def ends(rows: DataFrame, group: str, at: str, value: str) -> DataFrame:
    """(group, first, last, trend): values of the earliest and latest row; trend is their relative change, 0 from 0."""
    both = rows.groupBy(group).agg(F.min_by(value, at).alias("first"), F.max_by(value, at).alias("last"))
    return both.withColumn("trend", F.when(F.col("first") != 0, (F.col("last") - F.col("first")) / F.col("first")).otherwise(0.0))


def rates(samples: DataFrame, group: str, at: Column, order: list, value: str) -> DataFrame:
    """Rates a second between consecutive samples of a group; 0 for no time between, no row for the first."""
    w = Window.partitionBy(group).orderBy(*order)
    span, delta = at - F.lag(at).over(w), F.col(value) - F.lag(value).over(w)
    return samples.withColumn("rate", F.when(span > 0, delta / span).when(span.isNotNull(), 0.0)).where("rate is not null")


def last_rows(rows: DataFrame, group: str, order: list, k: int) -> DataFrame:
    """The last ``k`` rows of each group by ``order`` (descending columns)."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("_r") <= k).drop("_r")


def bucket_means(rows: DataFrame, group: str, order: list, value: str, width: int) -> DataFrame:
    """(group, bucket, mean): a series brought down to ``width`` points; a shorter one stays as it is."""
    w = Window.partitionBy(group)
    numbered = rows.withColumn("_i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("_n", F.count("*").over(w))
    # row i is in bucket b where floor(b * n / width) <= i < floor((b + 1) * n / width)
    bucket = F.when(F.col("_n") <= width, F.col("_i")).otherwise(F.floor(((F.col("_i") + 1) * width - 1) / F.col("_n")))
    return numbered.groupBy(group, bucket.cast("long").alias("bucket")).agg(F.avg(value).alias("mean"))


def bar(value: Column, top: Column, width: int) -> Column:
    """A horizontal bar in eighths of a column."""
    eighths = F.bround(F.greatest(F.lit(0.0), F.least(value / top, F.lit(1.0))) * (width * 8), 0).cast("int")
    glyphs = F.array(*[F.lit("" if i == 0 else g) for i, g in enumerate(EIGHTHS)])
    return F.when((top > 0) & F.lit(width > 0), F.concat(F.repeat(F.lit("█"), F.floor(eighths / 8).cast("int")), F.get(glyphs, eighths % 8))).otherwise("")


def sparkline(values: Column) -> Column:
    """A series as one line of glyphs; a flat one at half height."""
    low, high, top = F.array_min(values), F.array_max(values), len(BRAILLE) - 1
    glyphs = F.array(*[F.lit(g) for g in BRAILLE])
    drawn = F.array_join(F.transform(values, lambda v: F.get(glyphs, F.least(F.floor((v - low) / (high - low) * top).cast("int"), F.lit(top)))), "")
    return F.when(F.size(values) <= 0, "").when(low == high, F.repeat(F.lit(FLAT), F.size(values))).otherwise(drawn)
