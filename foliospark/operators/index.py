"""What an index says of titles: topics, amendments, profiles, figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def topic_index(rows: DataFrame, topic: str, place: str) -> DataFrame:
    """(topic, places): the sorted distinct places of each topic."""
    return rows.groupBy(topic).agg(F.array_sort(F.collect_set(place)).alias("places"))


def ranked(rows: DataFrame, group: str, value: str, k: int | None = None) -> DataFrame:
    """Values of each group by falling count, then name: (group, value, n, rank)."""
    counts = rows.groupBy(group, value).agg(F.count("*").alias("n"))
    out = counts.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("n"), value)).cast("long"))
    return out if k is None else out.where(F.col("rank") <= k)


def latest(rows: DataFrame, key: str, date: str, place: str, order: str) -> DataFrame:
    """(key, date, places): the latest date of each key and its places in the order they were first seen."""
    seen = rows.groupBy(key, place).agg(F.max(date).alias("_d"), F.min(order).alias("_o"))
    return seen.groupBy(key).agg(F.max("_d").alias(date), F.transform(F.array_sort(F.collect_list(F.struct("_o", place))), lambda x: x[place]).alias("places"))


def profile(docs: DataFrame, group: list[str], order: str) -> DataFrame:
    """Documents, units, notes, figures, words, distinct amendments and the first excerpt of each title.

    ``docs``: the group's columns, ``order``, units, notes, words (numbers),
    figures, amendments (arrays), excerpt (text).
    """
    base = docs.groupBy(*group).agg(
        F.count("*").alias("documents"), F.sum("units").cast("long").alias("units"), F.sum("notes").cast("long").alias("notes"), F.sum("words").cast("long").alias("words"),
        F.min_by(F.col("excerpt"), F.when(F.col("excerpt") != "", F.col(order))).alias("excerpt"),
    )
    distinct = lambda c, n: docs.select(*group, F.explode(c).alias("_x")).groupBy(*[F.col(g).alias(f"_{n}_{g}") for g in group]).agg(F.count_distinct("_x").alias(n))
    for c, n in (("figures", "n_figures"), ("amendments", "n_amendments")):
        counts = distinct(c, n)
        on = [F.col(g).eqNullSafe(F.col(f"_{n}_{g}")) for g in group]
        base = base.join(counts, on, "left").drop(*[f"_{n}_{g}" for g in group]).withColumn(n, F.coalesce(n, F.lit(0)))
    return base


def usage(docs: DataFrame, doc: str, order: str, figures: Column) -> DataFrame:
    """(figure, documents): each figure with its citing documents in order."""
    return docs.select(F.explode(figures).alias("figure"), F.struct(F.col(order).alias("o"), F.col(doc).alias("d")).alias("x")).groupBy("figure").agg(F.transform(F.array_sort(F.collect_set("x")), lambda x: x["d"]).alias("documents"))


def reverse(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """(key, value): the value of each key's last row in order, as a lookup that later rows overwrite."""
    return rows.groupBy(key).agg(F.max_by(value, order).alias(value))


def compared_sets(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: distinct keys of both sides, of the left only, of the right only."""
    a, b = left.select(F.col(key).alias("a")).distinct(), right.select(F.col(key).alias("b")).distinct()
    joined = a.join(b, F.col("a") == F.col("b"), "full_outer")
    return joined.agg(F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("shared"), F.count_if(F.col("b").isNull()).alias("only_left"), F.count_if(F.col("a").isNull()).alias("only_right"))


def detail(n_units: Column, topics: Column) -> Column:
    """What an index line says of a document: its units and first three topics."""
    count = F.when(n_units > 0, F.concat(n_units.cast("string"), F.lit(" número"), F.when(n_units > 1, "s").otherwise("")))
    some = F.when(F.size(topics) > 0, F.array_join(F.slice(topics, 1, 3), ", "))
    text = F.concat_ws(" · ", count, some)
    return F.when(text != "", F.concat(F.lit(" — "), text)).otherwise("")
