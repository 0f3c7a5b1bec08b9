"""What changed between two snapshots of documents, and of what kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: change categories in the order of a report.
CATEGORIES = ["new", "normative", "editorial", "removed", "pipeline", "cosmetic"]


def classify(old_source: Column, new_source: Column, old_content: Column, new_content: Column, new_notes: Column) -> Column:
    """The kind of a change of one document, null where nothing changed.

    The source's hash tells whether the norm changed, the content's whether our
    output did; with both, a new note makes it normative.
    """
    source, content = ~old_source.eqNullSafe(new_source), ~old_content.eqNullSafe(new_content)
    return F.when(source & content, F.when(F.size(new_notes) > 0, "normative").otherwise("editorial")).when(content, "pipeline").when(source, "cosmetic")


def compare(before: DataFrame, after: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents of either snapshot with their category (null: unchanged) and new notes, sorted as text.

    Both have ``key``, source_sha256, content_sha256 and notes.
    """
    side = lambda df, p: df.select(F.col(key).alias(f"{p}_key"), F.col("source_sha256").alias(f"{p}_source"), F.col("content_sha256").alias(f"{p}_content"), F.coalesce("notes", F.array().cast("array<string>")).alias(f"{p}_notes"))
    joined = side(before, "b").join(side(after, "a"), F.col("b_key") == F.col("a_key"), "full_outer")
    fresh = F.array_sort(F.array_except("a_notes", "b_notes"))
    category = F.when(F.col("b_key").isNull(), "new").when(F.col("a_key").isNull(), "removed").otherwise(classify(*[F.col(c) for c in ("b_source", "a_source", "b_content", "a_content")], F.array_except("a_notes", "b_notes")))
    notes = F.when(F.col("b_key").isNotNull() & F.col("a_key").isNotNull(), fresh).otherwise(F.array().cast("array<string>"))
    return joined.select(F.coalesce("a_key", "b_key").alias(key), category.alias("category"), notes.alias("new_notes"))


def summary(changes: DataFrame) -> DataFrame:
    """One row with a count for each category, zeros too."""
    return changes.agg(*[F.count_if(F.col("category") == c).alias(c) for c in CATEGORIES])


def severity(category: Column) -> Column:
    return F.array_position(F.array(*[F.lit(c) for c in CATEGORIES]), category)


# What each category means, as a changelog explains it.
EXPLAIN = {
    "normative": "the norm changed, with a new amendment note",
    "new": "a document that was not there before",
    "removed": "a document that is not there any more",
    "editorial": "source and content changed, without a note",
    "pipeline": "only our output changed",
    "cosmetic": "only the source's markup changed",
}


def changelog(changes: DataFrame, name: str, citation: str = "citation") -> DataFrame:
    """A changelog in Markdown, one row (ord, block) for each heading and document, in order.

    Rows are kept apart, so that a changelog of any length is written by many tasks.
    """
    spark = changes.sparkSession
    counts = changes.where("category is not null").groupBy("category").agg(F.count("*").alias("n"))
    heads = spark.createDataFrame([(c, i, EXPLAIN[c]) for i, c in enumerate(CATEGORIES)], "cat string, rank int, what string").join(counts, F.col("cat") == F.col("category"), "left").select("cat", "rank", "what", F.coalesce("n", F.lit(0)).alias("n"))
    title = spark.range(1).select(F.array(F.lit(0), F.lit(0)).cast("array<long>").alias("ord"), F.lit(f"# {name}\n\n| class | documents | meaning |\n| --- | ---: | --- |").alias("block"))
    table = heads.select(F.array(F.lit(1), F.col("rank")).cast("array<long>").alias("ord"), F.concat_ws("", F.lit("| "), "cat", F.lit(" | "), F.col("n").cast("string"), F.lit(" | "), "what", F.lit(" |")).alias("block"))
    groups = heads.where("n > 0").select(F.array(F.lit(2), F.col("rank"), F.lit(-1)).cast("array<long>").alias("ord"), F.concat(F.lit("\n## "), "cat", F.lit(" ("), F.col("n").cast("string"), F.lit(")\n")).alias("block"))
    rows = changes.where("category is not null").select(F.array(F.lit(2), severity(F.col("category")) - 1, F.col("doc_id")).cast("array<long>").alias("ord"), F.concat(F.lit("### "), F.col(citation), F.lit("\n"), F.array_join(F.transform("new_notes", lambda x: F.concat(F.lit("- "), x)), "\n")).alias("block"))
    return title.unionAll(table).unionAll(groups).unionAll(rows)
