"""Corpus metrics and invariants, checked before anything is written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.functions import text as tx
from foliospark.operators import align
from foliospark.operators.lineage import written

# The shares and counts below or above which a corpus counts as degraded.
MIN_WITH_PATH, MIN_WITH_CONTENT, MAX_EMPTY, MAX_DRIFT = 0.95, 0.98, 10, 0.25


class DegradedCorpus(Exception):
    """A corpus violates invariants; nothing was written."""


def metrics(docs: DataFrame, book: str = "book") -> DataFrame:
    """Documents, chars, units, distinct figures, notes and empty documents of each book.

    ``docs`` has book, markdown, units, figures, notes (arrays); nulls count as empty.
    """
    blank = (F.trim(F.coalesce("markdown", F.lit(""))) == "") & (F.coalesce(F.size("figures"), F.lit(0)) <= 0)
    size = lambda c: F.sum(F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(0))).cast("long")
    base = docs.groupBy(book).agg(F.count("*").alias("documents"), F.sum(F.length(F.coalesce("markdown", F.lit("")))).cast("long").alias("chars"), size("units").alias("units"), size("notes").alias("notes"), F.count_if(blank).alias("empty"))
    figures = docs.select(F.col(book).alias("_b"), F.explode("figures").alias("f")).groupBy("_b").agg(F.count_distinct("f").alias("figures"))
    return base.join(figures, F.col(book).eqNullSafe(F.col("_b")), "left").drop("_b").withColumn("figures", F.coalesce("figures", F.lit(0)))


def problems(docs: DataFrame, limits: DataFrame, previous: DataFrame | None = None, nodes: DataFrame | None = None) -> DataFrame:
    """(book, problems array<string>) for each book of ``limits`` (book, root, min_documents, min_units).

    A book without documents reports only their number. ``previous`` (book,
    chars) brings the drift check, ``nodes`` (book, id, parent) that of roots.
    """
    have = F.greatest(F.coalesce(F.size("figures"), F.lit(0)), F.lit(0)) > 0
    text = F.coalesce("markdown", F.lit(""))
    facts = docs.groupBy(F.col("book").alias("_b")).agg(
        F.count("*").alias("n"), F.avg(F.when(F.coalesce("path", F.lit("")) != "", 1.0).otherwise(0.0)).alias("with_path"), F.avg(F.when((F.length(text) > 100) | have, 1.0).otherwise(0.0)).alias("with_content"),
        F.count_if((F.trim(text) == "") & ~have).alias("empty"), F.sum(F.greatest(F.coalesce(F.size("units"), F.lit(0)), F.lit(0))).alias("units"), F.sum(F.length(text)).alias("now"),
    )
    rows = limits.join(facts, limits.book == F.col("_b"), "left")
    if previous is not None:
        rows = rows.join(previous.select(F.col("book").alias("_p"), F.col("chars").alias("before")), F.col("book") == F.col("_p"), "left")
    else:
        rows = rows.withColumn("before", F.lit(None).cast("long"))
    if nodes is not None:
        roots = nodes.where("parent is null").groupBy(F.col("book").alias("_r")).agg(F.array_sort(F.collect_list("id")).alias("roots"))  # a healthy book has one
        rows = rows.join(roots, F.col("book") == F.col("_r"), "left")
        strange = F.when(~F.coalesce(F.col("roots"), F.array().cast("array<string>")).eqNullSafe(F.array("root")), F.concat(F.lit("unexpected roots in manifest: "), F.array_join(F.coalesce("roots", F.array().cast("array<string>")), ",")))
    else:
        strange = F.lit(None).cast("string")
    n = F.coalesce("n", F.lit(0))
    few = F.when(n < F.col("min_documents"), F.concat(F.lit("only "), n.cast("string"), F.lit(" documents, expected >="), F.col("min_documents").cast("string")))
    rest = F.array_compact(F.array(
        few, strange,
        F.when(F.col("with_path") < MIN_WITH_PATH, "too few documents with a path"),
        F.when(F.col("with_content") < MIN_WITH_CONTENT, "too few documents with content"),
        F.when(F.col("empty") > MAX_EMPTY, F.concat(F.col("empty").cast("string"), F.lit(f" empty documents, at most {MAX_EMPTY} tolerated"))),
        F.when(F.col("units") < F.col("min_units"), F.concat(F.lit("only "), F.col("units").cast("string"), F.lit(" numbered units, expected >="), F.col("min_units").cast("string"))),
        F.when((F.col("before") > 0) & (F.abs(F.col("now") - F.col("before")) / F.col("before") > MAX_DRIFT), F.concat(F.lit("text volume changed from "), F.col("before").cast("string"), F.lit(" to "), F.col("now").cast("string"), F.lit(" chars"))),
    ))
    return rows.select("book", F.when(n == 0, F.array_compact(F.array(few))).otherwise(rest).alias("problems"))


def summary(stage: str, totals: DataFrame, missing: dict[str, int] | None = None) -> list[str]:
    """What a stage says in the end: a line for each row of ``totals`` (book and numbers), their sums, and a warning for each kind of thing that is missing."""
    numbers = [c for c in totals.columns if c != "book"]
    sums = totals.agg(*[F.sum(c).alias(c) for c in numbers]).withColumn("book", F.lit("total"))
    rows = totals.orderBy("book").collect() + sums.select(*totals.columns).collect()  # a row for each book
    said = [f"{stage}: {r['book']}: " + ", ".join(f"{r[c] or 0} {c}" for c in numbers) for r in rows]
    return said + [f"warning: {stage}: {n} {what}" for what, n in (missing or {}).items() if n]


def enforce(found: DataFrame, force: bool = False) -> list[str]:
    """Raise with every problem of every book, or, with ``force``, return them. One row a book comes to the driver."""
    lines = [f"{r['book']}: {p}" for r in found.where(F.size("problems") > 0).orderBy("book").collect() for p in r["problems"]]
    if lines and not force:
        raise DegradedCorpus("nothing was written:\n" + "\n".join(f"  - {x}" for x in lines))
    return lines


def drift(now: DataFrame, before: DataFrame, value: str) -> DataFrame:
    """Relative change of ``value`` from ``before`` to ``now`` for each book; 0 where there was nothing."""
    joined = now.select("book", F.col(value).alias("n")).join(before.select(F.col("book").alias("_b"), F.col(value).alias("p")), F.col("book") == F.col("_b"))
    return joined.select("book", F.when(F.col("p") != 0, (F.col("n") - F.col("p")) / F.col("p")).otherwise(0.0).alias("drift"))


def identity(pages: DataFrame, paths: DataFrame, head: str, crumb: str, counts: DataFrame | None = None) -> DataFrame:
    """(book, heads, crumbs, matched, problems): whether sampled pages (book, text) are of the book they are taken for.

    ``head`` finds a running header's book, ``crumb`` a page's breadcrumb, which
    must begin a known path or be begun by one (``paths``: path). ``counts``
    (book, pages) brings the test that there are pages at all.
    """
    dashed = F.when(F.col("text").rlike(f"[{tx.DASHES}]"), F.translate("text", tx.DASHES, "-" * len(tx.DASHES))).otherwise(F.col("text"))
    p = pages.select("book", dashed.alias("page"))
    # texts are searched once; what is found in them is small
    p = written(p.select("book", F.array_distinct(F.regexp_extract_all("page", F.lit(head), F.lit(1))).alias("found"), tx.spaced(F.regexp_extract("page", crumb, 1)).alias("crumb")), "identity")
    heads = p.select(F.col("book").alias("_h"), F.explode("found").alias("head")).groupBy("_h").agg(F.array_join(F.array_sort(F.collect_set("head")), ",").alias("heads"))
    crumbs = p.select("book", "crumb").where("crumb <> ''")
    known = align.prefix_semi(crumbs, paths.select(tx.spaced(F.col("path")).alias("path")).distinct(), "crumb", "path").groupBy(F.col("book").alias("_m")).agg(F.count("*").alias("matched"))
    rows = p.select("book").distinct().join(crumbs.groupBy(F.col("book").alias("_c")).agg(F.count("*").alias("crumbs")), F.col("book") == F.col("_c"), "left")
    rows = rows.join(heads, F.col("book") == F.col("_h"), "left").join(known, F.col("book") == F.col("_m"), "left").na.fill(0, ["crumbs", "matched"])
    empty = F.lit(None).cast("string")
    if counts is not None:
        rows = rows.join(counts.select(F.col("book").alias("_n"), "pages"), F.col("book") == F.col("_n"), "left")
        empty = F.when(F.coalesce("pages", F.lit(0)) <= 0, "no pages")
    wrong = F.when(F.col("heads").isNull(), "no running header").when(F.col("heads") != F.col("book"), F.concat(F.lit("header says "), "heads"))
    strange = F.when((F.col("crumbs") >= 2) & (F.col("crumbs") - F.col("matched") > F.floor(F.col("crumbs") / 2)), "sections are not in the tree")
    return rows.select("book", F.coalesce("heads", F.lit("")).alias("heads"), "crumbs", "matched", F.concat_ws("; ", empty, wrong, strange).alias("problems"))
