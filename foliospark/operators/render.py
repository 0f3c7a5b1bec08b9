"""Reports as Markdown rows (ord, line): each line is a row, so a report of any length is made and written by tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions import text as tx
from foliospark.operators import analytics, ranks
from foliospark.operators.lineage import written


def _lines(df: DataFrame, section: int, order: list, line: Column) -> DataFrame:
    """Rows of a section in their order; ranks of a report's rows, which are few, are made in one window a section."""
    place = F.row_number().over(Window.partitionBy(F.lit(section)).orderBy(*order))
    return df.select(F.lit(section).alias("section"), place.cast("long").alias("ord"), line.alias("line"))


def _fixed(df: DataFrame, section: int, lines: list[str]) -> DataFrame:
    return df.sparkSession.createDataFrame([(section, i, x) for i, x in enumerate(lines)], "section int, ord long, line string")


def row(*cells: Column) -> Column:
    """Cells as a line of a Markdown table; pipes in them are escaped."""
    text = [F.replace(F.coalesce(c.cast("string"), F.lit("")), F.lit("|"), F.lit("\\|")) for c in cells]
    return F.concat(F.lit("| "), F.concat_ws(" | ", *text), F.lit(" |"))


def _percent(c: Column, digits: int = 1) -> Column:
    return F.concat(F.format_string(f"%.{digits}f", 100 * c), F.lit("%"))


#: Documents of a report whose passages are shown, passages of each, and characters of each.
SHOWN, EACH, LONGEST = 10, 2, 400


def most_missing(judged: DataFrame) -> DataFrame:
    """(_d, n_only): the documents whose passages a report shows."""
    return judged.where("n_only > 0").orderBy(F.desc("n_only"), "doc_id").limit(SHOWN).select(F.col("doc_id").alias("_d"), "n_only")


def coverage_report(judged: DataFrame, title: str, top: int = 25, passages: DataFrame | None = None, figures: DataFrame | None = None) -> DataFrame:
    """Totals, verdicts and the documents with most text that only one side has (doc_id, total, n_only, coverage, verdict).

    ``passages`` (doc_id, run, passage) are shown for the first of these;
    ``figures`` (side, n) counts those that both sides or one side has.
    """
    parts = _coverage_parts(judged, title, top)
    if passages is not None:
        first = most_missing(judged)
        shown = passages.where(F.col("run") <= EACH).join(F.broadcast(first), F.col("doc_id") == F.col("_d"))  # of a few documents
        line = F.concat(F.lit("> "), "doc_id", F.lit(": "), F.regexp_replace(F.left("passage", F.lit(LONGEST)), r"\s+", " "))
        parts = parts.unionByName(_fixed(judged, 5, ["## passages that only this side has"])).unionByName(_lines(shown, 6, [F.desc("n_only"), "doc_id", "run"], line))
    if figures is not None:
        parts = parts.unionByName(_fixed(judged, 7, ["| figures | number |", "| --- | ---: |"])).unionByName(_lines(figures, 8, ["side"], row(F.col("side"), tx.thousands(F.col("n")))))
    return parts


def _coverage_parts(judged: DataFrame, title: str, top: int) -> DataFrame:
    total, only = F.sum("total"), F.sum("n_only")
    facts = judged.agg(F.count("*").alias("documents"), F.coalesce(total, F.lit(0)).alias("total"), F.coalesce(only, F.lit(0)).alias("extra"))
    pairs = facts.select(F.explode(F.array(F.struct(F.lit(0).alias("o"), F.lit("documents").alias("k"), F.col("documents").alias("v")), F.struct(F.lit(1).alias("o"), F.lit("positions compared").alias("k"), F.col("total").alias("v")), F.struct(F.lit(2).alias("o"), F.lit("only on one side").alias("k"), F.col("extra").alias("v")))).alias("x")).select("x.*")
    verdicts = judged.groupBy("verdict").agg(F.count("*").alias("n"))
    most = judged.where("n_only > 0").orderBy(F.desc("n_only"), "doc_id").limit(top)
    return (
        _fixed(judged, 0, [f"# {title}", "| what | number |", "| --- | ---: |"])
        .unionByName(_lines(pairs, 1, ["o"], row(F.col("k"), tx.thousands(F.col("v")))))
        .unionByName(_lines(verdicts, 2, [F.desc("n"), "verdict"], row(F.col("verdict"), tx.thousands(F.col("n")))))
        .unionByName(_fixed(judged, 3, ["| document | only here | coverage |", "| --- | ---: | ---: |"]))
        .unionByName(_lines(most, 4, [F.desc("n_only"), "doc_id"], row(F.col("doc_id"), tx.thousands(F.col("n_only")), _percent(F.col("coverage")))))
    )


def publication_section(docs: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """(key..., section, ord, line): documents as a second publication has them, in order.

    ``docs``: title, page, page_end, verdict, body (Markdown). A document whose
    alignment is doubtful opens with a warning.
    """
    pages = F.concat(F.lit("*p. "), F.col("page").cast("string"), F.when(F.col("page_end") != F.col("page"), F.concat(F.lit("-"), F.col("page_end").cast("string"))).otherwise(""), F.lit("*"))
    warning = F.when(F.col("verdict") == "unaligned", F.lit("> **unaligned**: this text may hold more than its document"))
    lines = F.filter(F.array(F.concat(F.lit("## "), "title"), pages, warning, F.col("body")), lambda x: x.isNotNull())
    numbered = ranks.numbered(docs, order, key, "section").withColumn("section", (F.col("section") + 1).cast("int"))  # a book's texts are spread
    return numbered.select(*key, "section", F.posexplode(lines).alias("ord", "line"))


def book_index(profiles: DataFrame, files: DataFrame, topics: DataFrame, latest: DataFrame, title: str, recent: int = 12, figures: DataFrame | None = None, outline: DataFrame | None = None) -> DataFrame:
    """A book's index: titles with their profiles, files, topics with their titles, latest amendments; figures and an outline.

    ``profiles``: index, title, documents, units, notes, words, excerpt;
    ``files``: sequence, filename, words; ``topics``: topic, places (array);
    ``latest``: number, date, places (array); ``figures``: figure, uses,
    places (array); ``outline``: path_ord, depth, name, documents.
    """
    parts = _index_parts(profiles, files, topics, latest, title, recent)
    if figures is not None:
        where = F.array_join(F.col("places").cast("array<string>"), ", ")
        parts = parts.unionByName(_fixed(profiles, 8, ["| figure | uses | in |", "| --- | ---: | --- |"])).unionByName(_lines(figures, 9, [F.desc("uses"), "figure"], row(F.left("figure", F.lit(12)), tx.thousands(F.col("uses")), where)))
    if outline is not None:
        entry = F.concat(F.repeat(F.lit("  "), F.col("depth").cast("int")), F.lit("- "), "name", F.when(F.col("documents") > 0, F.concat(F.lit(" ("), tx.thousands(F.col("documents")), F.lit(")"))).otherwise(""))
        parts = parts.unionByName(_fixed(profiles, 10, ["## outline"])).unionByName(_lines(outline, 11, ["path_ord"], entry))
    return parts


def _index_parts(profiles: DataFrame, files: DataFrame, topics: DataFrame, latest: DataFrame, title: str, recent: int) -> DataFrame:
    last = latest.orderBy(F.desc("date"), F.desc("number")).limit(recent)
    joined = lambda c: F.array_join(F.col(c).cast("array<string>"), ", ")
    return (
        _fixed(profiles, 0, [f"# {title}", "| title | documents | numbers | notes | words | opens with |", "| --- | ---: | ---: | ---: | ---: | --- |"])
        .unionByName(_lines(profiles, 1, ["index"], row(F.col("title"), *[tx.thousands(F.col(c)) for c in ("documents", "units", "notes", "words")], F.col("excerpt"))))
        .unionByName(_fixed(profiles, 2, ["| file | words |", "| --- | ---: |"]))
        .unionByName(_lines(files, 3, ["sequence"], row(F.concat(F.lit("`"), "filename", F.lit("`")), tx.thousands(F.col("words")))))
        .unionByName(_fixed(profiles, 4, ["| topic | titles |", "| --- | --- |"]))
        .unionByName(_lines(topics, 5, ["topic"], row(F.col("topic"), joined("places"))))
        .unionByName(_fixed(profiles, 6, ["| amendment | date | in |", "| --- | --- | --- |"]))
        .unionByName(_lines(last, 7, [F.desc("date"), F.desc("number")], row(F.col("number"), tx.day_first(F.col("date")), joined("places"))))
    )


def root_index(books: DataFrame, topics: DataFrame, expected: int, recent: DataFrame, k: int = 15, files: DataFrame | None = None, verdicts: DataFrame | None = None) -> DataFrame:
    """The index of all books (book, documents, units, notes, words) with their totals; empty unless all ``expected`` books are there.

    ``files``: book, filename, words; ``verdicts``: book, verdict, n.
    """
    complete = books.agg((F.count_distinct("book") >= expected).alias("all"))  # one row
    body = (
        _fixed(books, 0, ["# Books", "| book | documents | numbers | notes | words |", "| --- | ---: | ---: | ---: | ---: |"])
        .unionByName(_lines(books, 1, ["book"], row(F.col("book"), *[tx.thousands(F.col(c)) for c in ("documents", "units", "notes", "words")])))
        .unionByName(_fixed(books, 2, ["| topic | books |", "| --- | --- |"]))
        .unionByName(_lines(topics, 3, ["topic"], row(F.col("topic"), F.array_join("in_books", ", "))))
        .unionByName(_lines(recent.orderBy(F.desc("date"), F.desc("number")).limit(k), 4, [F.desc("date"), F.desc("number")], row(F.col("number"), tx.day_first(F.col("date")))))
    )
    sums = books.agg(*[F.sum(c).alias(c) for c in ("documents", "units", "notes", "words")])
    body = body.unionByName(_lines(sums, 5, [F.lit(1)], row(F.lit("TOTAL"), *[tx.thousands(F.col(c)) for c in ("documents", "units", "notes", "words")])))
    if files is not None:
        link = F.concat(F.lit("[`"), "filename", F.lit("`]("), "book", F.lit("/"), "filename", F.lit(")"))
        body = body.unionByName(_fixed(books, 6, ["| file | words |", "| --- | ---: |"])).unionByName(_lines(files, 7, ["book", "filename"], row(link, tx.thousands(F.col("words")))))
    if verdicts is not None:
        body = body.unionByName(_fixed(books, 8, ["| book | verdict | documents |", "| --- | --- | ---: |"])).unionByName(_lines(verdicts, 9, ["book", "verdict"], row(F.col("book"), F.col("verdict"), tx.thousands(F.col("n")))))
    return body.crossJoin(F.broadcast(complete)).where("all").drop("all")


def timeline(counts: DataFrame, label: str, value: str, width: int = 40, named: int = 6) -> DataFrame:
    """A bar for each period, on a shared scale."""
    counts = written(counts, "counts")  # for its rows and their scale
    top = counts.agg(F.max(value).alias("_top"))  # one row
    rows = counts.crossJoin(F.broadcast(top))
    bar = analytics.bar(F.col(value).cast("double"), F.col("_top").cast("double"), width)
    return _lines(rows, 0, [label], F.concat(F.rpad(F.left(F.col(label).cast("string"), F.lit(named)), named, " "), F.lit(" "), F.rpad(bar, width, " "), F.lit(" "), F.col(value).cast("string")))


def ranked_bars(rows: DataFrame, label: str, value: str, shown: Column, width: int = 40, section: int = 0) -> DataFrame:
    """A bar for each row, the longest first, with its value as ``shown``."""
    rows = written(rows, "bars")  # for its bars and their scale
    top = rows.agg(F.max(value).alias("_top"))  # one row
    bar = analytics.bar(F.col(value).cast("double"), F.col("_top").cast("double"), width)
    return _lines(rows.crossJoin(F.broadcast(top)), section, [F.desc(value), label], F.concat(F.rpad(F.col(label).cast("string"), 16, " "), F.lit(" "), F.rpad(bar, width, " "), F.lit(" "), shown))


def trend_charts(years: DataFrame, timings: DataFrame, runs: DataFrame) -> DataFrame:
    """Amendments by year (year, n), the usual time of each stage (stage, median), and each stage's last runs (stage, values) as a line."""
    line = F.concat(F.rpad(F.col("stage"), 16, " "), F.lit(" "), tx.let(F.col("values"), analytics.sparkline))
    return (
        _fixed(years, 0, ["## amendments"]).unionByName(timeline(years, "year", "n").withColumn("section", F.lit(1)))
        .unionByName(_fixed(years, 2, ["## timings"])).unionByName(ranked_bars(timings, "stage", "median", F.format_string("%.2f s", F.col("median").cast("double")), section=3))
        .unionByName(_fixed(years, 4, ["## runs"])).unionByName(_lines(runs, 5, ["stage"], line))
    )


def state_charts(downloads: DataFrame, processing: DataFrame, verdicts: DataFrame, width: int = 40) -> DataFrame:
    """Volume (book, bytes), margins over what is expected (book, documents, margin), and each book's verdicts (book and a column for each) as one bar."""
    margin = F.concat(F.rpad(F.col("book"), 8, " "), F.lit(" "), F.lpad(F.col("documents").cast("string"), 8, " "), F.lit(" "), F.format_string("%+.1f%%", 100 * F.col("margin")))
    share = F.concat(F.rpad(F.col("book"), 8, " "), F.lit(" "), stacked([F.col(c).cast("double") for c in ("match", "reformatted", "extra_in_pdf", "unaligned")], width))
    return (
        _fixed(downloads, 0, ["## download"]).unionByName(ranked_bars(downloads, "book", "bytes", tx.human_bytes(F.col("bytes")), width, 1))
        .unionByName(_fixed(downloads, 2, ["## processing"])).unionByName(_lines(processing, 3, ["book"], margin))
        .unionByName(_fixed(downloads, 4, ["## coverage", "█ match ▓ reformatted ▒ extra ░ unaligned"])).unionByName(_lines(verdicts, 5, ["book"], share))
    )


def metrics_report(snap: DataFrame, trends: DataFrame, states: DataFrame, columns: list[str]) -> DataFrame:
    """A snapshot of all metrics (book and ``columns``) as a table, then its trend and state charts: (section, ord, line)."""
    head = [f"| book | {' | '.join(columns)} |", "| --- |" + " ---: |" * len(columns)]
    shift = lambda df, n: df.withColumn("section", (F.col("section") + n).cast("int"))
    return _fixed(snap, 0, ["# metrics", *head]).unionByName(_lines(snap, 1, ["book"], row(F.col("book"), *[F.col(c) for c in columns]))).unionByName(shift(trends, 10)).unionByName(shift(states, 20))


def stacked(parts: list[Column], width: int = 40, glyphs: str = "█▓▒░") -> Column:
    """Shares as one bar; the last segment takes what rounding leaves."""
    total = sum(parts[1:], parts[0])
    sizes = [F.bround(p / total * width, 0).cast("int") for p in parts[:-1]]
    used = sum(sizes[1:], sizes[0])
    segments = [F.repeat(F.lit(g), n) for g, n in zip(glyphs, [*sizes, F.greatest(F.lit(0), F.lit(width) - used)], strict=False)]
    return F.when(total > 0, F.concat(*segments)).otherwise("")


def snapshot(metrics: DataFrame, downloads: DataFrame, coverages: DataFrame) -> DataFrame:
    """All stored metrics of each book side by side (each has a column book)."""
    out = metrics
    for i, other in enumerate((downloads, coverages)):
        named = other.withColumnRenamed("book", f"_b{i}")
        out = out.join(named, F.col("book").eqNullSafe(F.col(f"_b{i}")), "left").drop(f"_b{i}")
    return out
