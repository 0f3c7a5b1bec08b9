"""The stages from a site to the deliverable, each a job over tables in one folder.

crawl (or refresh) -> parse -> changes -> export -> pdf -> compare -> bundle

A stage reads the tables of the stages before it. With some books chosen, the
rows of the others stay as they are.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliospark.functions import html
from foliospark.functions import text as tx
from foliospark.operators import align, changes, compare, coverage, guard, index, ranks, render, sections, tree, units
from foliospark.operators.lineage import written
from foliospark.sources import bundle as deliverable
from foliospark.sources import crawl as site
from foliospark.sources import download, files, pdf, versions, web

# Fixed value: kinds of nodes that files are made for, by their titles; documents go to the nearest of the first kind they have.
KINDS = {"title": r"(?i)^t[íi]tulo\b", "letter": r"^(Letra\s+)?[A-Z](\.\d+)?[.\s]", "chapter": r"(?i)^cap[íi]tulo\b"}
#: Folders that a stage replaces as a whole.
TABLES = ("pages", "nodes", "images", "documents", "changes", "unit_events", "sections", "figures", "publication", "coverage", "coverage_report")


@dataclass
class Context:
    """What a stage works with: the chosen books, where pages are and where results go."""

    spark: SparkSession
    books: DataFrame
    base: str
    out: str
    force: bool = False
    settings: dict = field(default_factory=dict)
    ask: site.Ask = web.fetched

    def __post_init__(self) -> None:
        for kind in TABLES:
            files.settle(self.spark, self.path(kind))

    def rows(self) -> list:
        return self.books.orderBy("ord").collect()  # as many as the configuration has

    def slugs(self) -> list[str]:
        return [r["slug"] for r in self.rows()]

    def path(self, kind: str) -> str:
        return f"{self.out}/{kind}"

    def has(self, kind: str) -> bool:
        return files.exists(self.spark, self.path(kind))

    def read(self, kind: str) -> DataFrame:
        return self.spark.read.parquet(self.path(kind))

    def own(self, df: DataFrame) -> DataFrame:
        """The rows of the chosen books."""
        return df.where(F.col("book").isin(self.slugs()))

    def keep(self, df: DataFrame, kind: str) -> DataFrame:
        """Replace the chosen books' rows of a table by ``df``; what was written."""
        made = written(df, kind)
        if self.has(kind):
            others = self.read(kind).where(~F.col("book").isin(self.slugs()))
            made = written(made.unionByName(others, allowMissingColumns=True), kind)
        files.staged(made, self.path(kind))
        return self.own(self.read(kind))

    def option(self, section: str, name: str, default):
        return self.settings.get(section, {}).get(name, default)


# ------------------------------------------------------------------------ crawl
def crawl(ctx: Context, revalidate: bool = False) -> None:
    """Pages, tree and images of each book below its root; pages that the cache has are not asked for again."""
    page, block = ctx.option("crawl", "page", "{}"), ctx.option("crawl", "menu", "(?s)<nav>(.*?)</nav>")
    at_a_time = ctx.option("crawl", "at_a_time", 3)
    before, _, after = page.partition("{}")
    link = f'(?s)<a [^>]*?href="/?{re.escape(before)}([^"#]*?){re.escape(after)}"[^>]*>(.*?)</a>'
    found, trees = [], []
    for r in ctx.rows():
        cache = ctx.path(f"site/{r['slug']}")
        ids = lambda c: F.array_distinct(F.regexp_extract_all(F.regexp_extract(c, block, 1), F.lit(link), F.lit(1)))
        site.crawl(ctx.spark, ctx.base, r["pvid"], cache, revalidate, at_a_time, ctx.ask, page, ids)
        own = written(site.pages(ctx.spark, cache), "pages").withColumn("book", F.lit(r["slug"]))
        found.append(own)
        marks = own.select(F.col("page_id").alias("_p"), "last_modified")
        nodes = web.crawl(own.where("html is not null"), r["pvid"], block, link, html.MARKS["open"]).join(marks, F.col("id") == F.col("_p"), "left").drop("_p")
        trees.append(nodes.withColumn("book", F.lit(r["slug"])))
    pages = functools.reduce(DataFrame.unionByName, found)
    ctx.keep(functools.reduce(DataFrame.unionByName, trees), "nodes")
    kept = ctx.keep(pages.where("html is not null").select("book", "page_id", "html"), "pages")
    known = ctx.read("images") if ctx.has("images") else ctx.spark.createDataFrame([], "src string, sha256 string, file string")
    bodies = kept.select("page_id", tx.fragment(F.col("html"), html.MARKS["open"], html.MARKS["close"]).alias("html")).where("html is not null")
    images = written(web.new_images(bodies, known, ctx.base, at_a_time, ctx.ask), "images")
    versions.write(images.where("content is not null").select("sha256", "file", "content").dropDuplicates(["sha256"]), ctx.path("image_files"), append=True)
    files.staged(written(known.unionByName(images.where("sha256 is not null").select("src", "sha256", "file")), "images"), ctx.path("images"))


def refresh(ctx: Context) -> None:
    """As ``crawl``, but the site is asked what has changed."""
    crawl(ctx, revalidate=True)


# ------------------------------------------------------------------------ parse
def parse(ctx: Context) -> None:
    """Pages (book, page_id, html) to documents; converted once and checked before they are published."""
    pages = ctx.own(ctx.read("pages"))
    images = ctx.read("images") if ctx.has("images") else None
    made = html.parsed(pages, images, base=ctx.base).join(pages.select(F.col("page_id").cast("string").alias("pid"), "book"), F.col("pvid") == F.col("pid")).drop("pid")
    made = written(made.withColumn("n_units", F.size(F.filter(F.split("markdown", "\n\n"), lambda b: b.rlike(units.UNIT_START)))), "documents")
    numbered = F.when(F.col("n_units") > 0, F.sequence(F.lit(1), F.greatest("n_units", F.lit(1))))
    limits = ctx.books.select(F.col("slug").alias("book"), F.col("pvid").alias("root"), "min_documents", "min_units")
    previous = ctx.own(ctx.read("documents")).groupBy("book").agg(F.sum(F.length("markdown")).alias("chars")) if ctx.has("documents") else None
    nodes = ctx.own(ctx.read("nodes")).select("book", "id", "parent") if ctx.has("nodes") else None
    facts = made.select("book", "markdown", "figures", "path", numbered.alias("units"))
    for line in guard.enforce(guard.problems(facts, limits, previous, nodes), ctx.force):
        print(f"warning: {line}")
    ctx.keep(made.drop("n_units"), "documents")
    totals = made.groupBy("book").agg(F.count("*").alias("documents"), F.sum("n_units").alias("units"), F.sum(F.size("figures")).alias("figures"))
    lost = made.agg(F.sum(F.size(F.regexp_extract_all("markdown", F.lit(r"\[\[FIG-MISSING:"), F.lit(0)))).alias("n")).first()["n"]
    for line in guard.summary("parse", totals, {"images are missing": lost or 0}):
        print(line)
    runs = guard.metrics(made.select("book", "markdown", "figures", F.col("amendment_notes").alias("notes"), numbered.alias("units")))
    files.write_json_lines(runs.withColumn("at", F.current_timestamp()), ctx.path("runs"), ["book"], append=True)


# ---------------------------------------------------------------------- changes
def _event_lines(events: DataFrame) -> DataFrame:
    """(doc_id, lines) of unit events, in the order of their kinds and numbers."""
    number = F.coalesce("number", F.lit("preamble"))
    said = F.when(F.col("type") == "renumbered", F.concat(F.lit("- N° "), F.coalesce("from_number", F.lit("preamble")), F.lit(" → N° "), number, F.lit(" (renumbered, same text)")))
    for kind in ("modified", "added", "removed"):
        said = said.when(F.col("type") == kind, F.concat(F.lit("- **N° "), number, F.lit(f" {kind}**")))
    shown = F.when(F.col("type") == "modified", F.concat(F.lit("\n\n```diff\n"), "diff", F.lit("\n```\n"))).when(F.col("type") != "renumbered", F.concat(F.lit("\n\n  > "), F.left("text", F.lit(300)), F.lit("\n")))
    rows = events.withColumn("line", F.concat(said, F.coalesce(shown, F.lit(""))))
    return rows.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("type", F.try_to_number("number", F.lit("999")).alias("n"), "line"))), lambda x: x["line"]), "\n").alias("lines"))


def changed(ctx: Context) -> None:
    """Documents and their numbered units against the last snapshot; the snapshot moves on after the reports are written."""
    state = ctx.path("state")
    now = ctx.own(ctx.read("documents")).select("book", F.col("pvid").alias("doc_id"), "url", "citation", "source_sha256", "content_sha256", F.col("amendment_notes").alias("notes"), "markdown")
    others = None
    if versions.exists(ctx.spark, state):
        last = versions.read(ctx.spark, state)
        others, before = last.where(~F.col("book").isin(ctx.slugs())), ctx.own(last)
        found = written(changes.compare(before, now).where("category is not null"), "changes")
        facts = lambda df, p: df.select(F.col("doc_id").alias("_d"), *(F.col(c).alias(f"{p}_{c}") for c in ("book", "citation", "url")))
        told = found.join(facts(now, "n"), F.col("doc_id") == F.col("_d"), "left").drop("_d").join(facts(before, "o"), F.col("doc_id") == F.col("_d"), "left").drop("_d")
        told = told.select(F.coalesce("n_book", "o_book").alias("book"), "doc_id", "category", "new_notes", F.coalesce("n_citation", "o_citation").alias("citation"), F.coalesce("n_url", "o_url").alias("url"))
        told = ctx.keep(told, "changes")
        touched = found.where(F.col("category").isin("normative", "editorial", "pipeline")).select("doc_id")
        segments = lambda df: written(units.segment(df.join(touched, "doc_id", "left_semi"), text="markdown"), "units")
        events = units.exact_events(segments(before), segments(now)).join(told.select(F.col("doc_id").alias("_d"), "book"), F.col("doc_id") == F.col("_d")).drop("_d")
        _changelog(ctx, told, ctx.keep(events, "unit_events"))
    versions.write(now if others is None else now.unionByName(others), state)
    versions.vacuum(ctx.spark, state, keep=2)


def _changelog(ctx: Context, told: DataFrame, events: DataFrame) -> None:
    """One Markdown file for each book that has changes, in a folder of this run."""
    rank = changes.severity(F.col("category"))
    notes = F.array_join(F.transform("new_notes", lambda x: F.concat(F.lit("- **new note:** "), x)), "\n")
    rows = told.join(_event_lines(events).withColumnRenamed("doc_id", "_d"), F.col("doc_id") == F.col("_d"), "left")
    nth = F.row_number().over(Window.partitionBy("book", "category").orderBy("citation", "doc_id"))
    size = F.count("*").over(Window.partitionBy("book", "category"))
    block = F.array_join(F.array_compact(F.array(F.when(F.col("nth") == 1, F.concat(F.lit("## "), "category", F.lit(" ("), F.col("size").cast("string"), F.lit(")\n"))), F.concat(F.lit("### "), "citation", F.lit("\n\n"), "url", F.lit("\n")), F.when(notes != "", notes), F.col("lines"))), "\n")
    rows = rows.withColumn("nth", nth).withColumn("size", size).select("book", rank.alias("rank"), "nth", block.alias("block"))
    counts = told.groupBy("book").agg(*[F.count_if(F.col("category") == c).alias(c) for c in changes.CATEGORIES])
    table = F.concat(F.lit("| class | documents | meaning |\n| --- | ---: | --- |\n"), *[F.concat(F.lit(f"| {c} | "), F.col(c).cast("string"), F.lit(f" | {changes.EXPLAIN[c]} |\n")) for c in changes.CATEGORIES])
    bodies = rows.groupBy("book").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "nth", "block"))), lambda x: x["block"]), "\n").alias("body"))  # a report of one run
    text = counts.withColumnRenamed("book", "_b").join(bodies, F.col("_b") == F.col("book")).select(F.concat("book", F.lit(".md")).alias("filename"), F.concat(F.lit("# Changes — "), "book", F.lit("\n\n"), table, F.lit("\n"), "body").alias("text"))
    stamp = ctx.spark.range(1).select(F.date_format(F.current_timestamp(), "yyyyMMdd'T'HHmmssSSS")).first()[0]
    files.write_markdown(text, ctx.path(f"changelog/{stamp}"))


# ----------------------------------------------------------------------- export
def _sectioned(ctx: Context, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each document with its file (book, group, part, place in reading order), and one row for each file with its name."""
    if ctx.has("nodes"):
        nodes = ctx.own(ctx.read("nodes"))
        key = lambda c: F.concat_ws("/", "book", c)
        keyed = nodes.select(key("id").alias("id"), F.when(F.col("parent").isNotNull(), key("parent")).alias("parent"), "sib_ord", "title", "book")
        level = written(tree.levels(keyed), "levels")
        kind = F.coalesce(*[F.when(F.col("title").rlike(p), k) for k, p in KINDS.items()])
        place = tree.preorder(level).select(F.col("id").alias("_i"), "position")
        group = tree.nearest(level, keyed.select("id", kind.alias("kind")), list(KINDS)).select(F.col("id").alias("_g"), "group_id")
        titled = keyed.select(F.col("id").alias("_t"), F.col("title").alias("group_title"))
        chain = level.select(F.col("id").alias("_c"), "chain")
        rows = docs.withColumn("_k", key("pvid")).join(place, F.col("_k") == F.col("_i")).join(group, F.col("_k") == F.col("_g")).join(titled, F.col("group_id") == F.col("_t")).join(chain, F.col("_k") == F.col("_c")).drop("_k", "_i", "_g", "_t", "_c")
    else:  # pages that were not crawled: one group a book, in the order of their ids
        ids = docs.select(F.col("book").alias("_b"), F.col("pvid").alias("_p"), F.length("pvid").alias("_l"))
        placed = ranks.numbered(ids, ["_l", "_p"], ["_b"], "position").drop("_l")
        rows = docs.join(placed, (F.col("book") == F.col("_b")) & (F.col("pvid") == F.col("_p"))).drop("_b", "_p")
        rows = rows.withColumns({"group_id": F.col("book"), "group_title": F.col("book"), "chain": F.array("book", F.concat_ws("/", "book", "pvid"))})
    packed = written(sections.pack(rows.withColumn("words", tx.word_count(F.col("markdown"))), "group_id", "position", "words"), "packed")
    made = packed.groupBy("book", "group_id", "group_title", "part", "parts").agg(F.sum("words").alias("words"), F.count("*").alias("documents"), F.min_by("path", "position").alias("path"))
    order = packed.groupBy("book", "group_id").agg(F.min("position").alias("_f"))
    order = ranks.numbered(order, ["_f"], ["book"], "_at").select(F.col("group_id").alias("_g"), (F.col("_at") + 1).alias("index"))
    made = ranks.numbered(made.join(order, F.col("group_id") == F.col("_g")).drop("_g"), ["index", "part"], ["book"], "_at").withColumn("sequence", F.col("_at") + 1).drop("_at")
    title = F.when(F.col("group_title") != "", F.col("group_title")).otherwise(F.col("group_id"))
    made = made.withColumn("group_title", title).withColumn("filename", sections.part_name(*(F.col(c) for c in ("sequence", "index", "group_title", "part", "parts"))))
    return packed, made


def _section_texts(ctx: Context, packed: DataFrame, made: DataFrame) -> DataFrame:
    """(book, filename, text): front matter, heading, the way to the other parts, and the documents under the headings of their ancestors."""
    below = F.slice("chain", F.array_position("chain", F.col("group_id")).cast("int") + 1, F.size("chain"))
    rows = packed.withColumn("below", F.when(F.array_contains("chain", F.col("group_id")), below).otherwise(F.array().cast("array<string>")))
    if ctx.has("nodes"):
        links = rows.select("book", "group_id", "part", "position", F.posexplode("below").alias("pos", "ancestor"))
        first = tree.emitted_once(links, F.struct("group_id", "part"), F.col("ancestor"), [F.col("position"), F.col("pos")])
        titles = ctx.own(ctx.read("nodes")).select(F.concat_ws("/", "book", "id").alias("_t"), "title")
        head = F.concat(F.repeat(F.lit("#"), F.least(F.lit(6), F.col("pos") + 2).cast("int")), F.lit(" "), "title")
        heads = first.join(titles, F.col("ancestor") == F.col("_t")).groupBy("group_id", "part", "position").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", head.alias("head")))), lambda x: x["head"]), "\n\n").alias("heads"))
        rows = rows.join(heads, ["group_id", "part", "position"], "left")
    else:
        rows = rows.withColumn("heads", F.lit(None).cast("string"))
    level = F.least(F.lit(6), F.size("below") + 1)
    body = F.coalesce(*[F.when(level == n, tx.demote(F.col("resolved"), n)) for n in range(1, 7)])
    topics = F.when(F.size("topics") > 0, F.concat(F.lit("*Materias: "), F.array_join("topics", ", "), F.lit("*")))
    source = F.concat(F.lit("**Fuente oficial:** "), "citation", F.lit(" · "), "url")
    block = F.array_join(F.array_compact(F.array(F.col("heads"), F.concat(F.lit("**Cita:** "), "citation"), topics, tx.strip(body), source)), "\n\n")
    bodies = rows.groupBy("group_id", "part").agg(F.array_sort(F.collect_list(F.struct("position", "pvid", block.alias("block")))).alias("l"))  # at most the size of a file
    family = Window.partitionBy("group_id").orderBy("part")
    named = made.withColumn("previous", F.lag("filename").over(family)).withColumn("following", F.lead("filename").over(family)).join(bodies, ["group_id", "part"])
    quoted = lambda c: F.to_json(F.array(c)).substr(F.lit(2), F.length(F.to_json(F.array(c))) - 2)
    front = [("book", F.col("book")), ("section_pvid", F.regexp_extract("group_id", "([^/]*)$", 1)), ("level", F.lit("title")), ("order", F.col("index")), ("part", F.col("part")), ("parts", F.col("parts")), ("title", quoted(F.col("group_title"))), ("path", quoted(F.coalesce("path", F.lit("")))), ("documents", F.to_json(F.transform("l", lambda x: x["pvid"]))), ("source", F.lit("web"))]
    way = sections.navigation(F.col("part"), F.col("parts"), F.col("previous"), F.col("following"))
    text = F.array_join(F.array_compact(F.array(tx.strip(files.front_matter(front)), sections.heading(F.col("group_title"), F.col("part"), F.col("parts")), way, F.array_join(F.transform("l", lambda x: x["block"]), "\n\n"))), "\n\n")
    return named.select("book", "filename", text.alias("text"))


def _resolved(ctx: Context, docs: DataFrame) -> DataFrame:
    """Documents with their figures' markers as links to where the images are."""
    if not ctx.has("images"):
        return docs.withColumn("resolved", html.resolve(F.col("markdown"), F.create_map().cast("map<string,string>"), ctx.base))
    places = ctx.read("images").groupBy("sha256").agg(F.min("src").alias("src"))
    pairs = docs.select("book", "pvid", F.explode(F.array_distinct("figures")).alias("sha256")).join(places, "sha256").groupBy(F.col("book").alias("_b"), F.col("pvid").alias("_p")).agg(F.map_from_entries(F.collect_list(F.struct("sha256", "src"))).alias("places"))  # of one document
    rows = docs.join(pairs, (F.col("book") == F.col("_b")) & (F.col("pvid") == F.col("_p")), "left").drop("_b", "_p")
    return rows.withColumn("resolved", html.resolve(F.col("markdown"), F.coalesce("places", F.create_map().cast("map<string,string>")), ctx.base)).drop("places")


def export(ctx: Context) -> None:
    """Files by title in reading order, cut to size between documents; documents as JSON lines; figures and who cites them."""
    docs = _resolved(ctx, ctx.own(ctx.read("documents")))
    packed, made = _sectioned(ctx, docs)
    texts = written(_section_texts(ctx, packed, made), "texts")
    named = made.join(texts.withColumnRenamed("book", "_b").withColumnRenamed("filename", "_f"), (F.col("book") == F.col("_b")) & (F.col("filename") == F.col("_f"))).drop("_b", "_f")
    whole = ctx.keep(named, "sections")
    every = ctx.read("sections")
    files.write_markdown(every.select(F.concat("book", F.lit("/"), "filename").alias("filename"), "text"), ctx.path("markdown"))
    files.write_json_lines(docs.withColumn("markdown", F.col("resolved")).drop("resolved"), ctx.path("documents_jsonl"), ["book", "pvid"])
    files.staged(index.usage(docs, "pvid", "pvid", F.col("figures")), ctx.path("figures"))
    print(f"export: {whole.count()} files")


# -------------------------------------------------------------- pdf and compare
def publication(ctx: Context) -> None:
    """The second publication of each book that names one (``pdf_file``): asked for only if it has changed, and taken only if it is that book's.

    Files of extracted text (pages between form feeds) are taken as they are,
    others read by poppler where it is installed.
    """
    head, crumb = ctx.option("pdf", "head", r"(?m)^.*-\s*(Libro [IVXLC]+)\s*$"), ctx.option("pdf", "crumb", r"(?m)^(Libro\s+[IVXLC]+\s*,.+)$")
    paths = ctx.own(ctx.read("documents")).where("path <> ''")
    known = {r["book"]: r.asDict() for r in versions.read(ctx.spark, ctx.path("downloads")).collect()} if versions.exists(ctx.spark, ctx.path("downloads")) else {}
    client, texts = web.Client(pause=ctx.option("crawl", "pause", web.PAUSE)), []
    for r in ctx.rows():
        if not r["pdf_file"]:
            continue
        target = Path(ctx.path(f"books/{r['slug']}{Path(r['pdf_file']).suffix}").removeprefix("file://"))

        def pages_in(path: Path, book: str = r["slug"]) -> DataFrame:
            read = ctx.spark.read.text(f"file://{path.resolve()}", wholetext=True).select(F.col("value").alias("text")) if ".txt" in path.name else pdf.texts(ctx.spark, f"file://{path.resolve()}")
            return pdf.pages_of_text(read.select(F.lit(book).alias("book"), "text"))

        def verify(path: Path, roman: str = r["roman"], book: str = r["slug"]) -> list[str]:
            pages = written(pages_in(path), "publication")
            counts = pages.agg(F.count("*").alias("pages")).withColumn("book", F.lit(roman))
            sampled = align.block_sample(pages.withColumn("n", F.lit(counts.first()["pages"])), "page", F.col("n"))
            found = guard.identity(sampled.withColumn("book", F.lit(roman)), paths.where(F.col("book") == book).select("path"), head, crumb, counts).collect()
            return [x["problems"] for x in found if x["problems"]] or ([] if found else ["no pages"])

        marks = {k: v for k, v in known.get(r["slug"], {}).items() if k != "book"}
        state, marks = download.fetch(client, ctx.base + r["pdf_file"], target, marks, verify)
        known[r["slug"]] = marks | {"book": r["slug"]}
        texts.append(pages_in(target))
        print(f"pdf: {r['slug']}: {state}")
    client.close()
    if texts:
        ctx.keep(functools.reduce(DataFrame.unionByName, texts), "publication")
        versions.write(ctx.spark.createDataFrame([(x["book"], x.get("etag", ""), x.get("last_modified", ""), x.get("size", "")) for x in known.values()], "book string, etag string, last_modified string, size string"), ctx.path("downloads"))


def compared(ctx: Context) -> None:
    """Documents against the second publication: what each side has that the other lacks, a report for each book, and its text by documents."""
    if not ctx.has("publication"):
        print("compare: there is no second publication")
        return
    docs = ctx.own(ctx.read("documents")).select("book", F.col("pvid").alias("id"), "path", "title", "markdown")
    pages = ctx.own(ctx.read("publication")).withColumn("text", tx.canonical(F.col("text")))
    other = written(compare.aligned(docs, pages), "aligned")
    titles = ctx.own(ctx.read("nodes")).select("book", "title") if ctx.has("nodes") else None
    found = ctx.keep(written(compare.compared(docs, other, titles), "coverage"), "coverage")
    ctx.keep(compare.report(docs, found), "coverage_report")
    reports = []
    for slug in ctx.slugs():
        judged = found.where(F.col("book") == slug).select(F.col("id").alias("doc_id"), F.col("pdf_words").alias("total"), F.col("only_in_pdf").alias("n_only"), F.col("coverage_pdf").alias("coverage"), "verdict", "extra_in_pdf")
        shown = judged.select("doc_id", F.posexplode("extra_in_pdf").alias("run", "passage")).withColumn("run", F.col("run") + 1)
        lines = render.coverage_report(judged.drop("extra_in_pdf"), slug, passages=shown)
        reports.append(lines.groupBy().agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("section", "ord", "line"))), lambda x: x["line"]), "\n").alias("text")).select(F.lit(f"{slug}.md").alias("filename"), "text"))  # a report has a line for each of its first documents
    files.write_markdown(functools.reduce(DataFrame.unionByName, reports), ctx.path("comparison"))
    body = other.join(found.select("book", "id", "verdict"), ["book", "id"]).join(docs.select("book", "id", "title"), ["book", "id"])
    lines = render.publication_section(body.withColumn("body", tx.pdf_markdown(F.col("text"), F.col("title"))), ["book"], ["head"])
    text = lines.groupBy("book").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("section", "ord", "line"))), lambda x: x["line"]), "\n\n").alias("text"))
    files.write_markdown(text.select(F.concat("book", F.lit(".md")).alias("filename"), "text"), ctx.path("publication_markdown"))


# ----------------------------------------------------------------------- bundle
def _profiles(docs: DataFrame, packed: DataFrame) -> DataFrame:
    """Documents with what an index says of them: their title's group, numbers, notes, words, amendments."""
    rows = docs.join(packed.select(F.col("book").alias("_b"), F.col("pvid").alias("_p"), "group_id", "group_title", "position", "words"), (F.col("book") == F.col("_b")) & (F.col("pvid") == F.col("_p")))
    count = F.size(F.filter(F.split("markdown", "\n\n"), lambda b: b.rlike(units.UNIT_START)))
    return rows.withColumns({"units": count, "notes": F.size("amendment_notes"), "excerpt": tx.excerpt(F.col("markdown")), "amendment": F.transform("amendment_notes", tx.amendment)})


def bundled(ctx: Context) -> None:
    """The deliverable: all files of all books, an index for each, and one of all books where all are there."""
    docs = _resolved(ctx, ctx.own(ctx.read("documents")))
    packed, made = _sectioned(ctx, docs)
    rows = written(_profiles(docs, packed).drop("chain"), "profiles")
    amended = rows.select("book", "group_title", "position", F.explode("amendment").alias("a")).where("a is not null").select("book", "group_title", "position", "a.*")
    parts = []
    profile = index.profile(rows.withColumn("amendments", F.transform("amendment", lambda a: F.to_json(a))), ["book", "group_id", "group_title"], "position")
    profile = profile.join(made.select(F.col("group_id").alias("_g"), "index").distinct(), F.col("group_id") == F.col("_g")).withColumnRenamed("group_title", "title")
    for slug in ctx.slugs():
        own = lambda df, book=slug: df.where(F.col("book") == book)
        topics = index.topic_index(own(rows).select("group_title", F.explode("topics").alias("topic")), "topic", "group_title")
        latest = index.latest(own(amended), "number", "date", "group_title", "position")
        lines = render.book_index(own(profile), own(made), topics, latest, slug)
        parts.append(lines.withColumn("book", F.lit(slug)))
    indexes = written(functools.reduce(DataFrame.unionByName, parts), "indexes")
    totals = rows.groupBy("book").agg(F.count("*").alias("documents"), F.sum("units").alias("units"), F.sum("notes").alias("notes"), F.sum("words").alias("words"))
    across = rows.select("book", F.explode("topics").alias("topic")).groupBy("topic").agg(F.array_sort(F.collect_set("book")).alias("in_books")).where(F.size("in_books") > 1)
    recent = amended.groupBy("number").agg(F.max("date").alias("date"))
    expected = len(ctx.settings.get("books", [])) or len(ctx.slugs())
    root = render.root_index(totals, across, expected, recent, files=made)
    deliverable.bundle(ctx.own(ctx.read("sections")).select("book", "filename", "text"), indexes, root, ctx.path("bundle"), expected)


STAGES: dict[str, Callable[[Context], None]] = {"crawl": crawl, "refresh": refresh, "parse": parse, "changes": changed, "export": export, "pdf": publication, "compare": compared, "bundle": bundled}
#: ``refresh`` is instead of ``crawl``, not after it.
DEFAULT = tuple(s for s in STAGES if s != "refresh")
