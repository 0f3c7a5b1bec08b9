"""Queries of HTML conversion, crawling, reports and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from foliospark.functions import html
from foliospark.functions import text as tx
from foliospark.operators import compare, coverage, render
from foliospark.operators.lineage import written
from foliospark.plans import trends
from foliospark.plans.changed import _JUDGED, _PASSAGES, _SH, _W
from foliospark.plans.texts import LOOSE_SQL, STRICT_SQL, sql_canonical, sql_words
from foliospark.plans.trees import _PACK_SQL, sequenced
from foliospark.plans.trends import _TOPICS
from foliospark.registry import query
from foliospark.sources import web
from foliospark.sources.tables import read
from foliospark.streaming import feeds


def site(spark, sf):
    """The test pages in the frame that the converter knows: breadcrumb, title, topics, body."""
    p = read(spark, sf, "pages")
    i = F.col("page_id").cast("string")
    lang = F.regexp_extract("html", 'lang="([^"]*)"', 1)
    head = F.concat(
        F.lit('<div class="SP_pa_breadcrum_ruta"><p><a class="pvid-1">Libro I. Todo</a><a class="pvid-2">Título '), F.upper(lang), F.lit('</a><a class="x">Letra A. Parte</a></p></div>'), F.lit('<h2 class="titulo">Capítulo '), i,
        F.lit('</h2><p class="voces">Materias asociadas:<a href="#">'), lang, F.lit("</a></p>"), F.lit(html.MARKS["open"]), F.lit(">"), F.col("html"), F.lit('<table><tr><th>a</th><td>b|c</td></tr><tr><td>1</td></tr></table><img src="x.png"><img src="y.png">'),
        F.lit("<h6>Nota de actualización: modificado</h6>"), F.lit(html.MARKS["close"]), F.lit("<p>footer</p>"),
    )
    return p.select("page_id", head.alias("html"))


def parsed(spark, sf):
    images = spark.createDataFrame([("x.png", "ab" * 32)], "src string, sha256 string")
    return html.parsed(site(spark, sf), images, base="https://example.org/")


@query("html_to_markdown")
def html_to_markdown(spark, sf):
    return parsed(spark, sf).select("pvid", "markdown", F.array_join("amendment_notes", "|").alias("notes"), F.array_join("figures", "|").alias("figures"))


@query("parsed_documents", """SELECT page_id::VARCHAR AS pvid, 'https://example.org/w3-propertyvalue-' || page_id || '.html' AS url, 'Capítulo ' || page_id AS title,
    'Libro I. Todo > Título ' || upper(regexp_extract(html, 'lang="([^"]*)"', 1)) || ' > Letra A. Parte' AS path, regexp_extract(html, 'lang="([^"]*)"', 1) AS topics,
    'Libro I. Todo > Título ' || upper(regexp_extract(html, 'lang="([^"]*)"', 1)) || ' > Letra A. Parte, Capítulo ' || page_id AS citation, sha256('<div id="cuerpo_documento">' || html || '<table><tr><th>a</th><td>b|c</td></tr><tr><td>1</td></tr></table><img src="x.png"><img src="y.png"><h6>Nota de actualización: modificado</h6>') AS source_sha256 FROM pages""")  # fmt: skip
def parsed_documents(spark, sf):
    return parsed(spark, sf).select("pvid", "url", "title", "path", "citation", "source_sha256", F.array_join("topics", ",").alias("topics"))


@query("hierarchy_levels", """SELECT page_id::VARCHAR AS pvid, 'Libro I. Todo' AS book, 'Título ' || upper(regexp_extract(html, 'lang="([^"]*)"', 1)) AS title, 'Letra A. Parte' AS letter, 'Capítulo ' || page_id AS chapter FROM pages""")
def hierarchy_levels(spark, sf):
    return parsed(spark, sf).select("pvid", "hierarchy.book", "hierarchy.title", "hierarchy.letter", "hierarchy.chapter")


@query("breadcrumb_links", """SELECT page_id, '1:Libro I. Todo|2:Título ' || upper(regexp_extract(html, 'lang="([^"]*)"', 1)) || '|:Letra A. Parte' AS crumbs FROM pages""")
def breadcrumb_links(spark, sf):
    crumbs = F.transform(html.breadcrumb(F.col("html")), lambda x: F.concat_ws(":", x["pvid"], x["title"]))
    return site(spark, sf).select("page_id", F.array_join(crumbs, "|").alias("crumbs"))


@query("figures_resolved")
def figures_resolved(spark, sf):
    known = F.create_map(F.lit("ab" * 32), F.lit("x.png"))
    return parsed(spark, sf).select("pvid", F.sha2(html.resolve(F.col("markdown"), known, "https://example.org/"), 256).alias("sha256"))


@query(
    "crawl_tree",
    """WITH RECURSIVE t AS (SELECT '0' AS id, NULL::VARCHAR AS parent, 0::BIGINT AS sib_ord, 1 AS depth UNION ALL
    SELECT (t.id::BIGINT * 2 + 1 + k)::VARCHAR, t.id, k, depth + 1 FROM t JOIN pages p ON p.page_id = t.id::BIGINT, (VALUES (0::BIGINT), (1)) v(k))
    SELECT id, parent, sib_ord, depth, NOT EXISTS (SELECT 1 FROM pages p WHERE p.page_id::VARCHAR = t.id) AS is_leaf, EXISTS (SELECT 1 FROM pages p WHERE p.page_id::VARCHAR = t.id) AS has_body FROM t""",
)
def crawl_tree(spark, sf):
    """A crawl over pages that are at hand: every page links to the two that follow from its number."""
    p = read(spark, sf, "pages")
    kids = F.concat(*[x for k in (1, 2) for x in (F.lit('<a href="/'), (F.col("page_id") * 2 + k).cast("string"), F.lit('">t</a>'))])
    made = p.select(F.col("page_id").cast("string").alias("page_id"), F.concat(F.lit("<nav>"), kids, F.lit("</nav><article>"), "html", F.lit("</article>")).alias("html"))
    return web.crawl(made, "0").select("id", "parent", "sib_ord", "depth", "is_leaf", "has_body")


_DOTS = "replace(format('{{:,}}', ({0})::BIGINT), ',', '.')"
_dots = _DOTS.format
_FIG = "SELECT CASE WHEN a IS NULL THEN 'right only' WHEN b IS NULL THEN 'left only' ELSE 'both' END AS side, count(*) AS n FROM (SELECT DISTINCT md5(text) AS a FROM documents WHERE doc_id % 3 > 0) x FULL JOIN (SELECT DISTINCT md5(text) AS b FROM documents WHERE doc_id % 3 < 2) y ON a = b GROUP BY 1"


@query(
    "coverage_report",
    f"""WITH {_JUDGED}, {_PASSAGES}, most AS (SELECT * FROM judged WHERE n_only > 0 ORDER BY n_only DESC, doc_id LIMIT 25), top AS (SELECT * FROM judged WHERE n_only > 0 ORDER BY n_only DESC, doc_id LIMIT 10), fig AS ({_FIG}),
    facts AS (SELECT unnest([1, 2, 3]) AS ord, unnest(['documents', 'positions compared', 'only on one side']) AS k, unnest([count(*), sum(total), sum(n_only)]) AS v FROM judged),
    verdicts AS (SELECT verdict, count(*) AS n FROM judged GROUP BY 1)
    SELECT 0 AS section, o::BIGINT AS ord, l AS line FROM (VALUES (0, '# Documents against benchmark'), (1, '| what | number |'), (2, '| --- | ---: |')) v(o, l)
    UNION ALL SELECT 1, ord, '| ' || k || ' | ' || {_dots("v")} || ' |' FROM facts
    UNION ALL SELECT 2, row_number() OVER (ORDER BY n DESC, verdict), '| ' || verdict || ' | ' || {_dots("n")} || ' |' FROM verdicts
    UNION ALL SELECT 3, o, l FROM (VALUES (0, '| document | only here | coverage |'), (1, '| --- | ---: | ---: |')) v(o, l)
    UNION ALL SELECT 4, row_number() OVER (ORDER BY n_only DESC, doc_id), '| ' || doc_id || ' | ' || {_dots("n_only")} || ' | ' || printf('%.1f', 100 * coverage) || '% |' FROM most
    UNION ALL SELECT 5, 0, '## passages that only this side has'
    UNION ALL SELECT 6, row_number() OVER (ORDER BY n_only DESC, doc_id, run), '> ' || doc_id || ': ' || regexp_replace(left(passage, 400), '\\s+', ' ', 'g') FROM passages JOIN top USING (doc_id) WHERE run <= 2
    UNION ALL SELECT 7, o, l FROM (VALUES (0, '| figures | number |'), (1, '| --- | ---: |')) v(o, l)
    UNION ALL SELECT 8, row_number() OVER (ORDER BY side), '| ' || side || ' | ' || {_dots("n")} || ' |' FROM fig""",
)
def coverage_report(spark, sf):
    d, b = read(spark, sf, "documents"), read(spark, sf, "benchmark")
    judged = written(coverage.judged(d, b), "judged")  # asked for by each part of the report
    # only passages of the documents that are shown are looked for
    shown = d.join(F.broadcast(render.most_missing(judged).select("_d")), F.col("doc_id") == F.col("_d"), "left_semi")
    left, right = (d.where(x).select(F.md5("text").alias(c)).distinct() for x, c in (("doc_id % 3 > 0", "a"), ("doc_id % 3 < 2", "b")))
    side = F.when(F.col("a").isNull(), "right only").when(F.col("b").isNull(), "left only").otherwise("both")
    figures = left.join(right, F.col("a") == F.col("b"), "full_outer").groupBy(side.alias("side")).agg(F.count("*").alias("n"))
    return render.coverage_report(judged, "Documents against benchmark", passages=coverage.lacking(shown, coverage.reference(b), ["doc_id"]), figures=figures)


_LATEST = f"WITH a AS ({LOOSE_SQL}), s AS (SELECT number, source, max(date) AS d, min(doc_id) AS o FROM a GROUP BY ALL) SELECT number, max(d) AS date, string_agg(source, ', ' ORDER BY o, source) AS places FROM s GROUP BY number ORDER BY date DESC, number DESC LIMIT 12"
_table = lambda section, *lines: " UNION ALL ".join(f"SELECT {section}, {i}, '{x}'" for i, x in enumerate(lines))


@query(
    "book_index",
    f"""WITH RECURSIVE {_PACK_SQL}, d AS (SELECT source, doc_id, len({sql_words("text")}) AS w, split_part(text, chr(10), 1) AS e, lang FROM documents), p AS (SELECT source, min(doc_id) AS i, count(*) AS n, sum(w) AS w, arg_min(e, doc_id) AS e FROM d GROUP BY 1),
    t AS (SELECT topic, array_to_string(list_sort(list(DISTINCT place)), ', ') AS p FROM ({_TOPICS}) GROUP BY 1), l AS ({_LATEST}), f AS (SELECT sha256(text) AS figure, count(*) AS n, string_agg(DISTINCT source, ', ' ORDER BY source) AS p FROM documents GROUP BY 1 HAVING count(*) > 1)
    {_table(0, "# Index", "| title | documents | numbers | notes | words | opens with |", "| --- | ---: | ---: | ---: | ---: | --- |").replace("SELECT 0, 0, '# Index'", "SELECT 0 AS section, 0::BIGINT AS ord, '# Index' AS line")}
    UNION ALL SELECT 1, row_number() OVER (ORDER BY i), '| ' || source || ' | ' || {_dots("n")} || ' | ' || {_dots("n")} || ' | 0 | ' || {_dots("w")} || ' | ' || replace(e, '|', '\\|') || ' |' FROM p
    UNION ALL {_table(2, "| file | words |", "| --- | ---: |")}
    UNION ALL SELECT 3, row_number() OVER (ORDER BY sequence), '| `' || source || '-' || part || '.md` | ' || {_dots("words")} || ' |' FROM sequenced
    UNION ALL {_table(4, "| topic | titles |", "| --- | --- |")}
    UNION ALL SELECT 5, row_number() OVER (ORDER BY topic), '| ' || topic || ' | ' || p || ' |' FROM t
    UNION ALL {_table(6, "| amendment | date | in |", "| --- | --- | --- |")}
    UNION ALL SELECT 7, row_number() OVER (ORDER BY date DESC, number DESC), '| ' || number || ' | ' || substr(date, 9, 2) || '-' || substr(date, 6, 2) || '-' || left(date, 4) || ' | ' || places || ' |' FROM l
    UNION ALL {_table(8, "| figure | uses | in |", "| --- | ---: | --- |")}
    UNION ALL SELECT 9, row_number() OVER (ORDER BY n DESC, figure), '| ' || left(figure, 12) || ' | ' || {_dots("n")} || ' | ' || p || ' |' FROM f
    UNION ALL {_table(10, "## outline")}
    UNION ALL SELECT 11, row_number() OVER (ORDER BY i, l), CASE WHEN l = '' THEN '- ' || source ELSE '  - ' || l || ' (' || {_dots("n")} || ')' END FROM (SELECT i, '' AS l, source, 0 AS n FROM p UNION ALL SELECT p.i, d.lang, d.source, count(*) FROM d JOIN p USING (source) GROUP BY ALL)""",
)
def book_index(spark, sf):
    d = read(spark, sf, "documents").select("source", "doc_id", "lang", "text", tx.word_count(F.col("text")).alias("words"), F.split_part("text", F.lit("\n"), F.lit(1)).alias("excerpt"))
    p = d.groupBy("source").agg(F.min("doc_id").alias("index"), F.count("*").alias("documents"), F.count("*").alias("units"), F.lit(0).cast("long").alias("notes"), F.sum("words").alias("words"), F.min_by("excerpt", "doc_id").alias("excerpt")).withColumnRenamed("source", "title")
    f = sequenced(spark, sf).select("sequence", F.concat("source", F.lit("-"), F.col("part").cast("string"), F.lit(".md")).alias("filename"), "words")
    t = trends.topics(spark, sf).groupBy("topic").agg(F.array_sort(F.collect_set("place")).alias("places"))
    n = trends.index.latest(trends.loose(spark, sf), "number", "date", "source", "doc_id")
    g = d.groupBy(F.sha2("text", 256).alias("figure")).agg(F.count("*").alias("uses"), F.array_sort(F.collect_set("source")).alias("places")).where("uses > 1")
    top = p.select(F.struct("index", F.lit("").alias("l")).alias("path_ord"), F.lit(0).alias("depth"), F.col("title").alias("name"), F.lit(0).cast("long").alias("documents"))
    kids = d.groupBy("source", "lang").agg(F.count("*").alias("documents")).join(p.select("title", "index"), F.col("source") == F.col("title"))
    o = top.unionByName(kids.select(F.struct("index", F.col("lang").alias("l")).alias("path_ord"), F.lit(1).alias("depth"), F.col("lang").alias("name"), "documents"))
    return render.book_index(p, f, t, n, "Index", figures=g, outline=o)


@query(
    "root_index",
    f"""WITH RECURSIVE {_PACK_SQL}, {_JUDGED}, b AS (SELECT source AS book, count(*) AS n, sum(len({sql_words("text")})) AS w FROM documents GROUP BY 1), t AS (SELECT lang AS topic, string_agg(DISTINCT source, ', ' ORDER BY source) AS s FROM documents GROUP BY 1),
    l AS (SELECT number, max(date) AS date FROM ({LOOSE_SQL}) GROUP BY 1 ORDER BY date DESC, number DESC LIMIT 15), v AS (SELECT source AS book, verdict, count(*) AS n FROM judged JOIN documents USING (doc_id) GROUP BY ALL)
    SELECT section, ord, line FROM (SELECT 0 AS section, 0::BIGINT AS ord, '# Books' AS line UNION ALL SELECT 0, 1, '| book | documents | numbers | notes | words |' UNION ALL SELECT 0, 2, '| --- | ---: | ---: | ---: | ---: |'
    UNION ALL SELECT 1, row_number() OVER (ORDER BY book), '| ' || book || ' | ' || {_dots("n")} || ' | ' || {_dots("n")} || ' | 0 | ' || {_dots("w")} || ' |' FROM b
    UNION ALL {_table(2, "| topic | books |", "| --- | --- |")} UNION ALL SELECT 3, row_number() OVER (ORDER BY topic), '| ' || topic || ' | ' || s || ' |' FROM t
    UNION ALL SELECT 4, row_number() OVER (ORDER BY date DESC, number DESC), '| ' || number || ' | ' || substr(date, 9, 2) || '-' || substr(date, 6, 2) || '-' || left(date, 4) || ' |' FROM l
    UNION ALL SELECT 5, 1, '| TOTAL | ' || {_dots("sum(n)")} || ' | ' || {_dots("sum(n)")} || ' | 0 | ' || {_dots("sum(w)")} || ' |' FROM b
    UNION ALL {_table(6, "| file | words |", "| --- | ---: |")} UNION ALL SELECT 7, row_number() OVER (ORDER BY source, source || '-' || part || '.md'), '| [`' || source || '-' || part || '.md`](' || source || '/' || source || '-' || part || '.md) | ' || {_dots("words")} || ' |' FROM sequenced
    UNION ALL {_table(8, "| book | verdict | documents |", "| --- | --- | ---: |")} UNION ALL SELECT 9, row_number() OVER (ORDER BY book, verdict), '| ' || book || ' | ' || verdict || ' | ' || {_dots("n")} || ' |' FROM v)
    WHERE (SELECT count(*) FROM b) >= 20""",
)
def root_index(spark, sf):
    d = read(spark, sf, "documents")
    b = d.groupBy(F.col("source").alias("book")).agg(F.count("*").alias("documents"), F.count("*").alias("units"), F.lit(0).cast("long").alias("notes"), F.sum(tx.word_count(F.col("text"))).alias("words"))
    t = d.groupBy(F.col("lang").alias("topic")).agg(F.array_sort(F.collect_set("source")).alias("in_books"))
    n = trends.loose(spark, sf).groupBy("number").agg(F.max("date").alias("date"))
    f = sequenced(spark, sf).select(F.col("source").alias("book"), F.concat("source", F.lit("-"), F.col("part").cast("string"), F.lit(".md")).alias("filename"), "words")
    v = _verdicts(spark, sf).groupBy("book", "verdict").agg(F.count("*").alias("n"))
    return render.root_index(b, t, 20, n, files=f, verdicts=v)


def _verdicts(spark, sf):
    d = read(spark, sf, "documents").select(F.col("doc_id").alias("did"), F.col("source").alias("book"))
    return coverage.judged(read(spark, sf, "documents"), read(spark, sf, "benchmark")).join(d, F.col("doc_id") == F.col("did"))


def _bar(value: str, top: str, width: int = 40) -> str:
    """A bar in eighths, filled up with blanks, in SQL."""
    e = f"round_even(greatest(0.0, least(({value})::DOUBLE / ({top})::DOUBLE, 1.0)) * {width * 8}, 0)::INT"
    return f"rpad(repeat('█', ({e}) // 8) || CASE WHEN ({e}) % 8 > 0 THEN substr('▏▎▍▌▋▊▉', ({e}) % 8, 1) ELSE '' END, {width}, ' ')"


_SPARK = "CASE WHEN lo = hi THEN repeat('⠤', len(v)) ELSE array_to_string(list_transform(v, lambda x: substr('⠀⣀⣄⣤⣦⣶⣷⣿', 1 + least(floor((x - lo) / (hi - lo) * 7)::INT, 7), 1)), '') END"
_SIZED = "CASE WHEN b < 1024 THEN printf('%.0f B', b) WHEN b < 1048576 THEN printf('%.0f KB', b / 1024) WHEN b < 1073741824 THEN printf('%.1f MB', b / 1048576) ELSE printf('%.1f GB', b / 1073741824) END"
_YEARLY = f"SELECT year, count(*)::BIGINT AS n FROM ({STRICT_SQL}) WHERE year IS NOT NULL GROUP BY year"
_TIMELINE = f"SELECT row_number() OVER (ORDER BY year) AS ord, rpad(left(year::VARCHAR, 6), 6, ' ') || ' ' || {_bar('n', '(SELECT max(n) FROM y)')} || ' ' || n AS line FROM y"


@query("amendment_timeline", f"WITH y AS ({_YEARLY}) SELECT 0 AS section, ord, line FROM ({_TIMELINE})")
def amendment_timeline(spark, sf):
    return render.timeline(trends.years(spark, sf), "year", "n")


_TREND = f"""y AS ({_YEARLY}), m AS (SELECT event_type AS stage, list_sort(list(value))[count(value) // 2 + 1] AS median FROM events WHERE value IS NOT NULL GROUP BY 1),
last AS (SELECT event_type AS stage, value, ts, event_id FROM events WHERE value IS NOT NULL QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) <= 60), r AS (SELECT stage, list(value ORDER BY ts, event_id) AS v, min(value) AS lo, max(value) AS hi FROM last GROUP BY 1),
trend AS (SELECT 0 AS section, 0::BIGINT AS ord, '## amendments' AS line UNION ALL SELECT 1, ord, line FROM ({_TIMELINE}) UNION ALL SELECT 2, 0, '## timings'
UNION ALL SELECT 3, row_number() OVER (ORDER BY median DESC, stage), rpad(stage, 16, ' ') || ' ' || {_bar('median', '(SELECT max(median) FROM m)')} || ' ' || printf('%.2f s', median::DOUBLE) FROM m
UNION ALL SELECT 4, 0, '## runs' UNION ALL SELECT 5, row_number() OVER (ORDER BY stage), rpad(stage, 16, ' ') || ' ' || {_SPARK} FROM r)"""


def _trends(spark, sf):
    e = read(spark, sf, "events").where("value is not null").withColumn("stage", F.col("event_type"))
    last = trends.analytics.last_rows(e, "stage", [F.desc("ts"), F.desc("event_id")], 60)
    runs = last.groupBy("stage").agg(F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id", "value"))), lambda x: x["value"]).alias("values"))  # 60 at most
    return render.trend_charts(trends.years(spark, sf), trends.analytics.upper_median(e, "stage", "value"), runs)


@query("trend_charts", f"WITH {_TREND} SELECT * FROM trend")
def trend_charts(spark, sf):
    return _trends(spark, sf)


_STACK = [f"round_even({c}::DOUBLE / n * 40, 0)::INT" for c in ("a", "r", "x")]
_STATE = f"""{_JUDGED}, size AS (SELECT source AS book, sum(strlen(text))::DOUBLE AS b, count(*) AS n, count(*) / 45.0 - 1 AS margin FROM documents GROUP BY 1),
four AS (SELECT source AS book, count(*) AS n, count(*) FILTER (verdict = 'match') AS a, count(*) FILTER (verdict = 'reformatted') AS r, count(*) FILTER (verdict = 'extra_in_pdf') AS x FROM judged JOIN documents USING (doc_id) GROUP BY 1),
state AS (SELECT 0 AS section, 0::BIGINT AS ord, '## download' AS line UNION ALL SELECT 1, row_number() OVER (ORDER BY b DESC, book), rpad(book, 16, ' ') || ' ' || {_bar('b', '(SELECT max(b) FROM size)')} || ' ' || {_SIZED} FROM size
UNION ALL SELECT 2, 0, '## processing' UNION ALL SELECT 3, row_number() OVER (ORDER BY book), rpad(book, 8, ' ') || ' ' || lpad(n::VARCHAR, 8, ' ') || ' ' || printf('%+.1f', 100 * margin::DOUBLE) || '%' FROM size
UNION ALL SELECT 4, 0, '## coverage' UNION ALL SELECT 4, 1, '█ match ▓ reformatted ▒ extra ░ unaligned'
UNION ALL SELECT 5, row_number() OVER (ORDER BY book), rpad(book, 8, ' ') || ' ' || repeat('█', {_STACK[0]}) || repeat('▓', {_STACK[1]}) || repeat('▒', {_STACK[2]}) || repeat('░', greatest(0, 40 - {' - '.join(_STACK)})) FROM four)"""


def _facts(spark, sf):
    """(book, documents, bytes) and (book, verdict, n), each made once for all parts of a report."""
    sizes = read(spark, sf, "documents").groupBy(F.col("source").alias("book")).agg(F.count("*").alias("documents"), F.sum(F.octet_length("text")).alias("bytes"))
    return written(sizes, "sizes"), written(_verdicts(spark, sf).groupBy("book", "verdict").agg(F.count("*").alias("n")), "verdicts")


def _of(verdict: str):
    return F.coalesce(F.sum(F.when(F.col("verdict") == verdict, F.col("n"))), F.lit(0)).alias(verdict)


def _states(sizes, verdicts):
    done = sizes.select("book", "documents", (F.col("documents") / 45.0 - 1).alias("margin"))
    four = verdicts.groupBy("book").agg(*[_of(v) for v in ("match", "reformatted", "extra_in_pdf", "unaligned")])
    return render.state_charts(sizes.select("book", "bytes"), done, four)


@query("state_charts", f"WITH {_STATE} SELECT * FROM state")
def state_charts(spark, sf):
    return _states(*_facts(spark, sf))


@query(
    "metrics_report",
    f"""WITH {_TREND}, {_STATE}, snap AS (SELECT s.book, s.n, s.b::BIGINT AS bytes, coalesce(f.a, 0) AS m FROM size s LEFT JOIN four f USING (book))
    SELECT 0 AS section, o::BIGINT AS ord, l AS line FROM (VALUES (0, '# metrics'), (1, '| book | documents | bytes | match |'), (2, '| --- | ---: | ---: | ---: |')) v(o, l)
    UNION ALL SELECT 1, row_number() OVER (ORDER BY book), '| ' || book || ' | ' || n || ' | ' || bytes || ' | ' || m || ' |' FROM snap UNION ALL SELECT section + 10, ord, line FROM trend UNION ALL SELECT section + 20, ord, line FROM state""",
)
def metrics_report(spark, sf):
    """The snapshot of all metrics, and the report that is made of it."""
    sizes, verdicts = _facts(spark, sf)
    snap = render.snapshot(sizes.select("book", "documents"), sizes.select("book", "bytes"), verdicts.groupBy("book").agg(_of("match")))
    return render.metrics_report(snap, _trends(spark, sf), _states(sizes, verdicts), ["documents", "bytes", "match"])


@query("stacked_shares", "SELECT source, repeat('█', a) || repeat('▓', b) || repeat('▒', greatest(0, 40 - a - b)) AS bar FROM (SELECT source, round_even(count(*) FILTER (lang = 'en') * 1.0::DOUBLE / count(*) * 40, 0)::INT AS a, round_even(count(*) FILTER (lang = 'de') * 1.0::DOUBLE / count(*) * 40, 0)::INT AS b FROM documents GROUP BY source)")
def stacked_shares(spark, sf):
    c = read(spark, sf, "documents").groupBy("source").agg(F.count_if(F.col("lang") == "en").alias("a"), F.count_if(F.col("lang") == "de").alias("b"), F.count_if(~F.col("lang").isin("en", "de")).alias("c"))
    return c.select("source", render.stacked([F.col(x).cast("double") for x in "abc"], glyphs="█▓▒").alias("bar"))


@query("stream_event_windows", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*)::BIGINT AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def stream_event_windows(spark, sf):
    """Tumbling windows by Structured Streaming over the events file."""
    out = feeds.drain(feeds.tumbling(feeds.event_stream(spark, f"{sf}/events.parquet")))
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("stream_user_sessions", "SELECT user_id, count(*)::BIGINT AS sessions, sum(n)::BIGINT AS events FROM (SELECT user_id, s, count(*) AS n FROM (SELECT user_id, ts, event_id, sum(o) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS o FROM events)) GROUP BY ALL) GROUP BY user_id")
def stream_user_sessions(spark, sf):
    out = feeds.drain(feeds.sessions(feeds.event_stream(spark, f"{sf}/events.parquet")))
    return out.groupBy("user_id").agg(F.count("*").alias("sessions"), F.sum("n").cast("long").alias("events"))


def _two_sides(spark, sf):
    """Conversations as documents of eight books, and the same text printed on pages with some words changed."""
    c = read(spark, sf, "conversations").withColumn("book", (F.col("conv_id") % 8).cast("string")).withColumn("id", F.col("conv_id") * 1000 + F.col("turn"))
    docs = c.select("book", "id", F.concat(F.lit("Libro "), "book", F.lit(", Letra "), F.col("id").cast("string")).alias("path"), F.concat(F.lit("Norma "), F.col("id").cast("string"), F.lit(" fin")).alias("title"), F.col("text").alias("markdown"))
    body = F.when(F.col("id") % 3 == 0, F.regexp_replace("markdown", "e", "a")).otherwise(F.col("markdown"))
    pages = docs.select("book", F.col("id").alias("page"), tx.canonical(F.concat_ws(" ", "path", "title", body)).alias("text"))
    return docs, pages


def _found(spark, sf):
    """Documents, what the second publication has of them (made once), and both sides compared."""
    docs, pages = _two_sides(spark, sf)
    other = written(compare.aligned(docs, pages), "aligned")
    return docs, other, compare.compared(docs, other)


_SIDES = f"""src AS (SELECT (conv_id % 8)::VARCHAR AS book, conv_id * 1000 + turn AS id, text AS markdown FROM conversations),
docs AS (SELECT *, 'Libro ' || book || ', Letra ' || id AS path, 'Norma ' || id || ' fin' AS title, {sql_canonical("CASE WHEN id % 3 = 0 THEN regexp_replace(markdown, 'e', 'a', 'g') ELSE markdown END")} AS body FROM src),
pdf AS (SELECT book, id, body AS text FROM docs WHERE body <> ''), web AS (SELECT book, id, markdown AS text FROM docs), known_web AS (SELECT book, concat_ws(' ', path, title, markdown) AS text FROM docs)"""


def _side(name: str, own: str, whole: str) -> str:
    """Counts and shares of one side against the whole of the other in SQL: {name}_c by book and id."""
    grams = lambda t: f"SELECT book, unnest({_SH}) AS s FROM (SELECT book, {_W} AS w FROM {t})"
    return f"""{name}_g AS (SELECT DISTINCT * FROM ({grams(whole)})), {name}_r AS (SELECT book, id, unnest({_SH}) AS s FROM (SELECT book, id, {_W} AS w FROM {own})),
{name}_f AS (SELECT r.book, r.id, count(*) AS total, count(*) FILTER (g.s IS NULL) AS gone FROM {name}_r r LEFT JOIN {name}_g g ON r.book = g.book AND r.s = g.s GROUP BY ALL),
{name}_b AS (SELECT book, word, count(*) AS n FROM (SELECT book, unnest({_W}) AS word FROM {whole}) GROUP BY ALL), {name}_w AS (SELECT book, id, word, count(*) AS c FROM (SELECT book, id, unnest({_W}) AS word FROM {own}) GROUP BY ALL),
{name}_l AS (SELECT book, id, sum(least(c, coalesce(n, 0)))::DOUBLE / sum(c) AS lex FROM {name}_w LEFT JOIN {name}_b USING (book, word) GROUP BY ALL),
{name}_c AS (SELECT o.book, o.id, coalesce(total, 0)::BIGINT AS total, coalesce(gone, 0)::BIGINT AS gone, CASE WHEN coalesce(total, 0) = 0 THEN 1.0 ELSE (total - gone)::DOUBLE / total END::DOUBLE AS cov, coalesce(lex, 1.0) AS lex FROM {own} o LEFT JOIN {name}_f USING (book, id) LEFT JOIN {name}_l USING (book, id))"""


_COMPARED = f"""{_SIDES}, {_side("p", "pdf", "known_web")}, {_side("w", "web", "pdf")},
compared AS (SELECT p.book, p.id, p.id AS page, p.id AS page_end, 'heading' AS anchored_by, p.total AS pdf_words, w.total AS web_words, p.gone AS only_in_pdf, w.gone AS only_in_web, round(p.cov, 6) AS coverage_pdf, round(w.cov, 6) AS coverage_web,
p.total > 3 * w.total + 250 AS alignment_suspect, CASE WHEN p.cov >= 0.95 THEN 'match' WHEN p.total > 3 * w.total + 250 THEN 'unaligned' WHEN p.lex >= 0.95 THEN 'reformatted' ELSE 'extra_in_pdf' END AS verdict FROM p_c p JOIN w_c w USING (book, id))"""


@query("compared_publications", f"WITH {_COMPARED} SELECT * FROM compared")
def compared_publications(spark, sf):
    docs, _, found = _found(spark, sf)
    return found.select("book", "id", "page", "page_end", "anchored_by", "pdf_words", "web_words", "only_in_pdf", "only_in_web", F.round("coverage_pdf", 6).alias("coverage_pdf"), F.round("coverage_web", 6).alias("coverage_web"), "alignment_suspect", "verdict")


@query(
    "comparison_report",
    f"""WITH {_COMPARED} SELECT d.book, count(*)::BIGINT AS documents, count(c.id)::BIGINT AS aligned, sum(pdf_words)::BIGINT AS pdf_words, sum(web_words)::BIGINT AS web_words, coalesce(sum(only_in_pdf) FILTER (verdict = 'extra_in_pdf'), 0)::BIGINT AS extra_words_in_pdf,
    {", ".join(f"(count(*) FILTER (verdict = '{v}'))::BIGINT AS {v}" for v in ("match", "unaligned", "reformatted", "extra_in_pdf"))}, (count(*) - count(c.id))::BIGINT AS unanchored FROM docs d LEFT JOIN compared c USING (book, id) GROUP BY 1""",
)
def comparison_report(spark, sf):
    docs, _, found = _found(spark, sf)
    return compare.report(docs, found)


@query(
    "publication_sections",
    f"""WITH {_COMPARED}, placed AS (SELECT c.book, row_number() OVER (PARTITION BY c.book ORDER BY c.id)::INT AS section, ['## ' || d.title, '*p. ' || c.page || '*', d.body] AS lines FROM compared c JOIN docs d USING (book, id))
    SELECT book, section, ord, sha256(line) AS line FROM (SELECT book, section, unnest(range(3)) AS ord, unnest(lines) AS line FROM placed)""",
)
def publication_sections(spark, sf):
    """Each book as the second publication has it: its documents with their pages and texts, and a warning where they may not be aligned."""
    docs, other, found = _found(spark, sf)
    verdicts = found.select("book", "id", "verdict")
    rows = other.join(verdicts, ["book", "id"]).join(docs.select("book", "id", "title"), ["book", "id"]).withColumn("body", F.col("text"))
    return render.publication_section(rows, ["book"], ["id"]).withColumn("ord", F.col("ord").cast("long")).withColumn("line", F.sha2("line", 256))
