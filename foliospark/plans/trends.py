"""Queries of indexes, trends, alignment and metrics."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from foliospark.functions import text as tx
from foliospark.operators import align, analytics, compare, coverage, guard, index
from foliospark.plans.changed import _JUDGED
from foliospark.plans.texts import LOOSE_SQL, STRICT_SQL, loose, sql_words, strict
from foliospark.registry import query
from foliospark.sources import files
from foliospark.sources.tables import read

# ---------------------------------------------------------------------- index
_TOPICS = "SELECT source, lang || CASE WHEN doc_id % 5 = 0 THEN ' special' ELSE '' END AS topic, doc_id % 12 AS place, doc_id FROM documents"


def topics(spark, sf):
    return read(spark, sf, "documents").select("source", F.concat("lang", F.when(F.col("doc_id") % 5 == 0, " special").otherwise("")).alias("topic"), (F.col("doc_id") % 12).alias("place"), "doc_id")


@query("topic_index", f"SELECT topic, array_to_string(list_sort(list(DISTINCT place)), ',') AS places FROM ({_TOPICS}) GROUP BY topic")
def topic_index(spark, sf):
    return index.topic_index(topics(spark, sf), "topic", "place").select("topic", F.array_join(F.col("places").cast("array<string>"), ",").alias("places"))


@query("topic_rank_topk", f"SELECT source, topic, n, rank FROM (SELECT source, topic, n, row_number() OVER (PARTITION BY source ORDER BY n DESC, topic)::BIGINT AS rank FROM (SELECT source, topic, count(*)::BIGINT AS n FROM ({_TOPICS}) GROUP BY ALL)) WHERE rank <= 4")
def topic_rank_topk(spark, sf):
    return index.ranked(topics(spark, sf), "source", "topic", 4).select("source", "topic", "n", "rank")


@query("cross_topic_index", f"SELECT topic, count(DISTINCT source)::BIGINT AS books, string_agg(DISTINCT source, ',' ORDER BY source) AS in_books FROM ({_TOPICS}) GROUP BY topic HAVING count(DISTINCT source) > 1")
def cross_topic_index(spark, sf):
    found = topics(spark, sf).groupBy("topic").agg(F.array_sort(F.collect_set("source")).alias("s"))
    return found.where(F.size("s") > 1).select("topic", F.size("s").cast("long").alias("books"), F.array_join("s", ",").alias("in_books"))


@query("latest_per_key", f"WITH a AS ({LOOSE_SQL}), s AS (SELECT number, source, max(date) AS d, min(doc_id) AS o FROM a GROUP BY ALL) SELECT number, max(d) AS date, string_agg(source, ',' ORDER BY o, source) AS places FROM s GROUP BY number")
def latest_per_key(spark, sf):
    return index.latest(loose(spark, sf), "number", "date", "source", "doc_id").select("number", "date", F.array_join("places", ",").alias("places"))


@query("latest_tuple_max", f"SELECT source, max(date || '/' || lpad(number::VARCHAR, 5, '0')) AS latest, min(date || '/' || lpad(number::VARCHAR, 5, '0')) AS earliest FROM ({LOOSE_SQL}) GROUP BY source")
def latest_tuple_max(spark, sf):
    pair = lambda c: F.concat(c["date"], F.lit("/"), F.lpad(c["number"].cast("string"), 5, "0"))
    out = loose(spark, sf).groupBy("source").agg(F.max(F.struct("date", "number")).alias("a"), F.min(F.struct("date", "number")).alias("b"))
    return out.select("source", pair(F.col("a")).alias("latest"), pair(F.col("b")).alias("earliest"))


@query("recent_ncgs_topk", f"WITH l AS (SELECT source, number, max(date) AS date FROM ({LOOSE_SQL}) GROUP BY ALL) SELECT source, number, date, r AS rank FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY date DESC, number DESC)::BIGINT AS r FROM l) WHERE r <= 12")
def recent_ncgs_topk(spark, sf):
    each = loose(spark, sf).groupBy("source", "number").agg(F.max("date").alias("date"))
    w = Window.partitionBy("source").orderBy(F.desc("date"), F.desc("number"))
    return each.withColumn("rank", F.row_number().over(w).cast("long")).where("rank <= 12").select("source", "number", "date", "rank")


@query(
    "title_profile",
    f"""WITH a AS ({LOOSE_SQL}) SELECT d.source, d.lang, count(*)::BIGINT AS documents, sum(len(string_split(d.text, chr(10))))::BIGINT AS units, sum(CASE WHEN d.doc_id % 3 = 0 THEN 2 ELSE 0 END)::BIGINT AS notes,
    sum(len({sql_words('d.text')}))::BIGINT AS words, count(DISTINCT sha256(d.text))::BIGINT AS n_figures, count(DISTINCT a.number)::BIGINT AS n_amendments, arg_min(split_part(d.text, chr(10), 1), d.doc_id) FILTER (split_part(d.text, chr(10), 1) <> '') AS excerpt
    FROM documents d LEFT JOIN a ON d.doc_id = a.doc_id GROUP BY d.source, d.lang""",
)
def title_profile(spark, sf):
    a = loose(spark, sf).select(F.col("doc_id").alias("aid"), F.array("number").alias("amendments"))
    d = read(spark, sf, "documents").join(a, F.col("doc_id") == F.col("aid"), "left")
    d = d.select("source", "lang", "doc_id", F.size(F.split("text", "\n", -1)).alias("units"), F.when(F.col("doc_id") % 3 == 0, 2).otherwise(0).alias("notes"), tx.word_count(F.col("text")).alias("words"), F.array(F.sha2("text", 256)).alias("figures"), "amendments", F.split_part("text", F.lit("\n"), F.lit(1)).alias("excerpt"))
    return index.profile(d, ["source", "lang"], "doc_id")


@query("figure_usage", "SELECT sha256(text) AS figure, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS documents FROM documents GROUP BY 1")
def figure_usage(spark, sf):
    used = index.usage(read(spark, sf, "documents"), "doc_id", "doc_id", F.array(F.sha2("text", 256)))
    return used.select("figure", F.array_join(F.col("documents").cast("array<string>"), ",").alias("documents"))


@query("set_compare_counts", "WITH a AS (SELECT DISTINCT sha256(text) AS k FROM documents WHERE doc_id % 2 = 0), b AS (SELECT DISTINCT sha256(text) AS k FROM documents WHERE doc_id % 2 = 1) SELECT count(*) FILTER (a.k IS NOT NULL AND b.k IS NOT NULL)::BIGINT AS shared, count(*) FILTER (b.k IS NULL)::BIGINT AS only_left, count(*) FILTER (a.k IS NULL)::BIGINT AS only_right FROM a FULL OUTER JOIN b ON a.k = b.k")
def set_compare_counts(spark, sf):
    d = read(spark, sf, "documents").select(F.sha2("text", 256).alias("k"), "doc_id")
    return index.compared_sets(d.where("doc_id % 2 = 0"), d.where("doc_id % 2 = 1"), "k")


@query("index_detail_lines", "SELECT conv_id, CASE WHEN t = '' THEN '' ELSE ' — ' || t END AS detail FROM (SELECT conv_id, concat_ws(' · ', CASE WHEN count(*) > 0 THEN count(*) || ' número' || CASE WHEN count(*) > 1 THEN 's' ELSE '' END END, array_to_string(list_sort(list(DISTINCT role))[1:3], ', ')) AS t FROM conversations GROUP BY conv_id)")
def index_detail_lines(spark, sf):
    c = read(spark, sf, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("role")).alias("r"))
    return c.select("conv_id", index.detail(F.col("n"), F.col("r")).alias("detail"))


@query("image_first_source", "SELECT sha256(text) AS sha256, min(doc_id) AS first_doc, count(*)::BIGINT AS n FROM documents GROUP BY 1")
def image_first_source(spark, sf):
    """One row for each content, with the first place that has it."""
    return files.by_content(read(spark, sf, "documents").select(F.sha2("text", 256).alias("sha256"), "doc_id"), "doc_id").withColumnRenamed("first", "first_doc")


@query("new_sources_anti", """WITH l AS (SELECT regexp_extract(html, 'lang="([^"]*)"', 1) AS lang, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS src FROM pages) SELECT DISTINCT src FROM l WHERE src NOT IN (SELECT src FROM l WHERE lang = 'en')""")
def new_sources_anti(spark, sf):
    """Distinct addresses that an index (here: that of the English pages) has not."""
    p, pattern = read(spark, sf, "pages"), 'href="([^"]*)"'
    english = p.where(F.regexp_extract("html", 'lang="([^"]*)"', 1) == "en").select(F.explode(F.regexp_extract_all("html", F.lit(pattern), F.lit(1))).alias("src"))
    return files.new_sources(p, english.distinct(), F.col("html"), pattern)


@query("figure_sources", "SELECT sha256(text) AS figure, arg_max(source, doc_id) AS source FROM documents GROUP BY 1")
def figure_sources(spark, sf):
    """Where each content was last met."""
    d = read(spark, sf, "documents").select(F.sha2("text", 256).alias("figure"), "source", "doc_id")
    return index.reverse(d, "figure", "source", "doc_id")


@query("book_subset", "SELECT doc_id, source FROM documents WHERE source IN ('src3', 'src1')")
def book_subset(spark, sf):
    return read(spark, sf, "documents").where(F.col("source").isin("src3", "src1")).select("doc_id", "source")


@query("page_figures", "SELECT source, lang, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS figures FROM documents GROUP BY ALL")
def page_figures(spark, sf):
    """Each page with its images in order."""
    d = read(spark, sf, "documents").groupBy("source", "lang").agg(F.array_sort(F.collect_list("doc_id")).alias("f"))
    return d.select("source", "lang", F.array_join(F.col("f").cast("array<string>"), ",").alias("figures"))


# --------------------------------------------------------------------- trends
_YEARS = f"SELECT year, count(*)::BIGINT AS n FROM ({STRICT_SQL}) WHERE year IS NOT NULL GROUP BY year"


def years(spark, sf):
    return strict(spark, sf).where("year is not null").groupBy("year").agg(F.count("*").alias("n"))


@query("activity_by_year", f"SELECT source, year, count(*)::BIGINT AS n FROM ({STRICT_SQL}) GROUP BY ALL")
def activity_by_year(spark, sf):
    """A null year counts the notes without one."""
    return strict(spark, sf).groupBy("source", "year").agg(F.count("*").alias("n"))


@query("activity_stats", f"WITH y AS ({_YEARS}) SELECT sum(n)::BIGINT AS total, (max(year) - min(year) + 1)::BIGINT AS span, round(sum(n) / (max(year) - min(year) + 1), 6)::DOUBLE AS per_year, arg_max(year, n * 10000 - year)::BIGINT AS peak_year, round(sum(CASE WHEN year >= (SELECT max(year) FROM y) - 4 THEN n ELSE 0 END) / sum(n), 6)::DOUBLE AS recent_share FROM y")
def activity_stats(spark, sf):
    return analytics.activity(years(spark, sf), "year", "n").withColumn("per_year", F.round("per_year", 6)).withColumn("recent_share", F.round("recent_share", 6))


@query("dense_year_axis", f"WITH y AS ({_YEARS}) SELECT a.year, coalesce(y.n, 0)::BIGINT AS n FROM (SELECT unnest(range((SELECT min(year) FROM y), (SELECT max(year) FROM y) + 1)) AS year) a LEFT JOIN y ON a.year = y.year")
def dense_year_axis(spark, sf):
    return analytics.dense_years(years(spark, sf), "year", "n")


@query("stage_upper_median", "SELECT event_type, list_sort(list(value))[count(value) // 2 + 1] AS median FROM events WHERE value IS NOT NULL GROUP BY event_type")
def stage_upper_median(spark, sf):
    return analytics.upper_median(read(spark, sf, "events").where("value is not null"), "event_type", "value")


@query("scope_mode", "SELECT scope FROM (SELECT n AS scope, count(*) AS f FROM (SELECT conv_id, count(*)::BIGINT AS n FROM conversations GROUP BY 1) GROUP BY 1) ORDER BY f DESC, scope DESC LIMIT 1")
def scope_mode(spark, sf):
    sizes = read(spark, sf, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"))
    return analytics.common_scope(sizes, "n")


@query("series_drift", "SELECT user_id, arg_min(value, (ts, event_id)) AS first, arg_max(value, (ts, event_id)) AS last, CASE WHEN arg_min(value, (ts, event_id)) <> 0 THEN round((arg_max(value, (ts, event_id)) - arg_min(value, (ts, event_id))) / arg_min(value, (ts, event_id)), 6) ELSE 0.0 END AS trend FROM events GROUP BY user_id")
def series_drift(spark, sf):
    e = read(spark, sf, "events").withColumn("at", F.struct("ts", "event_id"))
    return analytics.ends(e, "user_id", "at", "value").withColumn("trend", F.round("trend", 6))


@query("sample_rates", "SELECT event_id, CASE WHEN span > 0 THEN round(delta / span, 6) + 0.0 ELSE 0.0 END AS rate FROM (SELECT event_id, epoch_us(ts) / 1e6 - lag(epoch_us(ts) / 1e6) OVER w AS span, value - lag(value) OVER w AS delta FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE span IS NOT NULL")
def sample_rates(spark, sf):
    e = read(spark, sf, "events")
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    return analytics.rates(e, "user_id", seconds, ["ts", "event_id"], "value").select("event_id", (F.round("rate", 6) + F.lit(0.0)).alias("rate"))


@query("bounded_window", "SELECT event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r <= 600")
def bounded_window(spark, sf):
    return analytics.last_rows(read(spark, sf, "events"), "event_type", [F.desc("ts"), F.desc("event_id")], 600).select("event_type", "event_id")


@query("sample_summary", "SELECT event_type, count(*)::BIGINT AS samples, max(value) AS peak, arg_max(value, (ts, event_id)) AS last FROM events GROUP BY event_type")
def sample_summary(spark, sf):
    return read(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("samples"), F.max("value").alias("peak"), F.max_by("value", F.struct("ts", "event_id")).alias("last"))


_BUCKETS = "SELECT user_id, CASE WHEN n <= 20 THEN i ELSE ((i + 1) * 20 - 1) // n END::BIGINT AS bucket, value FROM (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events)"


@query("bucket_means", f"SELECT user_id, bucket, round(avg(value), 6) AS mean FROM ({_BUCKETS}) GROUP BY ALL")
def bucket_means(spark, sf):
    return analytics.bucket_means(read(spark, sf, "events"), "user_id", ["ts", "event_id"], "value", 20).withColumn("mean", F.round("mean", 6))


@query("bars", "SELECT o_orderkey, repeat('█', e // 8) || CASE WHEN e % 8 > 0 THEN substr('▏▎▍▌▋▊▉', e % 8, 1) ELSE '' END AS bar FROM (SELECT o_orderkey, round_even(least(o_orderkey / 5000.0::DOUBLE, 1.0) * 160, 0)::INT AS e FROM orders)")
def bars(spark, sf):
    return read(spark, sf, "orders").select("o_orderkey", analytics.bar(F.col("o_orderkey").cast("double"), F.lit(5000.0), 20).alias("bar"))


@query(
    "sparklines",
    f"""WITH b AS (SELECT user_id, bucket, avg(value) AS mean FROM ({_BUCKETS}) GROUP BY ALL), v AS (SELECT user_id, list(mean ORDER BY bucket) AS v, min(mean) AS lo, max(mean) AS hi FROM b GROUP BY 1)
    SELECT user_id, CASE WHEN lo = hi THEN repeat('⠤', len(v)) ELSE array_to_string(list_transform(v, lambda x: substr('⠀⣀⣄⣤⣦⣶⣷⣿', 1 + least(floor((x - lo) / (hi - lo) * 7)::INT, 7), 1)), '') END AS line FROM v""",
)
def sparklines(spark, sf):
    b = analytics.bucket_means(read(spark, sf, "events"), "user_id", ["ts", "event_id"], "value", 20)
    lists = b.groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "mean"))), lambda x: x["mean"]).alias("v"))  # at most 20 points
    return lists.select("user_id", tx.let(F.col("v"), analytics.sparkline).alias("line"))


@query("download_metrics", "SELECT lang, count(*)::BIGINT AS files, sum(strlen(text))::BIGINT AS bytes, min(doc_id) AS first, max(doc_id) AS last, count(*) FILTER (doc_id % 4 <> 0 OR doc_id % 6 = 0)::BIGINT AS revalidable FROM documents GROUP BY lang")
def download_metrics(spark, sf):
    i = F.col("doc_id")
    return read(spark, sf, "documents").groupBy("lang").agg(F.count("*").alias("files"), F.sum(F.octet_length("text")).cast("long").alias("bytes"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count_if((i % 4 != 0) | (i % 6 == 0)).alias("revalidable"))


@query("processing_margin", "SELECT source, count(*)::BIGINT AS documents, round(count(*) / 45.0 - 1, 6)::DOUBLE AS margin FROM documents GROUP BY source")
def processing_margin(spark, sf):
    return read(spark, sf, "documents").groupBy("source").agg(F.count("*").alias("documents")).withColumn("margin", F.round(F.col("documents") / 45.0 - 1, 6).cast("double"))


@query("metrics_table", "SELECT coalesce(source, 'TOTAL') AS book, '| ' || coalesce(source, 'TOTAL') || ' | ' || count(*) || ' | ' || replace(format('{:,}', sum(length(text))::BIGINT), ',', '.') || ' |' AS line FROM documents GROUP BY ROLLUP (source)")
def metrics_table(spark, sf):
    r = read(spark, sf, "documents").rollup("source").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("c")).withColumn("book", F.coalesce("source", F.lit("TOTAL")))
    return r.select("book", F.concat(F.lit("| "), "book", F.lit(" | "), F.col("n").cast("string"), F.lit(" | "), tx.thousands(F.col("c")), F.lit(" |")).alias("line"))


def _judged(spark, sf):
    return coverage.judged(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


@query("top_extra_docs", f"WITH {_JUDGED} SELECT doc_id, n_only FROM judged WHERE n_only > 0 ORDER BY n_only DESC, doc_id LIMIT 25")
def top_extra_docs(spark, sf):
    return _judged(spark, sf).where("n_only > 0").orderBy(F.desc("n_only"), "doc_id").limit(25).select("doc_id", "n_only")


@query("coverage_metrics", f"WITH {_JUDGED} SELECT d.source, count(*)::BIGINT AS documents, sum(total)::BIGINT AS total, round(sum(n_only) / greatest(sum(total), 1), 6)::DOUBLE AS extra_share, round(min(coverage), 6)::DOUBLE AS least FROM judged j JOIN documents d USING (doc_id) GROUP BY d.source")
def coverage_metrics(spark, sf):
    d = read(spark, sf, "documents").select(F.col("doc_id").alias("did"), "source")
    j = _judged(spark, sf).join(d, F.col("doc_id") == F.col("did"))
    return j.groupBy("source").agg(F.count("*").alias("documents"), F.sum("total").cast("long").alias("total"), F.round(F.sum("n_only") / F.greatest(F.sum("total"), F.lit(1)), 6).alias("extra_share"), F.round(F.min("coverage"), 6).alias("least"))


# ------------------------------------------------------------------ alignment
_OFFSETS = "SELECT source, doc_id, coalesce(sum(length(text) + 1) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM documents WHERE length(text) > 0"


@query("page_cumulative_offset", _OFFSETS)
def page_cumulative_offset(spark, sf):
    return align.page_offsets(read(spark, sf, "documents"), "source", "doc_id", "text")


@query("offset_to_page_asof", f"WITH s AS ({_OFFSETS}), p AS (SELECT source, event_id, event_id * 37 AS off FROM events e JOIN (SELECT DISTINCT source FROM documents) d ON d.source = 'src' || (e.user_id % 20)) SELECT p.event_id, p.source, s.doc_id AS page FROM p ASOF JOIN s ON p.source = s.source AND p.off >= s.start")
def offset_to_page_asof(spark, sf):
    starts = align.page_offsets(read(spark, sf, "documents"), "source", "doc_id", "text")
    books = read(spark, sf, "documents").select("source").distinct()
    e = read(spark, sf, "events").select("event_id", (F.col("event_id") * 37).alias("off"), F.concat(F.lit("src"), (F.col("user_id") % 20).cast("string")).alias("source"))
    found = align.page_of(e.join(books, "source", "left_semi"), starts, "source", "off", "doc_id")
    return found.select("event_id", "source", F.col("doc_id").alias("page"))


_EV = "SELECT user_id AS book, event_id AS id, (event_id * 7919) % 5000 AS head, (event_id * 7919) % 5000 + event_id % 90 AS body_start FROM events"


def heads(spark, sf):
    e = read(spark, sf, "events")
    head = (F.col("event_id") * 7919) % 5000
    return e.select(F.col("user_id").alias("book"), F.col("event_id").alias("id"), head.alias("head"), (head + F.col("event_id") % 90).alias("body_start"), F.lit("heading").alias("how"))


_THINNED = f"""WITH RECURSIVE e AS (SELECT *, row_number() OVER (PARTITION BY book ORDER BY head, body_start, id) AS rn FROM ({_EV})),
    walk AS (SELECT book, id, head, body_start, rn, true AS kept, body_start AS last FROM e WHERE rn = 1
    UNION ALL SELECT e.book, e.id, e.head, e.body_start, e.rn, e.head >= w.last, CASE WHEN e.head >= w.last THEN e.body_start ELSE w.last END FROM walk w JOIN e ON e.book = w.book AND e.rn = w.rn + 1)
    SELECT book, id, head, body_start, lead(head) OVER (PARTITION BY book ORDER BY head, body_start, id) AS next_head FROM walk WHERE kept"""


@query("boundary_thinning", _THINNED)
def boundary_thinning(spark, sf):
    return align.boundaries(heads(spark, sf)).select("book", "id", "head", "body_start", "next_head")


@query("boundary_thinning_spread", _THINNED)
def boundary_thinning_spread(spark, sf):
    """As ``boundary_thinning``, every book as one that is too large for an array."""
    return align.boundaries(heads(spark, sf), large=0).select("book", "id", "head", "body_start", "next_head")


@query(
    "slice_to_next",
    """WITH e AS (SELECT doc_id, text, unnest([1, 40, 200]) AS head FROM documents), n AS (SELECT *, lead(head, 1, length(text) + 1) OVER (PARTITION BY doc_id ORDER BY head) AS nxt FROM e)
    SELECT doc_id, head::BIGINT AS head, sha256(trim(substr(text, head, greatest(0, nxt - head)))) AS piece FROM n""",
)
def slice_to_next(spark, sf):
    d = read(spark, sf, "documents").select(F.col("doc_id").alias("book"), "text")
    e = d.select("book", F.explode(F.array(*[F.lit(x).cast("long") for x in (0, 39, 199)])).alias("head")).withColumn("id", F.col("head") + 1).withColumn("body_start", F.col("head"))
    kept = e.withColumn("next_head", F.lead("head").over(Window.partitionBy("book").orderBy("head")))
    return align.pieces(kept, d).select(F.col("book").alias("doc_id"), F.col("id").alias("head"), F.sha2("piece", 256).alias("piece"))


@query("pieces_joined", "SELECT conv_id, sha256(string_agg(text, chr(10) || chr(10) ORDER BY turn)) AS joined, min(turn) AS first_turn, max(turn) AS last_turn FROM conversations GROUP BY conv_id")
def pieces_joined(spark, sf):
    """Pieces of a document joined in order, with the span of pages they come from."""
    c = read(spark, sf, "conversations").select("conv_id", F.col("turn").alias("head"), F.col("text").alias("piece"), F.col("turn").alias("page_begin"), F.col("turn").alias("page_stop"))
    return compare.joined(c, ["conv_id"]).select("conv_id", F.sha2("text", 256).alias("joined"), F.col("page").alias("first_turn"), F.col("page_end").alias("last_turn"))


@query("interval_claim", "WITH s AS (SELECT n_nationkey AS section, n_nationkey * 3 AS a, n_nationkey * 3 + 6 AS b FROM nation) SELECT c.c_custkey AS figure, arg_min(s.section, s.section) AS section FROM customer c JOIN s ON c.c_custkey % 90 BETWEEN s.a AND s.b GROUP BY 1")
def interval_claim(spark, sf):
    n = read(spark, sf, "nation").select(F.lit(1).alias("book"), F.col("n_nationkey").alias("section"), F.col("n_nationkey").alias("ord"), (F.col("n_nationkey") * 3).cast("long").alias("first"), (F.col("n_nationkey") * 3 + 6).cast("long").alias("last"))
    f = read(spark, sf, "customer").select(F.lit(1).alias("book"), F.col("c_custkey").alias("figure"), (F.col("c_custkey") % 90).cast("long").alias("page"), F.lit(0).alias("n"))
    return align.claimed(f, n)


_CRUMBS = "SELECT page_id, 'Libro ' || left(regexp_extract(url, '://([^/]*)', 1), (page_id % 9 + 1)::INT) AS crumb FROM pages"


@query("prefix_theta_semi", f"WITH k AS (SELECT DISTINCT 'Libro ' || left(regexp_extract(url, '://([^/]*)', 1), 5) AS p FROM pages WHERE html LIKE '%lang=_en_>%') SELECT page_id, crumb FROM ({_CRUMBS}) c WHERE EXISTS (SELECT 1 FROM k WHERE starts_with(c.crumb, k.p) OR starts_with(k.p, c.crumb))")
def prefix_theta_semi(spark, sf):
    host = F.regexp_extract("url", "://([^/]*)", 1)
    p = read(spark, sf, "pages")
    crumbs = p.select("page_id", F.concat(F.lit("Libro "), F.left(host, (F.col("page_id") % 9 + 1).cast("int"))).alias("crumb"))
    known = p.where(F.contains("html", F.lit('lang="en"'))).select(F.concat(F.lit("Libro "), F.left(host, F.lit(5))).alias("p"))
    return align.prefix_semi(crumbs, known, "crumb", "p")


_SAMPLED = " OR ".join(f"page BETWEEN f{i} AND least(n, f{i} + span - 1)" for i in range(4))
_FIRST = ", ".join(f"least(greatest(1, floor(n * ({0.08 + (0.92 - 0.08) * i / 3!r})::DOUBLE)::BIGINT - span // 2), greatest(1, n - span + 1)) AS f{i}" for i in range(4))


@query("block_sample", f"WITH p AS (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id)::BIGINT AS page, count(*) OVER (PARTITION BY source) AS n FROM documents), s AS (SELECT *, least(16, greatest(1, n // 4)) AS span FROM p), f AS (SELECT *, {_FIRST} FROM s) SELECT source, doc_id, page FROM f WHERE {_SAMPLED}")
def block_sample(spark, sf):
    w = Window.partitionBy("source")
    p = read(spark, sf, "documents").select("source", "doc_id", F.row_number().over(w.orderBy("doc_id")).cast("long").alias("page"), F.count("*").over(w).alias("n"))
    return align.block_sample(p, "page", F.col("n")).select("source", "doc_id", "page")


_HEAD = "(?m)^Compendium\\s*-\\s*(src\\d+)\\s*$"


@query(
    "identity_verification",
    f"""WITH p AS (SELECT source, 'Compendium – ' || CASE WHEN doc_id % 211 = 0 THEN 'src99' ELSE source END || chr(10) || 'Libro ' || source || ',' || lang || chr(10) || text AS page FROM documents),
    h AS (SELECT source, unnest(regexp_extract_all(translate(page, '‐‑‒–—', '-----'), '{_HEAD}', 1)) AS head FROM p), f AS (SELECT source, string_agg(DISTINCT head, ',' ORDER BY head) AS heads FROM h GROUP BY source),
    c AS (SELECT source, count(*) AS crumbs, count(*) FILTER (regexp_matches(page, '(?m)^Libro src[0-9]+,(en|de)$')) AS known FROM p GROUP BY source)
    SELECT c.source, coalesce(f.heads, '') AS heads, crumbs::BIGINT AS crumbs, known::BIGINT AS matched, concat_ws('; ', CASE WHEN f.heads IS NULL THEN 'no running header' WHEN f.heads <> c.source THEN 'header says ' || f.heads END, CASE WHEN crumbs >= 2 AND crumbs - known > crumbs // 2 THEN 'sections are not in the tree' END) AS problems FROM c LEFT JOIN f USING (source)""",
)
def identity_verification(spark, sf):
    """Whether each book's pages name the book, and whether its sections are those of the tree."""
    d = read(spark, sf, "documents")
    named = F.when(F.col("doc_id") % 211 == 0, "src99").otherwise(F.col("source"))
    page = F.concat(F.lit("Compendium – "), named, F.lit("\nLibro "), "source", F.lit(","), "lang", F.lit("\n"), "text")
    pages = d.select(F.col("source").alias("book"), page.alias("text"))
    paths = d.where(F.col("lang").isin("en", "de")).select(F.concat(F.lit("Libro "), "source", F.lit(","), "lang").alias("path"))
    return guard.identity(pages, paths, _HEAD, "(?m)^(Libro [^,]*,.+)$").withColumnRenamed("book", "source")


@query("containment_first_hit", "SELECT b.item_id, d.doc_id, instr(d.text, b.text)::BIGINT AS first_hit FROM documents d JOIN benchmark b ON contains(d.text, b.text)")
def containment_first_hit(spark, sf):
    """Documents that hold an item's whole text, and where they first do."""
    return align.first_hits(read(spark, sf, "documents"), read(spark, sf, "benchmark"), "doc_id", "text", "item_id", "text").select("item_id", "doc_id", "first_hit")


@query(
    "document_anchors",
    """WITH RECURSIVE c AS (SELECT (conv_id % 8)::VARCHAR AS book, conv_id * 1000 + turn AS id, lower(left(text, 12)) AS path, lower(substr(text, 14, 10)) AS title, lower(left(text, 120)) AS body, conv_id, turn, text FROM conversations),
    books AS (SELECT book, lower(string_agg(text, ' ' ORDER BY conv_id, turn, text)) AS whole FROM c GROUP BY book),
    asked AS (SELECT book, id, path, title, body, whole FROM c JOIN books USING (book) WHERE title <> '' OR length(body) >= 40),
    found AS (SELECT book, id, path, title, instr(whole, path) AS pos FROM asked WHERE title <> '' AND contains(whole, path)
        UNION ALL SELECT f.book, id, path, title, pos + instr(substr(whole, pos + 1), path) FROM found f JOIN books b ON f.book = b.book AND contains(substr(whole, pos + 1), path)),
    places AS (SELECT f.*, whole FROM found f JOIN books USING (book)),
    heads AS (SELECT book, id, pos - 1 AS head, pos - 1 + instr(substr(whole, pos, length(path) + 300 + length(title)), title) - 1 + length(title) AS body_start
        FROM places WHERE contains(substr(whole, pos, length(path) + 300 + length(title)), title)),
    bodies AS (SELECT book, id, instr(whole, body) - 1 AS head FROM asked a WHERE length(body) >= 40 AND contains(whole, body) AND NOT EXISTS (SELECT 1 FROM heads h WHERE h.book = a.book AND h.id = a.id))
    SELECT book, id, head, body_start, 'heading' AS how FROM heads UNION ALL SELECT book, id, head, head, 'body' FROM bodies""",
)
def document_anchors(spark, sf):
    """Where conversations begin in the joined text of their book."""
    c = read(spark, sf, "conversations").withColumn("book", (F.col("conv_id") % 8).cast("string"))
    docs = c.select("book", (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.left("text", F.lit(12)).alias("path"), F.substring("text", 14, 10).alias("title"), F.col("text").alias("body"))
    books = c.groupBy("book").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("conv_id", "turn", "text"))), lambda x: x["text"]), " ").alias("text"))
    return align.anchors(docs, books)


@query("page_clean_lines", "SELECT doc_id, sha256(array_to_string(list_filter(l, lambda x: NOT regexp_matches(x, '\\.{5,}\\s*\\d+\\s*$')), chr(10))) AS kept, (1 + len(list_filter(l, lambda x: regexp_matches(x, '\\.{5,}\\s*\\d+\\s*$'))))::BIGINT AS dropped FROM (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS l FROM documents)")
def page_clean_lines(spark, sf):
    page = F.concat(F.lit("HEADER\n 12 \n\nHeader\n"), "text", F.lit("\nChapter ........ 9\n"))
    keep, dropped = align.clean_lines(page, F.lit("header"))
    return read(spark, sf, "documents").select("doc_id", F.sha2(F.array_join(keep, "\n"), 256).alias("kept"), dropped.cast("long").alias("dropped"))
