"""Queries of units, snapshots, metrics and coverage."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from foliospark.functions import text as tx
from foliospark.operators import changes, coverage, guard, units
from foliospark.plans.texts import sql_words
from foliospark.registry import query
from foliospark.sources.tables import read

# ------------------------------------------------------------------ snapshots
_SNAP = """SELECT doc_id, source, lang, {text} AS text, sha256({source} || text) AS source_sha256, sha256({content}) AS content_sha256, {notes} AS notes FROM documents WHERE doc_id % {mod} <> 0"""
PREV_SQL = _SNAP.format(text="text", source="''", content="text", notes="['first note']", mod=10)
CURR_SQL = _SNAP.format(
    text="CASE WHEN doc_id % 7 = 0 THEN text || ' (rev)' ELSE text END",
    source="CASE WHEN doc_id % 13 = 0 OR doc_id % 7 = 0 THEN 'x' ELSE '' END",
    content="CASE WHEN doc_id % 7 = 0 THEN text || ' (rev)' WHEN doc_id % 17 = 0 THEN text || '!' ELSE text END",
    notes="CASE WHEN doc_id % 14 = 0 THEN ['first note', 'note ' || doc_id, 'a note'] ELSE ['first note'] END",
    mod=11,
)
COMPARED_SQL = f"""prev AS ({PREV_SQL}), curr AS ({CURR_SQL}),
compared AS (SELECT coalesce(c.doc_id, p.doc_id) AS doc_id, CASE WHEN p.doc_id IS NULL THEN 'new' WHEN c.doc_id IS NULL THEN 'removed'
 WHEN p.source_sha256 <> c.source_sha256 AND p.content_sha256 <> c.content_sha256 THEN CASE WHEN len(list_filter(c.notes, lambda x: NOT list_contains(p.notes, x))) > 0 THEN 'normative' ELSE 'editorial' END
 WHEN p.content_sha256 <> c.content_sha256 THEN 'pipeline' WHEN p.source_sha256 <> c.source_sha256 THEN 'cosmetic' END AS category,
 CASE WHEN p.doc_id IS NOT NULL AND c.doc_id IS NOT NULL THEN array_to_string(list_sort(list_filter(c.notes, lambda x: NOT list_contains(p.notes, x))), '|') ELSE '' END AS new_notes
 FROM prev p FULL OUTER JOIN curr c ON p.doc_id = c.doc_id)"""


def snapshots(spark, sf):
    """A previous and a current state of the documents, made by rule."""
    d = read(spark, sf, "documents").select("doc_id", "source", "lang", "text")
    i, rev = F.col("doc_id"), F.concat("text", F.lit(" (rev)"))
    hashed = lambda df, source, content, notes: df.select("doc_id", "source", "lang", "text", F.sha2(source, 256).alias("source_sha256"), F.sha2(content, 256).alias("content_sha256"), notes.alias("notes"))
    prev = hashed(d.where(i % 10 != 0), F.col("text"), F.col("text"), F.array(F.lit("first note")))
    source = F.concat(F.when((i % 13 == 0) | (i % 7 == 0), "x").otherwise(""), "text")
    content = F.when(i % 7 == 0, rev).when(i % 17 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    notes = F.when(i % 14 == 0, F.array(F.lit("first note"), F.concat(F.lit("note "), i.cast("string")), F.lit("a note"))).otherwise(F.array(F.lit("first note")))
    return prev, hashed(d.where(i % 11 != 0), source, content, notes)


def compared(spark, sf):
    return changes.compare(*snapshots(spark, sf))


@query("snapshot_outer_join", f"WITH prev AS ({PREV_SQL}), curr AS ({CURR_SQL}) SELECT coalesce(c.doc_id, p.doc_id) AS doc_id, CASE WHEN p.doc_id IS NULL THEN 'new' WHEN c.doc_id IS NULL THEN 'removed' ELSE 'common' END AS side FROM prev p FULL OUTER JOIN curr c ON p.doc_id = c.doc_id")
def snapshot_outer_join(spark, sf):
    prev, curr = snapshots(spark, sf)
    p, c = prev.select(F.col("doc_id").alias("p")), curr.select(F.col("doc_id").alias("c"))
    return p.join(c, F.col("p") == F.col("c"), "full_outer").select(F.coalesce("c", "p").alias("doc_id"), F.when(F.col("p").isNull(), "new").when(F.col("c").isNull(), "removed").otherwise("common").alias("side"))


@query("change_classify", f"WITH {COMPARED_SQL} SELECT doc_id, category FROM compared WHERE category IS NOT NULL")
def change_classify(spark, sf):
    return compared(spark, sf).where("category is not null").select("doc_id", "category")


@query("new_notes", f"WITH {COMPARED_SQL} SELECT doc_id, new_notes FROM compared WHERE new_notes <> ''")
def new_notes(spark, sf):
    return compared(spark, sf).select("doc_id", F.array_join("new_notes", "|").alias("new_notes")).where("new_notes <> ''")


@query("change_summary", f"WITH {COMPARED_SQL} SELECT " + ", ".join(f"count(*) FILTER (category = '{c}')::BIGINT AS {c}" for c in changes.CATEGORIES) + " FROM compared")
def change_summary(spark, sf):
    return changes.summary(compared(spark, sf))


_RANK = "CASE category " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(changes.CATEGORIES, 1)) + " END"


@query("changes_by_severity", f"WITH {COMPARED_SQL} SELECT doc_id, category, ({_RANK})::BIGINT AS severity FROM compared WHERE category IS NOT NULL ORDER BY severity, doc_id")
def changes_by_severity(spark, sf):
    """Changes in the order of a report."""
    ranked = compared(spark, sf).where("category is not null").select("doc_id", "category", changes.severity(F.col("category")).cast("long").alias("severity"))
    return ranked.orderBy("severity", "doc_id")


def _listed(texts) -> str:
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in texts) + "]"


@query(
    "changelog_blocks",
    f"""WITH {COMPARED_SQL}, k AS (SELECT unnest({_listed(changes.CATEGORIES)}) AS cat, unnest(range({len(changes.CATEGORIES)})) AS rank, unnest({_listed(changes.EXPLAIN[c] for c in changes.CATEGORIES)}) AS what),
    n AS (SELECT cat, rank, what, count(c.doc_id) AS n FROM k LEFT JOIN compared c ON category = cat GROUP BY ALL)
    SELECT '0.0' AS ord, '# documents' || chr(10) || chr(10) || '| class | documents | meaning |' || chr(10) || '| --- | ---: | --- |' AS block UNION ALL SELECT '1.' || rank, '| ' || cat || ' | ' || n || ' | ' || what || ' |' FROM n
    UNION ALL SELECT '2.' || rank || '.-1', chr(10) || '## ' || cat || ' (' || n || ')' || chr(10) FROM n WHERE n > 0
    UNION ALL SELECT '2.' || rank || '.' || doc_id, '### document ' || doc_id || chr(10) || CASE WHEN new_notes = '' THEN '' ELSE '- ' || replace(new_notes, '|', chr(10) || '- ') END FROM compared JOIN n ON cat = category""",
)
def changelog_blocks(spark, sf):
    citation = F.concat(F.lit("document "), F.col("doc_id").cast("string"))
    log = changes.changelog(compared(spark, sf).withColumn("citation", citation), "documents")
    return log.select(F.array_join(F.col("ord").cast("array<string>"), ".").alias("ord"), "block")


# ---------------------------------------------------------------------- units
UNITS_SQL = """SELECT conv_id AS doc_id, turn AS ordinal, turn::VARCHAR AS number, conv_id || '#' || turn AS unit_id, text, sha256(text) AS sha256 FROM conversations"""
BEFORE_SQL = f"SELECT * FROM ({UNITS_SQL})"
AFTER_SQL = f"""SELECT doc_id, ordinal, CASE WHEN doc_id % 5 = 0 THEN (ordinal + 2)::VARCHAR ELSE number END AS number, CASE WHEN doc_id % 7 = 0 AND ordinal % 2 = 0 THEN text || ' +' ELSE text END AS text,
 sha256(CASE WHEN doc_id % 7 = 0 AND ordinal % 2 = 0 THEN text || ' +' ELSE text END) AS sha256 FROM (SELECT *, max(ordinal) OVER (PARTITION BY doc_id) AS last FROM ({UNITS_SQL})) WHERE NOT (doc_id % 3 = 0 AND ordinal = last)"""
_NTH = "row_number() OVER (PARTITION BY doc_id, sha256 ORDER BY ordinal) AS k"
SAME_SQL = f"""before AS ({BEFORE_SQL}), after AS ({AFTER_SQL}),
same AS (SELECT b.doc_id, b.sha256, b.number AS from_number, a.number AS to_number, b.ordinal AS from_ordinal, a.ordinal AS to_ordinal FROM (SELECT *, {_NTH} FROM before) b JOIN (SELECT *, {_NTH} FROM after) a ON b.doc_id = a.doc_id AND b.sha256 = a.sha256 AND b.k = a.k)"""


def unit_snapshots(spark, sf):
    """Conversations as documents whose turns are numbered units; then renumbered, edited and cut by rule."""
    c = read(spark, sf, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("ordinal"), F.col("turn").cast("string").alias("number"), "text")
    ids = lambda df: df.withColumn("unit_id", F.concat(F.col("doc_id").cast("string"), F.lit("#"), "number")).withColumn("sha256", F.sha2("text", 256))
    last = F.max("ordinal").over(Window.partitionBy("doc_id"))
    a = c.withColumn("last", last).where(~((F.col("doc_id") % 3 == 0) & (F.col("ordinal") == F.col("last")))).drop("last")
    a = a.withColumn("number", F.when(F.col("doc_id") % 5 == 0, (F.col("ordinal") + 2).cast("string")).otherwise(F.col("number")))
    a = a.withColumn("text", F.when((F.col("doc_id") % 7 == 0) & (F.col("ordinal") % 2 == 0), F.concat("text", F.lit(" +"))).otherwise(F.col("text")))
    return ids(c), ids(a)


@query("unit_hash_match", f"WITH {SAME_SQL} SELECT doc_id, from_ordinal, to_ordinal, from_number, to_number FROM same")
def unit_hash_match(spark, sf):
    return units.hash_match(*unit_snapshots(spark, sf)).select("doc_id", "from_ordinal", "to_ordinal", "from_number", "to_number")


@query(
    "unit_events",
    f"""WITH {SAME_SQL}, moved AS (SELECT doc_id, 'renumbered' AS type, to_number AS number, from_number, to_ordinal AS ordinal FROM same WHERE from_number <> to_number),
    old AS (SELECT b.* FROM before b WHERE NOT EXISTS (SELECT 1 FROM same s WHERE s.doc_id = b.doc_id AND s.from_ordinal = b.ordinal)),
    new AS (SELECT a.* FROM after a WHERE NOT EXISTS (SELECT 1 FROM same s WHERE s.doc_id = a.doc_id AND s.to_ordinal = a.ordinal)),
    changed AS (SELECT n.doc_id, CASE WHEN o.ordinal IS NULL THEN 'added' ELSE 'modified' END AS type, n.number, NULL::VARCHAR AS from_number, n.ordinal FROM new n LEFT JOIN old o ON n.doc_id = o.doc_id AND n.number = o.number),
    touched AS (SELECT doc_id, number FROM moved UNION SELECT doc_id, number FROM changed)
    SELECT *, doc_id || '#' || number AS unit_id FROM (SELECT * FROM moved UNION ALL SELECT * FROM changed UNION ALL
    SELECT doc_id, 'removed', number, NULL, ordinal FROM old WHERE NOT EXISTS (SELECT 1 FROM touched t WHERE t.doc_id = old.doc_id AND t.number = old.number))""",
)
def unit_events(spark, sf):
    return units.events(*unit_snapshots(spark, sf))


@query("unit_events_exact")
def unit_events_exact(spark, sf):
    return units.exact_events(*unit_snapshots(spark, sf))


@query("unified_diff")
def unified_diff(spark, sf):
    prev, curr = snapshots(spark, sf)
    a = curr.select(F.col("doc_id").alias("aid"), F.col("text").alias("after"))
    return prev.join(a, F.col("doc_id") == F.col("aid")).select("doc_id", units.unified_diff(F.col("text"), F.concat("after", F.when(F.col("doc_id") % 7 == 0, " (rev)").otherwise(""))).alias("diff"))


_BLOCK_DOC = "'Intro of ' || conv_id || chr(10) || chr(10) || string_agg(CASE WHEN turn % 3 = 2 THEN text ELSE turn || CASE WHEN turn % 2 = 0 THEN '. ' ELSE ') ' END || text END, chr(10) || chr(10) ORDER BY turn)"
_START = r"^(\p{Nd}{1,3})\s*[.\-)]\s+\S"


@query(
    "units_segmented",
    f"""WITH made AS (SELECT conv_id AS doc_id, {_BLOCK_DOC} AS body FROM conversations GROUP BY conv_id),
    blocks AS (SELECT doc_id, unnest(string_split(body, chr(10) || chr(10))) AS b, generate_subscripts(string_split(body, chr(10) || chr(10)), 1) AS p FROM made),
    numbered AS (SELECT *, nullif(regexp_extract(b, '{_START}', 1), '') AS n FROM blocks),
    placed AS (SELECT *, sum((n IS NOT NULL)::INT) OVER (PARTITION BY doc_id ORDER BY p) AS ordinal FROM numbered),
    units AS (SELECT doc_id, ordinal::BIGINT AS ordinal, arg_min(n, p) FILTER (n IS NOT NULL) AS number, trim(string_agg(b, chr(10) || chr(10) ORDER BY p), ' ' || chr(9) || chr(10) || chr(13)) AS text FROM placed GROUP BY ALL)
    SELECT doc_id, ordinal, doc_id || '#' || coalesce(number, 'preamble') AS unit_id, number, sha256(text) AS sha256 FROM units WHERE text <> ''""",
)
def units_segmented(spark, sf):
    c = read(spark, sf, "conversations")
    line = F.when(F.col("turn") % 3 == 2, F.col("text")).otherwise(F.concat(F.col("turn").cast("string"), F.when(F.col("turn") % 2 == 0, ". ").otherwise(") "), "text"))
    lists = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", line.alias("l")))).alias("x"))  # the turns of one conversation
    body = F.concat(F.lit("Intro of "), F.col("conv_id").cast("string"), F.lit("\n\n"), F.array_join(F.transform("x", lambda x: x["l"]), "\n\n"))
    return units.segment(lists.select(F.col("conv_id").alias("doc_id"), body.alias("text"))).select("doc_id", "ordinal", "unit_id", "number", "sha256")


# -------------------------------------------------------------------- metrics
_METRICS = f"""SELECT source AS book, count(*)::BIGINT AS documents, sum(length(text))::BIGINT AS chars, sum(len(string_split(text, chr(10))))::BIGINT AS units, count(DISTINCT sha256(text))::BIGINT AS figures, sum(CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 0 END)::BIGINT AS notes, count(*) FILTER (trim(text) = '')::BIGINT AS empty FROM documents GROUP BY source"""


def corpus(spark, sf):
    notes = F.when(F.col("doc_id") % 3 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array().cast("array<string>"))
    return read(spark, sf, "documents").select("doc_id", F.col("source").alias("book"), F.col("text").alias("markdown"), F.split("text", "\n", -1).alias("units"), F.array(F.sha2("text", 256)).alias("figures"), notes.alias("notes"), F.when(F.col("doc_id") % 23 != 0, F.col("lang")).alias("path"))


@query("corpus_metrics", _METRICS.replace("count(*) FILTER (trim(text) = '')", "0"))
def corpus_metrics(spark, sf):
    return guard.metrics(corpus(spark, sf)).select("book", "documents", "chars", "units", "figures", "notes", "empty")


@query("corpus_metrics_rollup", "SELECT coalesce(source, 'TOTAL') AS book, count(*)::BIGINT AS documents, sum(length(text))::BIGINT AS chars, avg(length(text))::DOUBLE AS mean_chars FROM documents GROUP BY ROLLUP (source)")
def corpus_metrics_rollup(spark, sf):
    return read(spark, sf, "documents").rollup("source").agg(F.count("*").alias("documents"), F.sum(F.length("text")).cast("long").alias("chars"), F.avg(F.length("text")).alias("mean_chars")).select(F.coalesce("source", F.lit("TOTAL")).alias("book"), "documents", "chars", "mean_chars")


@query(
    "invariant_problems",
    """WITH f AS (SELECT source AS book, count(*) AS n, avg(CASE WHEN doc_id % 23 <> 0 THEN 1.0 ELSE 0 END) AS wp, sum(len(string_split(text, chr(10)))) AS units, sum(length(text)) AS now, sum(CASE WHEN doc_id % 3 <> 0 THEN length(text) END) AS before FROM documents GROUP BY source)
    SELECT book, concat_ws('; ', CASE WHEN n < 45 THEN 'only ' || n || ' documents, expected >=45' END, CASE WHEN wp < 0.95 THEN 'too few documents with a path' END, CASE WHEN units < 300 THEN 'only ' || units || ' numbered units, expected >=300' END,
    CASE WHEN before > 0 AND abs(now - before) / before > 0.25 THEN 'text volume changed from ' || before || ' to ' || now || ' chars' END) AS problems FROM f""",
)
def invariant_problems(spark, sf):
    c = corpus(spark, sf)
    limits = c.groupBy("book").agg(F.lit(45).alias("min_documents"), F.lit(300).alias("min_units"), F.lit("r").alias("root"))
    before = c.where(F.col("doc_id") % 3 != 0).groupBy("book").agg(F.sum(F.length("markdown")).alias("chars"))
    return guard.problems(c, limits, before).select("book", F.array_join("problems", "; ").alias("problems"))


@query("partition_violations", "SELECT sha256(text) AS figure, count(DISTINCT source)::BIGINT AS books FROM documents GROUP BY 1 HAVING count(DISTINCT source) > 1")
def partition_violations(spark, sf):
    """Contents that are in two books or more: must be none in a sound partition."""
    return read(spark, sf, "documents").groupBy(F.sha2("text", 256).alias("figure")).agg(F.count_distinct("source").alias("books")).where("books > 1")


@query("text_drift", "SELECT source AS book, sum(length(text))::DOUBLE / sum(CASE WHEN doc_id % 3 <> 0 THEN length(text) END) - 1 AS drift FROM documents GROUP BY source")
def text_drift(spark, sf):
    c = corpus(spark, sf)
    size = lambda df: df.groupBy("book").agg(F.sum(F.length("markdown")).cast("double").alias("chars"))
    return guard.drift(size(c), size(c.where(F.col("doc_id") % 3 != 0)), "chars")


@query("set_equality", "SELECT (SELECT count(*) FROM (SELECT doc_id FROM documents EXCEPT ALL SELECT doc_id FROM labels))::BIGINT AS only_left, (SELECT count(*) FROM (SELECT doc_id FROM labels EXCEPT ALL SELECT doc_id FROM documents))::BIGINT AS only_right")
def set_equality(spark, sf):
    a, b = read(spark, sf, "documents").select("doc_id"), read(spark, sf, "labels").select("doc_id")
    left, right = a.exceptAll(b).agg(F.count("*").alias("only_left")), b.exceptAll(a).agg(F.count("*").alias("only_right"))
    return left.crossJoin(right)  # one row each


# ------------------------------------------------------------------- coverage
_W = sql_words("lower(text)")
_SH = "CASE WHEN len(w) = 0 THEN [] ELSE list_transform(range(1, greatest(len(w) - 7, 1) + 1), lambda i: array_to_string(w[i:i + 7], ' ')) END"
_REF = f"SELECT DISTINCT unnest({_SH}) AS s FROM (SELECT {_W} AS w FROM benchmark)"
_ROWS = f"SELECT doc_id, unnest({_SH}) AS s, generate_subscripts({_SH}, 1) - 1 AS pos FROM (SELECT doc_id, {_W} AS w FROM documents)"
_NG = f"""known AS ({_REF}), rows AS ({_ROWS}), counts AS (SELECT r.doc_id, count(*) AS total, count(*) FILTER (k.s IS NULL) AS n_only FROM rows r LEFT JOIN known k ON r.s = k.s GROUP BY r.doc_id),
ng AS (SELECT d.doc_id, coalesce(total, 0)::BIGINT AS total, coalesce(n_only, 0)::BIGINT AS n_only, CASE WHEN coalesce(total, 0) = 0 THEN 1.0 ELSE (total - n_only)::DOUBLE / total END::DOUBLE AS coverage FROM documents d LEFT JOIN counts c USING (doc_id))"""
_LX = f"""bag AS (SELECT word, count(*) AS n FROM (SELECT unnest({_W}) AS word FROM benchmark) GROUP BY 1), own AS (SELECT doc_id, word, count(*) AS c FROM (SELECT doc_id, unnest({_W}) AS word FROM documents) GROUP BY ALL),
both_ AS (SELECT doc_id, sum(c) AS words, sum(least(c, coalesce(n, 0))) AS shared FROM own LEFT JOIN bag USING (word) GROUP BY 1),
lx AS (SELECT d.doc_id, coalesce(words, 0)::BIGINT AS words, CASE WHEN coalesce(words, 0) = 0 THEN 1.0 ELSE shared::DOUBLE / words END::DOUBLE AS lexical FROM documents d LEFT JOIN both_ b USING (doc_id))"""
_JUDGED = f"""{_NG}, {_LX}, judged AS (SELECT ng.doc_id, total, n_only, coverage, words, lexical, total > 3 * (total - n_only) + 250 AS suspect,
CASE WHEN coverage >= 0.95 THEN 'match' WHEN total > 3 * (total - n_only) + 250 THEN 'unaligned' WHEN lexical >= 0.95 THEN 'reformatted' ELSE 'extra_in_pdf' END AS verdict FROM ng JOIN lx USING (doc_id))"""


@query("shingle_coverage", f"WITH {_NG} SELECT doc_id, total, n_only, round(coverage, 6) AS coverage FROM ng")
def shingle_coverage(spark, sf):
    d, b = read(spark, sf, "documents"), read(spark, sf, "benchmark")
    return coverage.ngram_coverage(d, coverage.reference(b)).withColumn("coverage", F.round("coverage", 6))


@query("lexical_coverage", f"WITH {_LX} SELECT doc_id, words, round(lexical, 6) AS lexical FROM lx")
def lexical_coverage(spark, sf):
    d, b = read(spark, sf, "documents"), read(spark, sf, "benchmark")
    return coverage.lexical_coverage(d, coverage.bag(b)).withColumn("lexical", F.round("lexical", 6))


@query("coverage_verdict", f"WITH {_JUDGED} SELECT doc_id, total, n_only, round(coverage, 6) AS coverage, words, round(lexical, 6) AS lexical, suspect, verdict FROM judged")
def coverage_verdict(spark, sf):
    d, b = read(spark, sf, "documents"), read(spark, sf, "benchmark")
    return coverage.judged(d, b).withColumn("coverage", F.round("coverage", 6)).withColumn("lexical", F.round("lexical", 6))


@query("verdict_histogram", f"WITH {_JUDGED} SELECT verdict, count(*)::BIGINT AS n, sum(CASE WHEN verdict = 'extra_in_pdf' THEN n_only ELSE 0 END)::BIGINT AS extra FROM judged GROUP BY verdict")
def verdict_histogram(spark, sf):
    d, b = read(spark, sf, "documents"), read(spark, sf, "benchmark")
    return coverage.judged(d, b).groupBy("verdict").agg(F.count("*").alias("n"), F.sum(F.when(F.col("verdict") == "extra_in_pdf", F.col("n_only")).otherwise(0)).cast("long").alias("extra"))


@query("missing_shingles", f"WITH known AS ({_REF}), rows AS ({_ROWS}) SELECT doc_id, count(*)::BIGINT AS n_missing, min(pos)::BIGINT AS first_pos, max(pos)::BIGINT AS last_pos FROM rows r WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.s = r.s) GROUP BY doc_id")
def missing_shingles(spark, sf):
    d, b = read(spark, sf, "documents"), read(spark, sf, "benchmark")
    gone = coverage.missing(coverage.shingle_rows(d, ["doc_id"]), coverage.reference(b))
    return gone.groupBy("doc_id").agg(F.count("*").alias("n_missing"), F.min("pos").cast("long").alias("first_pos"), F.max("pos").cast("long").alias("last_pos"))


@query("missing_runs", f"WITH known AS ({_REF}), rows AS (SELECT * FROM ({_ROWS})), found AS (SELECT doc_id, pos FROM rows r WHERE EXISTS (SELECT 1 FROM known k WHERE k.s = r.s)), o AS (SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) >= 5 THEN 1 ELSE 0 END AS o FROM found), n AS (SELECT *, sum(o) OVER (PARTITION BY doc_id ORDER BY pos) + 1 AS run FROM o) SELECT doc_id, run::BIGINT AS run, min(pos)::BIGINT AS first, max(pos)::BIGINT AS last, count(*)::BIGINT AS n FROM n GROUP BY ALL")
def missing_runs(spark, sf):
    """Runs of n-gram positions that are less than five apart: here those that the benchmark has."""
    d, b = read(spark, sf, "documents"), read(spark, sf, "benchmark")
    found = coverage.shingle_rows(d, ["doc_id"]).join(coverage.reference(b), "gram", "left_semi").select("doc_id", F.col("pos").cast("long").alias("pos"))
    return coverage.runs(found, "doc_id", "pos", 5).withColumn("run", F.col("run").cast("long"))


_PASSAGES = f"""gone AS (SELECT doc_id, pos FROM ({_ROWS}) r WHERE NOT EXISTS (SELECT 1 FROM ({_REF}) k WHERE k.s = r.s)),
parts AS (SELECT doc_id, regexp_extract_all(lower(text), '(?s)(.*?)({tx.WORD})', 0) AS p, {_W} AS w FROM documents), words AS (SELECT doc_id, unnest(p) AS part, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM parts),
places AS (SELECT doc_id, pos, sum(length(part)) OVER (PARTITION BY doc_id ORDER BY pos) - length(word) AS start FROM words), spots AS (SELECT g.doc_id, p.start FROM gone g JOIN places p USING (doc_id, pos)),
o AS (SELECT *, CASE WHEN start - lag(start) OVER (PARTITION BY doc_id ORDER BY start) >= 200 THEN 1 ELSE 0 END AS o FROM spots), n AS (SELECT *, sum(o) OVER (PARTITION BY doc_id ORDER BY start) + 1 AS run FROM o),
found AS (SELECT doc_id, run, min(start) AS first, max(start) AS last FROM n GROUP BY ALL HAVING run <= 5),
passages AS (SELECT f.doc_id, run::BIGINT AS run, first::BIGINT AS first, regexp_replace(substr(CASE WHEN length(lower(text)) = length(text) THEN text ELSE lower(text) END, first::BIGINT + 1, (last - first + 200)::BIGINT), '^{tx.SPACE}+|{tx.SPACE}+$', '', 'g') AS passage FROM found f JOIN documents d USING (doc_id))"""


@query("missing_passages", f"WITH {_PASSAGES} SELECT doc_id, run, first, sha256(passage) AS passage FROM passages")
def missing_passages(spark, sf):
    """The first passages of each document that the benchmark lacks, by their places in characters."""
    d, b = read(spark, sf, "documents"), read(spark, sf, "benchmark")
    return coverage.lacking(d, coverage.reference(b), ["doc_id"]).withColumn("passage", F.sha2("passage", 256))


@query("shingle_union", f"WITH b AS ({_REF}), c AS (SELECT DISTINCT unnest({_SH}) AS s FROM (SELECT {_W} AS w FROM conversations)) SELECT count(*)::BIGINT AS n, count(DISTINCT left(s, 3))::BIGINT AS n_heads FROM (SELECT s FROM b UNION SELECT s FROM c)")
def shingle_union(spark, sf):
    both = coverage.shingle_texts(read(spark, sf, "benchmark")).union(coverage.shingle_texts(read(spark, sf, "conversations"))).distinct()
    return both.agg(F.count("*").alias("n"), F.count_distinct(F.left(F.array_join("shingle", " "), F.lit(3))).alias("n_heads"))
