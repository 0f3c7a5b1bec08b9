"""Queries of trees, packing and sections."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from foliospark.functions import text as tx
from foliospark.operators import sections, tours, tree
from foliospark.plans.texts import sql_words
from foliospark.registry import query
from foliospark.sources.tables import read

NODES_SQL = """SELECT 'r' || r_regionkey AS id, NULL::VARCHAR AS parent, r_regionkey::BIGINT AS sib_ord, r_name AS title FROM region
 UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_nationkey::BIGINT, n_name FROM nation
 UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_custkey::BIGINT, c_name FROM customer"""
TREE_SQL = f"""nodes AS ({NODES_SQL}),
tree AS (SELECT id, parent, sib_ord, title, 0 AS depth, [sib_ord] AS path_ord, [id] AS chain FROM nodes WHERE parent IS NULL
 UNION ALL SELECT n.id, n.parent, n.sib_ord, n.title, t.depth + 1, list_append(t.path_ord, n.sib_ord), list_append(t.chain, n.id) FROM nodes n JOIN tree t ON n.parent = t.id)"""


def nodes(spark, sf):
    """Regions over nations over customers."""
    r, n, c = (read(spark, sf, t) for t in ("region", "nation", "customer"))
    row = lambda df, i, p, o, t: df.select(F.concat(F.lit(i[0]), F.col(i[1]).cast("string")).alias("id"), p.alias("parent"), F.col(o).cast("long").alias("sib_ord"), F.col(t).alias("title"))
    up = lambda x, c: F.concat(F.lit(x), F.col(c).cast("string"))
    return row(r, ("r", "r_regionkey"), F.lit(None).cast("string"), "r_regionkey", "r_name").unionAll(row(n, ("n", "n_nationkey"), up("r", "n_regionkey"), "n_nationkey", "n_name")).unionAll(row(c, ("c", "c_custkey"), up("n", "c_nationkey"), "c_custkey", "c_name"))


def levelled(spark, sf):
    return tree.levels(nodes(spark, sf))


@query("tree_preorder", f"WITH RECURSIVE {TREE_SQL} SELECT id, depth::BIGINT AS depth, row_number() OVER (ORDER BY path_ord)::BIGINT AS position FROM tree")
def tree_preorder(spark, sf):
    t = levelled(spark, sf)
    return t.select("id", F.col("depth").cast("long").alias("depth")).join(tree.preorder(t).withColumnRenamed("id", "pid"), F.col("id") == F.col("pid")).select("id", "depth", "position")


@query("tree_depth_leaf", f"WITH RECURSIVE {TREE_SQL} SELECT id, depth::BIGINT AS depth, id NOT IN (SELECT parent FROM nodes WHERE parent IS NOT NULL) AS is_leaf, len(chain)::BIGINT AS chain_length FROM tree")
def tree_depth_leaf(spark, sf):
    t = levelled(spark, sf)
    leaf = tree.leaves(nodes(spark, sf)).select(F.col("id").alias("lid"))
    return t.join(leaf, F.col("id") == F.col("lid"), "left").select("id", F.col("depth").cast("long").alias("depth"), F.col("lid").isNotNull().alias("is_leaf"), F.size("chain").cast("long").alias("chain_length"))


_KIND = "CASE WHEN id LIKE 'n%' AND sib_ord % 3 = 0 THEN 'title' WHEN id LIKE 'n%' AND sib_ord % 3 = 1 THEN 'letter' WHEN id LIKE 'c%' AND sib_ord % 10 = 0 THEN 'letter' END"


@query(
    "nearest_ancestor",
    f"""WITH RECURSIVE {TREE_SQL}, kinds AS (SELECT id, {_KIND} AS kind FROM nodes),
    links AS (SELECT id, unnest(chain) AS ancestor, generate_subscripts(chain, 1) - 1 AS pos, depth FROM tree),
    ranked AS (SELECT l.id, l.ancestor, l.depth - l.pos AS distance, CASE k.kind WHEN 'title' THEN 1 WHEN 'letter' THEN 2 ELSE CASE WHEN l.pos = 0 THEN 3 END END AS r FROM links l JOIN kinds k ON l.ancestor = k.id)
    SELECT id, arg_min(ancestor, {{'r': r, 'd': distance}}) AS group_id FROM ranked WHERE r IS NOT NULL GROUP BY id""",
)
def nearest_ancestor(spark, sf):
    n = nodes(spark, sf)
    kind = F.when(F.col("id").startswith("n") & (F.col("sib_ord") % 3 == 0), "title").when(F.col("id").startswith("n") & (F.col("sib_ord") % 3 == 1), "letter").when(F.col("id").startswith("c") & (F.col("sib_ord") % 10 == 0), "letter")
    return tree.nearest(tree.levels(n), n.select("id", kind.alias("kind")), ["title", "letter"])


_DEEP = "SELECT doc_id AS id, CASE WHEN doc_id > 0 THEN greatest(0, doc_id - 1 - doc_id % 3) END AS parent FROM documents"


@query(
    "deep_tree_tour",
    f"""WITH RECURSIVE n AS ({_DEEP}), t AS (SELECT id, 0::BIGINT AS depth, [id] AS chain FROM n WHERE parent IS NULL UNION ALL SELECT n.id, depth + 1, list_append(chain, n.id) FROM n JOIN t ON n.parent = t.id),
    sizes AS (SELECT a AS id, count(*)::BIGINT AS size FROM (SELECT unnest(chain) AS a FROM t) GROUP BY a)
    SELECT t.id, row_number() OVER (ORDER BY chain)::BIGINT AS position, depth, size FROM t JOIN sizes USING (id)""",
)
def deep_tree_tour(spark, sf):
    """Places, depths and subtrees of a tree that is a third as deep as it has nodes."""
    i = F.col("doc_id")
    n = read(spark, sf, "documents").select(i.alias("id"), F.when(i > 0, F.greatest(F.lit(0), i - 1 - i % 3)).alias("parent"), i.alias("sib_ord"))
    return tours.toured(n)


_SIZES = f"SELECT source, doc_id, len({sql_words('text')})::BIGINT AS words FROM documents"
# the packing rule as a recursive walk along each group
_PACK_SQL = f"""sizes AS ({_SIZES}), numbered AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM sizes),
walk AS (SELECT source, doc_id, words, rn, words AS total, 1 AS part FROM numbered WHERE rn = 1
 UNION ALL SELECT n.source, n.doc_id, n.words, n.rn, CASE WHEN w.total + n.words > 15000 THEN n.words ELSE w.total + n.words END, CASE WHEN w.total + n.words > 15000 THEN w.part + 1 ELSE w.part END
 FROM walk w JOIN numbered n ON n.source = w.source AND n.rn = w.rn + 1),
ends AS (SELECT source, max(part) AS last, arg_max(total, rn) AS last_total FROM walk GROUP BY source),
packed AS (SELECT w.source, w.doc_id, w.words, (CASE WHEN e.last > 1 AND e.last_total < 2000 AND w.part = e.last THEN w.part - 1 ELSE w.part END)::BIGINT AS part FROM walk w JOIN ends e ON w.source = e.source),
parts AS (SELECT *, (max(part) OVER (PARTITION BY source))::BIGINT AS parts FROM packed),
groups AS (SELECT source, row_number() OVER (ORDER BY min(doc_id))::BIGINT AS idx FROM parts GROUP BY source),
files AS (SELECT p.source, p.part, p.parts, g.idx, sum(p.words)::BIGINT AS words, count(*)::BIGINT AS docs FROM parts p JOIN groups g ON p.source = g.source GROUP BY ALL),
sequenced AS (SELECT *, row_number() OVER (ORDER BY idx, part)::BIGINT AS sequence FROM files)"""


def packed_docs(spark, sf):
    d = read(spark, sf, "documents").select("source", "doc_id", tx.word_count(F.col("text")).alias("words"))
    return sections.pack(d, "source", "doc_id", "words").withColumn("part", F.col("part").cast("long")).withColumn("parts", F.col("parts").cast("long"))


def sequenced(spark, sf):
    """One row for each part with its place among all parts."""
    p = packed_docs(spark, sf)
    files = p.groupBy("source", "part", "parts").agg(F.sum("words").alias("words"), F.count("*").alias("docs"))
    # as many rows as there are files: one window over them is small by the size of a file
    numbered = files.join(sections.ordinals(p, "source", "doc_id").withColumnRenamed("source", "_s"), F.col("source") == F.col("_s")).drop("_s")
    return numbered.withColumn("sequence", F.row_number().over(Window.orderBy("index", "part")).cast("long"))


@query("capped_packing", f"WITH RECURSIVE {_PACK_SQL} SELECT source, doc_id, words, part, parts FROM parts")
def capped_packing(spark, sf):
    return packed_docs(spark, sf).select("source", "doc_id", "words", "part", "parts")


@query("capped_packing_spread", f"WITH RECURSIVE {_PACK_SQL} SELECT source, doc_id, words, part, parts FROM parts")
def capped_packing_spread(spark, sf):
    """As ``capped_packing``, every group as one that is too large for an array."""
    d = read(spark, sf, "documents").select("source", "doc_id", tx.word_count(F.col("text")).alias("words"))
    packed = sections.pack(d, "source", "doc_id", "words", large=0)
    return packed.select("source", "doc_id", "words", F.col("part").cast("long").alias("part"), F.col("parts").cast("long").alias("parts"))


@query("group_ordinals", f"WITH RECURSIVE {_PACK_SQL} SELECT source, idx AS index, part, parts, sequence, words, docs FROM sequenced")
def group_ordinals(spark, sf):
    return sequenced(spark, sf).select("source", "index", "part", "parts", "sequence", "words", "docs")


_NAME = "printf('%02d-%02d-', sequence, idx) || CASE WHEN regexp_extract(title, '^T[íi]tulo\\s+([IVXLC]+)\\b', 1) <> '' THEN 'titulo-' || lower(regexp_extract(title, '^T[íi]tulo\\s+([IVXLC]+)\\b', 1)) ELSE trim(left(trim(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '-'), 24), '-') END || CASE WHEN parts > 1 THEN '-parte-' || part ELSE '' END || '.md'"
_TITLED = "CASE WHEN idx % 2 = 0 THEN 'Título XI de ' || source ELSE 'Section of ' || source || ' with a long name' END"


def named(spark, sf):
    title = F.when(F.col("index") % 2 == 0, F.concat(F.lit("Título XI de "), "source")).otherwise(F.concat(F.lit("Section of "), "source", F.lit(" with a long name")))
    rows = sequenced(spark, sf).withColumn("title", title)
    return rows.withColumn("filename", sections.part_name(*[F.col(c) for c in ("sequence", "index", "title", "part", "parts")]))


_NAMED_SQL = f"{_PACK_SQL}, titled AS (SELECT *, {_TITLED} AS title FROM sequenced), named AS (SELECT *, {_NAME} AS filename FROM titled)"


@query("part_filenames", f"WITH RECURSIVE {_NAMED_SQL} SELECT source, part, filename FROM named")
def part_filenames(spark, sf):
    return named(spark, sf).select("source", "part", "filename")


@query(
    "part_navigation",
    f"""WITH RECURSIVE {_NAMED_SQL}, hops AS (SELECT *, lag(filename) OVER (PARTITION BY source ORDER BY part) AS prev, lead(filename) OVER (PARTITION BY source ORDER BY part) AS next FROM named)
    SELECT filename, '# ' || title || CASE WHEN parts > 1 THEN ' — Parte ' || part || ' de ' || parts ELSE '' END AS heading,
    CASE WHEN parts > 1 THEN '*Parte ' || part || ' de ' || parts || ' de este Título · ' || concat_ws(' · ', CASE WHEN part > 1 THEN 'anterior: `' || prev || '`' END, CASE WHEN part < parts THEN 'siguiente: `' || next || '`' END) || '*' END AS navigation FROM hops""",
)
def part_navigation(spark, sf):
    w = Window.partitionBy("source").orderBy("part")
    rows = named(spark, sf).withColumn("prev", F.lag("filename").over(w)).withColumn("next", F.lead("filename").over(w))
    part, parts = F.col("part"), F.col("parts")
    return rows.select("filename", sections.heading(F.col("title"), part, parts).alias("heading"), sections.navigation(part, parts, F.col("prev"), F.col("next")).alias("navigation"))


@query(
    "emit_once_ancestors",
    f"""WITH RECURSIVE {TREE_SQL}, links AS (SELECT chain[1] AS section, unnest(chain) AS ancestor, generate_subscripts(chain, 1) AS pos, path_ord, id FROM tree),
    first AS (SELECT *, row_number() OVER (PARTITION BY section, ancestor ORDER BY path_ord) AS rn FROM links WHERE pos > 1)
    SELECT section, ancestor, id AS emitted_at, pos::BIGINT AS depth FROM first WHERE rn = 1""",
)
def emit_once_ancestors(spark, sf):
    chain = levelled(spark, sf).select(F.col("chain")[0].alias("section"), F.posexplode("chain").alias("pos", "ancestor"), "path_ord", F.col("id").alias("emitted_at")).where("pos > 0")
    return tree.emitted_once(chain, F.col("section"), F.col("ancestor"), [F.col("path_ord")]).select("section", "ancestor", "emitted_at", (F.col("pos") + 1).cast("long").alias("depth"))


@query(
    "markdown_section",
    f"""WITH RECURSIVE {_NAMED_SQL}, bodies AS (SELECT p.source, p.part, string_agg('**Cita:** ' || d.lang || ', ' || d.doc_id || chr(10) || chr(10) || d.text || chr(10), chr(10) ORDER BY d.doc_id) AS body FROM parts p JOIN documents d USING (doc_id) GROUP BY ALL)
    SELECT n.filename, sha256('---' || chr(10) || 'section: ' || n.source || chr(10) || 'order: ' || n.idx || chr(10) || 'part: ' || n.part || chr(10) || 'parts: ' || n.parts || chr(10) || '---' || chr(10) || '# ' || n.title || CASE WHEN n.parts > 1 THEN ' — Parte ' || n.part || ' de ' || n.parts ELSE '' END || chr(10) || chr(10) || b.body) AS sha256
    FROM named n JOIN bodies b ON n.source = b.source AND n.part = b.part""",
)
def markdown_section(spark, sf):
    """Each part as one Markdown text: front matter, heading, its documents with their citations."""
    d = read(spark, sf, "documents").select(F.col("doc_id").alias("did"), F.concat("lang", F.lit(", "), F.col("doc_id").cast("string")).alias("citation"), F.col("text").alias("markdown"))
    docs = packed_docs(spark, sf).join(d, F.col("doc_id") == F.col("did")).select("source", "part", "doc_id", "citation", "markdown")
    made = sections.markdown(named(spark, sf), docs, ["source", "part"], "doc_id", [("section", "source"), ("order", "index"), ("part", "part"), ("parts", "parts")])
    return made.select("filename", F.sha2("text", 256).alias("sha256"))
