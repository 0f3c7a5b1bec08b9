"""A Merkle manifest of a dataset: one digest for each row, each group and the whole, with proofs that fold back to the root.

Plan
----
1. Leaves: one scan makes a digest for each row (and one for what the row
   should be checked as); texts go no further.
2. Positions: leaves are numbered within their group over range partitions
   (``operators.ranks``), so that a group of any size is spread.
3. Levels: a window over (group, parent index), ordered by index, collects each
   run of ``ARITY`` nodes over the full frame. The list is the parent's
   preimage and holds every member's siblings; one row for each parent is kept
   and written, and is a node of the next level. A level is a sixteenth of the
   one before it. The roots of the groups form a tree of their own.
4. Proofs: from the top down, each run hands its path to its members, so a
   long path is shipped once for ``ARITY`` leaves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm import common
from foliospark.operators import ranks

ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left:string,right:string>>"


def digest(fields: list[Column]) -> Column:
    """Lower-case hex sha256 of the fields: ``-`` for null, else the UTF-8 byte count, a colon and the value."""
    told = [F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string"))) for c in fields]
    return F.sha2(F.concat(*told), 256)


def _joined(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda x: x["hash"]), "")


def _levels(nodes: DataFrame, largest: int, arity: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Runs of each level, and of each level the nodes that are alone in their group (one level more). ``nodes``: grp, idx, size, hash, load."""
    load, runs, tops = nodes.schema["load"].dataType, [], []
    while True:
        tops.append(nodes.where("size = 1").select("grp", "idx", "hash", "load"))
        if largest <= 1:
            return runs, tops
        run = nodes.where("size > 1").withColumn("parent", F.floor(F.col("idx") / arity).cast("long"))
        whole = Window.partitionBy("grp", "parent").orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        run = run.withColumn("kids", F.collect_list(F.struct("hash", "load")).over(whole)).where(F.col("idx") % arity == 0)
        run = run.select("grp", F.col("parent").alias("idx"), F.ceil(F.col("size") / arity).cast("long").alias("size"), "kids", F.sha2(_joined(F.col("kids")), 256).alias("hash"))
        runs.append(common.table(run, "merkle"))
        nodes = runs[-1].select("grp", "idx", "size", "hash", F.lit(None).cast(load).alias("load"))
        largest = -(-largest // arity)


def _paths(runs: list[DataFrame], tops: list[DataFrame], above: DataFrame, arity: int) -> DataFrame:
    """Of each leaf its group, hash, load and path to the root. ``above``: grp, path and others of each group's last node."""
    extra = [c for c in above.columns if c != "grp"]
    above = above.withColumnRenamed("grp", "of")

    def alone(level: int) -> DataFrame:
        return tops[level].join(above, F.col("grp").eqNullSafe(F.col("of"))).select("grp", "idx", "hash", "load", *extra)

    nodes = alone(len(runs))
    for level in reversed(range(len(runs))):
        up = nodes.select(F.col("grp").alias("of"), F.col("idx").alias("at"), *extra)
        members = runs[level].select("grp", "idx", "kids").join(up, F.col("grp").eqNullSafe(F.col("of")) & (F.col("idx") == F.col("at")))
        members = members.select("grp", "idx", "kids", *extra, F.posexplode("kids").alias("place", "kid"))
        left = _joined(F.slice("kids", F.lit(1), F.col("place")))
        right = _joined(F.slice("kids", F.col("place") + 2, F.size("kids")))
        members = members.withColumn("path", F.concat(F.array(F.struct(left.alias("left"), right.alias("right"))), F.col("path")))
        nodes = members.select("grp", (F.col("idx") * arity + F.col("place")).alias("idx"), F.col("kid.hash").alias("hash"), F.col("kid.load").alias("load"), *extra).unionByName(alone(level))
    return nodes


def _tree(leaves: DataFrame, order: list[str], by: str | None, arity: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Levels over ``leaves`` (grp, hash, load and what ``order`` names), in groups where ``by`` names them."""
    nodes = common.table(ranks.numbered(leaves, order, [by] if by else [], "idx", "size").select("grp", "idx", "size", "hash", "load"), "merkle")
    largest = nodes.agg(F.max("size")).first()[0]  # one number
    return _levels(nodes, largest or 0, arity)


def folded(path: Column, leaf: Column) -> Column:
    """The root that ``leaf`` and the siblings of ``path``, from the leaf's run up, lead to."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def siblings(path: Column) -> Column:
    """Digests of the siblings of ``path``, level by level, left to right, as one text."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def manifest(leaves: DataFrame, arity: int = ARITY) -> DataFrame:
    """The tree over ``leaves``: key, grp, leaf (a digest) and claim (any column, carried along).

    Rows: key, grp, leaf, claim, path (left and right siblings of each level,
    from the leaf's run to the root), subroot (of the group) and root. Leaves of
    a group ascend by key (null first, equal keys by leaf); groups are ordered
    by name, null first, bytewise. Every ``arity`` consecutive nodes become one
    while there are several; a lone leaf is its group's root, a lone group's
    root the root. Repeated rows have places of their own. An empty table has
    no rows and no root.
    """
    load = F.struct("key", "claim").alias("load")
    runs, tops = _tree(leaves.select("grp", F.col("leaf").alias("hash"), load, F.col("key").alias("_key")), ["_key", "hash"], "grp", arity)
    groups = tops[0]
    for more in tops[1:]:
        groups = groups.unionByName(more)
    groups = common.table(groups.select(F.lit(None).cast("long").alias("grp"), "hash", F.struct(F.col("grp").alias("of")).alias("load"), F.col("grp").alias("_order")), "merkle")
    over, ends = _tree(groups, ["_order"], None, arity)
    root = ends[-1].select(F.lit(None).cast("long").alias("grp"), F.array().cast(_PATH).alias("path"), F.col("hash").alias("root"))
    above = _paths(over, ends, root, arity).select(F.col("load.of").alias("grp"), "path", F.col("hash").alias("subroot"), "root")
    above = common.table(above, "merkle")
    told = _paths(runs, tops, above, arity)
    return told.select(F.col("load.key").alias("key"), "grp", F.col("hash").alias("leaf"), F.col("load.claim").alias("claim"), "path", "subroot", "root")


_LARGE, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def audit(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs`` by source, held against a copy in which some texts were changed.

    The copy has A-Z lower-cased in the texts whose doc_id's crc32 (of its
    decimal digits, unsigned) five divides. Rows: doc_id, leaf, subroot, root,
    proof_sha256 (of the siblings), folded_root (from the copy's leaf) and
    verified. A null doc_id is no such number, so its row is not changed; null
    texts stay null. Rows of one doc_id are leaves one after the other, by
    digest. Only the five fields are read; an empty table gives no rows.
    """
    fields = [F.col(c) for c in FIELDS]
    changed = [F.translate("text", _LARGE, _SMALL) if c == "text" else F.col(c) for c in FIELDS]
    hit = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    leaves = docs.select(F.col("doc_id").alias("key"), F.col("source").alias("grp"), digest(fields).alias("leaf"), F.when(hit, digest(changed)).alias("claim"))
    out = manifest(leaves)
    out = out.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"), folded(F.col("path"), F.coalesce("claim", "leaf")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def sql(levels: int = 5, arity: int = ARITY) -> str:
    """The rows of :func:`audit` in SQL, for up to ``arity ** levels`` rows of a source and as many sources."""

    def told(text: str) -> str:
        values = [f"CAST({text if c == 'text' else c} AS VARCHAR)" for c in FIELDS]
        return "sha256(" + " || ".join(f"CASE WHEN {c} IS NULL THEN '-' ELSE CAST(strlen({v}) AS VARCHAR) || ':' || {v} END" for c, v in zip(FIELDS, values, strict=True)) + ")"

    def level(k: int, grp: str, nodes: str, out: str) -> str:
        run = f"PARTITION BY {grp}, idx // {arity} ORDER BY idx"
        return f"""
{out}{k} AS (SELECT *, CASE WHEN size > 1 THEN coalesce(string_agg(hash, '') OVER ({run} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') ELSE '' END AS l,
    CASE WHEN size > 1 THEN coalesce(string_agg(hash, '') OVER ({run} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') ELSE '' END AS r FROM {nodes}{k}),
{nodes}{k + 1} AS (SELECT {grp}, idx // {arity} AS idx, (any_value(size) + {arity - 1}) // {arity} AS size, CASE WHEN any_value(size) > 1 THEN sha256(string_agg(hash, '' ORDER BY idx)) ELSE any_value(hash) END AS hash
    FROM {out}{k} GROUP BY {grp}, idx // {arity}),"""

    def up(node: str, step: str) -> str:
        return f"CASE WHEN {step}.size > 1 THEN sha256({step}.l || {node} || {step}.r) ELSE {node} END"

    steps = [f"a{k}" for k in range(levels)] + [f"b{k}" for k in range(levels)]
    joins = "".join(f"\nJOIN w{k} a{k} ON a{k}.grp IS NOT DISTINCT FROM x.grp AND a{k}.idx = x.idx // {arity**k}" for k in range(levels))
    joins += "\nJOIN s0 s ON s.grp IS NOT DISTINCT FROM x.grp" + "".join(f"\nJOIN v{k} b{k} ON b{k}.idx = s.idx // {arity**k}" for k in range(levels))
    folds, node = [], "node"
    for i, step in enumerate(steps):
        folds.append(f"f{i + 1} AS (SELECT * EXCLUDE (node), {up(node, f's{i}')} AS node FROM f{i})")
    chain = ",\n".join(f.replace(f"s{i}.size", f"{step}_size").replace(f"s{i}.l", f"{step}_l").replace(f"s{i}.r", f"{step}_r") for i, (f, step) in enumerate(zip(folds, steps, strict=True)))
    parts = ", ".join(f"{s}.size AS {s}_size, {s}.l AS {s}_l, {s}.r AS {s}_r" for s in steps)
    proof = " || ".join(f"{s}_l || {s}_r" for s in steps)
    return f"""
WITH RECURSIVE bits(b, k, c) AS (SELECT CAST(range AS UBIGINT), 0, CAST(range AS UBIGINT) FROM range(256)
    UNION ALL SELECT b, k + 1, xor(c >> 1, 3988292384::UBIGINT * (c & 1)) FROM bits WHERE k < 8),
crcs AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8),
rows_ AS (SELECT *, CAST(doc_id AS VARCHAR) AS d FROM documents),
leaves AS (SELECT doc_id, source AS grp, {told("text")} AS hash,
    CASE WHEN xor(list_reduce(list_transform(range(1, length(d) + 1), lambda i: CAST(ascii(substr(d, CAST(i AS INT), 1)) AS UBIGINT)), lambda c, x: xor(c >> 8, t[CAST(xor(c & 255, x) AS INT) + 1]), 4294967295::UBIGINT), 4294967295::UBIGINT) % 5 = 0
    THEN {told(f"translate(text, '{_LARGE}', '{_SMALL}')")} END AS claim FROM rows_, crcs),
n0 AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, hash) - 1 AS idx, count(*) OVER (PARTITION BY grp) AS size FROM leaves),{"".join(level(k, "grp", "n", "w") for k in range(levels))}
s0 AS (SELECT 0 AS g, grp, hash, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS idx, count(*) OVER () AS size FROM n{levels}),{"".join(level(k, "g", "s", "v") for k in range(levels))}
f0 AS (SELECT x.doc_id, x.hash AS leaf, s.hash AS subroot, (SELECT hash FROM s{levels}) AS root, coalesce(x.claim, x.hash) AS node, {parts} FROM n0 x{joins}),
{chain}
SELECT doc_id, leaf, subroot, root, sha256({proof}) AS proof_sha256, node AS folded_root, node = root AS verified FROM f{len(steps)}"""
