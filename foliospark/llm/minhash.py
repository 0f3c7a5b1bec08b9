"""Near-duplicate documents: fast similarity sketching, banding, exact verification.

The sketch has ``coordinates`` bins. In round i of the first half every
shingle is hashed to one bin and leaves (i, hash) there if that is smaller
than what the bin holds; in the second half, round i throws every shingle into
bin i. A document stops when all its bins are filled, so that each bin is
filled for certain and the share of equal bins concentrates about the Jaccard
similarity as for independent minima.

Plan
----
1. One Arrow pass makes a sketch and a 64-bit fingerprint of the shingle set.
   Rows with equal sets form a class, which has that fingerprint as its key.
2. Sketches are cut into ``bands``; classes that share a band are candidates.
   The smallest member of a band is its center; each class is paired with the
   two centers that it meets in most bands and that is smallest. Pairs are
   verified on whole shingle sets, streamed past the center's set, and give
   first components. There are at most two pairs for each class.
3. What bands then hold from different components falls into candidate groups
   (connected by bands), which are packed into blocks of bounded size. A group
   that fits in a block is compared there, whole, through an inverted list, so
   each of its sets is shipped once. A larger group takes several blocks, apart
   for a component that fills blocks of its own; two of its blocks meet if a
   band is in both, unless they hold nothing but the same component. Only links
   between components are returned. Afterwards no band holds an unverified pair
   from two components, so the components are those of all candidate pairs.

Sets are shipped as many times as their group has blocks of other components:
once for all groups of less than ``BLOCK`` shingles outside their largest
component, however large that is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm import common
from foliospark.llm.common import U64, mix

BANDS, ROWS = 32, 5
#: Shingles in a block, about; a single larger set is a block of its own size.
BLOCK = 400_000
#: Entries of an inverted list that are counted at once.
AT_ONCE = 2_000_000


def sketch(grams: np.ndarray, row: np.ndarray, rows: int, coordinates: int) -> np.ndarray:
    """Sketches (rows x coordinates, 32 bits each) of the distinct ``grams`` of each ``row``.

    Rows without grams keep the value of empty bins in all coordinates.
    """
    empty = U64(2**64 - 1)
    bins = np.full(rows * coordinates, empty, U64)
    grams, row = grams.copy(), row.astype(np.int64)
    for i in range(2 * coordinates):
        if not len(grams):
            break
        key = mix(grams + U64((i + 1) * 0xA0761D6478BD642F % 2**64))
        if i < coordinates:
            at = ((key >> U64(32)) * U64(coordinates) >> U64(32)).astype(np.int64)
        else:
            at = np.full(len(grams), i - coordinates, np.int64)
        np.minimum.at(bins, row * coordinates + at, (U64(i) << U64(32)) | (key & U64(0xFFFFFFFF)))
        open_rows = (bins.reshape(rows, coordinates) == empty).any(axis=1)
        keep = open_rows[row]
        grams, row = grams[keep], row[keep]
    return ((bins & U64(0xFFFFFFFF)) ^ ((bins >> U64(32)) * U64(0x9E3779B1) & U64(0xFFFFFFFF))).astype(np.uint32).reshape(rows, coordinates)


def band_keys(made: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit key for each band of each sketch."""
    parts = made.reshape(len(made), bands, -1).astype(U64)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=U64) * U64(0x9E3779B97F4A7C15), parts.shape[:2]).copy()
    for r in range(parts.shape[2]):
        key = mix(key * U64(0xD6E8FEB86659FD93) + parts[:, :, r])
    return key


def _sketches(k: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            sets = common.shingle_sets(common.column(batch, "text"), k)
            sizes = np.array([len(s) for s in sets], np.int64)
            made = sketch(np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes), len(sets), bands * rows)
            keys = band_keys(made, bands).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    common.column(batch, "doc_id"),
                    pa.array(sizes),
                    pa.array([fingerprint(s) for s in sets], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, bands, dtype=np.int32)), pa.array(keys.ravel())),
                ],
                names=["doc_id", "n_shingles", "class", "bands"],
            )

    return run


def fingerprint(grams: np.ndarray) -> int | None:
    """Of a sorted shingle set; an empty set has none."""
    return int(np.array([xxhash.xxh3_64_intdigest(grams.tobytes())], U64).view(np.int64)[0]) if len(grams) else None


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            sets = [s for s in common.shingle_sets(common.column(batch, "text"), k) if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([fingerprint(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["class", "n", "grams"])

    return run


def _alike(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(one, other, assume_unique=True))
    return 100 * both >= percent * (len(one) + len(other) - both)


def _verify(percent: int):
    """Rows come sorted by (center, salt, member); the center's own set first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, base = None, np.zeros(0, U64)
        for batch in common.slices(batches, "grams"):
            linked: tuple[list[int], list[int]] = ([], [])
            for c, m, grams in zip(*(common.column(batch, x).to_pylist() for x in ("center", "member", "grams")), strict=True):
                if m is None:
                    now, base = c, np.frombuffer(grams, U64)
                elif c == now and _alike(base, np.frombuffer(grams, U64), percent):
                    linked[0].append(c)
                    linked[1].append(m)
            yield pa.RecordBatch.from_arrays([pa.array(linked[0], pa.int64()), pa.array(linked[1], pa.int64())], names=["a", "b"])

    return run


def verify(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Those ``pairs`` (center, member) of classes whose ``sets`` are at least ``percent`` similar.

    A center with many partners is dealt to several tasks, with its set in each.
    """
    spark = sets.sparkSession
    counts = pairs.groupBy("center").agg((F.count("*") / 64 + 1).cast("int").alias("salts"))
    salted = pairs.join(counts, "center").select("center", "member", F.pmod(F.xxhash64("member"), F.col("salts")).cast("int").alias("salt"))
    held = sets.select("class", "grams")
    members = salted.join(held, salted["member"] == held["class"]).select("center", "salt", "member", "grams")
    centers = counts.select("center", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")).join(held, F.col("center") == F.col("class")).select("center", "salt", F.lit(None).cast("long").alias("member"), "grams")
    dealt = members.unionByName(centers).repartition(common.partitions(spark), "center", "salt").sortWithinPartitions("center", "salt", F.col("member").asc_nulls_first())
    return dealt.mapInArrow(_verify(percent), "a long, b long")


class Block:
    """Sets of a block with their classes and components, and an inverted list over them.

    Components that a link has joined are one from then on, so at most as many
    links are told as there are components.
    """

    def __init__(self, percent: int):
        self.percent, self.ids, self.components, self.sets = percent, [], [], []
        self.above: dict[int, int] = {}  # a component that was joined to another, and that

    def add(self, own: int, component: int, grams: np.ndarray) -> None:
        self.ids.append(own)
        self.components.append(component)
        self.sets.append(grams)

    def invert(self) -> None:
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        grams = np.concatenate(self.sets)
        order = np.argsort(grams, kind="stable")
        self.distinct, start = np.unique(grams[order], return_index=True)
        self.start, self.holder = np.append(start, len(order)), np.repeat(np.arange(len(self.sets)), self.sizes)[order]
        self.label = np.array(self.components, np.int64)  # what each member's component is joined to

    def links(self, component: int, grams: np.ndarray) -> list[int]:
        """Linked members that join the component with others."""
        at = np.searchsorted(self.distinct, grams)
        at = at[(at < len(self.distinct)) & (self.distinct[np.minimum(at, len(self.distinct) - 1)] == grams)]
        if not len(at):
            return []
        first, reach = self.start[at], self.start[at + 1] - self.start[at]
        both, ends = np.zeros(len(self.sets), np.int64), np.cumsum(reach)
        for a in range(0, int(ends[-1]), AT_ONCE):
            some = slice(np.searchsorted(ends, a, side="right"), np.searchsorted(ends, a + AT_ONCE, side="right"))
            n, f = reach[some], first[some]
            if len(n):
                both += np.bincount(self.holder[np.repeat(f - np.cumsum(n) + n, n) + np.arange(n.sum())], minlength=len(both))
        found, out = np.flatnonzero(100 * both >= self.percent * (self.sizes + len(grams) - both)), []
        while component in self.above:
            component = self.above[component]
        found = found[self.label[found] != component]
        while len(found):
            out.append(self.ids[found[0]])
            joined = int(self.label[found[0]])
            self.above[joined] = component
            self.label[self.label == joined] = component
            found = found[self.label[found] != component]
        return out


def _meet(percent: int):
    """Links between components for each pair of blocks; rows come sorted by (x, y, side). Where x is y there is but one side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, left, ready = None, Block(percent), False

        def found(own: int, component: int, grams: np.ndarray, out: tuple[list[int], list[int]]) -> None:
            for other in left.links(component, grams):
                out[0].append(min(own, other))
                out[1].append(max(own, other))

        def within(out: tuple[list[int], list[int]]) -> None:
            """What a block has in itself."""
            if now is not None and now[0] == now[1] and len(set(left.components)) > 1:
                left.invert()
                for row in zip(left.ids, left.components, left.sets, strict=True):
                    found(*row, out)

        def batch_of(out: tuple[list[int], list[int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["a", "b"])

        for batch in common.slices(batches, "grams"):
            out: tuple[list[int], list[int]] = ([], [])
            for x, y, side, own, component, raw in zip(*(common.column(batch, c).to_pylist() for c in ("x", "y", "side", "id", "component", "grams")), strict=True):
                if (x, y) != now:
                    within(out)
                    now, left, ready = (x, y), Block(percent), False
                grams = np.frombuffer(raw, U64)
                if side == 0:
                    left.add(own, component, grams)
                elif left.ids:
                    if not ready:
                        left.invert()
                        ready = True
                    found(own, component, grams, out)
            yield batch_of(out)
        last: tuple[list[int], list[int]] = ([], [])
        within(last)
        yield batch_of(last)

    return run


def _blocks(mixed: DataFrame, sets: DataFrame, block: int) -> DataFrame:
    """(id, component, group, block, alone) of the classes in ``mixed`` bands; ``alone``: no other block holds anything of the group."""
    n = common.partitions(mixed.sparkSession)
    who = common.table(mixed.groupBy("id").agg(F.min("center").alias("family"), F.first("component").alias("component")), "families")
    # a class is of the group of its family, and that of its own family: most of a large group meets in a few roots
    rooted = who.select("id", "family", "component", F.col("family").alias("root"))
    for _ in range(3):
        rooted = rooted.join(who.select(F.col("id").alias("root"), F.col("family").alias("above")), "root").select("id", "family", "component", F.col("above").alias("root"))
        rooted = common.table(rooted, "rooted")
    pairs = mixed.select("id", "center").join(rooted.select("id", "root"), "id").select("center", "root").distinct()
    pairs = pairs.join(rooted.select(F.col("id").alias("center"), F.col("root").alias("other")), "center").where("root <> other").select("root", "other").distinct()
    groups = common.components(pairs, "root", "other").select(F.col("id").alias("gid"), F.col("component").alias("of"))
    who = rooted.join(groups, F.col("root") == F.col("gid"), "left").select("id", "family", "component", F.coalesce("of", "root").alias("group"))
    who = common.table(who.join(sets.select(F.col("class").alias("id"), "n").dropDuplicates(["id"]), "id"), "members")
    total = F.sum("n").alias("total")
    one = who.groupBy("group").agg(total).withColumn("alone", F.col("total") <= block)
    one = common.table(one.select(F.col("group").alias("g"), "total", "alone"), "groups")
    bins = max(n, int((one.where("alone").agg(F.sum("total")).first()[0] or 0) / block) + 1)
    who = who.join(one, F.col("group") == F.col("g")).select("id", "family", "component", "group", "n", "alone")
    small = who.where("alone").select("id", "component", "group", F.pmod(F.xxhash64("group"), F.lit(bins)).alias("block"), "alone")
    # of larger groups: components, then families that fill blocks of their own; what is left of the group together
    rest = who.where("not alone")
    shares = lambda *keys: rest.groupBy(*keys).agg(total).where(F.col("total") > block / 2)
    whole = shares("group", "component").select(F.col("group").alias("cg"), F.col("component").alias("cc"), (F.col("total") / block + 1).cast("int").alias("by_component"))
    rest = rest.join(whole, (F.col("group") == F.col("cg")) & (F.col("component") == F.col("cc")), "left")
    rest = common.table(rest.drop("cg", "cc"), "large-groups")
    other = rest.where("by_component is null")
    families = other.groupBy("group", "family").agg(total).where(F.col("total") > block / 2).select(F.col("group").alias("fg"), F.col("family").alias("ff"), (F.col("total") / block + 1).cast("int").alias("by_family"))
    joint = other.groupBy(F.col("group").alias("jg")).agg((F.sum("n") / block + 1).cast("int").alias("joint"))
    rest = rest.join(families, (F.col("group") == F.col("fg")) & (F.col("family") == F.col("ff")), "left").join(joint, F.col("group") == F.col("jg"), "left")
    key = (
        F.when(F.col("by_component").isNotNull(), F.xxhash64(F.lit("c"), "group", "component", F.pmod(F.xxhash64("id"), F.col("by_component"))))
        .when(F.col("by_family").isNotNull(), F.xxhash64(F.lit("f"), "group", "family", F.pmod(F.xxhash64("id"), F.col("by_family"))))
        .otherwise(F.xxhash64(F.lit("g"), "group", F.pmod(F.xxhash64("family"), F.col("joint"))))
    )
    return common.table(small.unionByName(rest.select("id", "component", "group", key.alias("block"), "alone")), "blocks")


def _rest(sets: DataFrame, buckets: DataFrame, parts: DataFrame, percent: int, block: int) -> DataFrame:
    """Links (a, b) between different components of ``parts`` that share a band."""
    spark = sets.sparkSession
    labelled = buckets.join(parts.withColumnRenamed("id", "pid"), F.col("id") == F.col("pid"), "left").select("band", "id", "center", F.coalesce("component", "id").alias("component"))
    several = labelled.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("band")
    mixed = common.table(labelled.join(several, "band"), "mixed")
    dealt = _blocks(mixed, sets, block)

    # blocks of the same larger group meet where a band is in both; bands of one group mostly lie in the same blocks
    spread = dealt.where("not alone")
    pure = spread.groupBy("block").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    held = mixed.select("band", "id").join(spread.select("id", "block"), "id").groupBy("band").agg(F.sort_array(F.collect_set("block")).alias("blocks"))
    held = common.table(held.select("blocks").distinct(), "bands-blocks")
    meet = held.select(F.posexplode("blocks").alias("i", "x"), "blocks").select("x", F.explode(F.expr("slice(blocks, i + 1, size(blocks))")).alias("y")).distinct()
    low, high = (pure.select(F.col("block").alias(c), F.col("low").alias(f"{c}_low"), F.col("high").alias(f"{c}_high")) for c in ("x", "y"))
    meet = meet.join(low, "x").join(high, "y").where("least(x_low, y_low) <> greatest(x_high, y_high)").select("x", "y")
    meet = common.table(meet.unionAll(dealt.where("alone").select(F.col("block").alias("x"), F.col("block").alias("y")).distinct()), "meetings")
    sides = meet.select("x", "y", F.lit(0).alias("side"), F.col("x").alias("own")).unionAll(meet.where("x <> y").select("x", "y", F.lit(1).alias("side"), F.col("y").alias("own")))
    rows = sides.join(dealt, F.col("own") == F.col("block")).join(sets, F.col("id") == F.col("class")).select("x", "y", "side", "id", "component", "grams")
    sorted_ = rows.repartition(common.partitions(spark), "x", "y").sortWithinPartitions("x", "y", "side")
    return sorted_.mapInArrow(_meet(percent), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``.

    Words are runs of characters other than space and \\x09-\\x0D after A-Z are
    lower-cased; a set holds the distinct ``k``-word shingles, or the whole
    sequence of a shorter text. Documents are linked where
    100 * |intersection| >= percent * |union|.

    Null, empty and blank texts have no shingles, are linked with nothing and
    kept. Repeated rows and texts are links of similarity 1. Rows with the same
    doc_id and different texts are linked with each other through their id,
    whatever their order: each has its own n_shingles and all have one
    component_id, but for those without shingles, which stay alone. Only
    ``doc_id`` and ``text`` are read, so further columns of any name do no
    harm. Rows with a null doc_id are not documents and are left out. An empty
    table gives an empty result. Shingles and whole sets are held as 64-bit
    fingerprints.

    A pair of the least similarity is missed by all bands with a chance of
    (1 - s ** rows) ** bands: 3e-6 at 0.80, 2e-8 at 0.85.
    """
    common.lean(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    made = common.table(docs.mapInArrow(_sketches(k, bands, rows), "doc_id long, n_shingles long, class long, bands array<long>"), "sketches")
    classes = common.table(made.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("rep")), "classes")
    reps = made.join(classes.withColumnRenamed("rep", "doc_id"), ["doc_id", "class"]).dropDuplicates(["class"])

    banded = common.table(reps.select(F.col("class").alias("id"), F.explode("bands").alias("band")), "bands")
    shared = banded.groupBy("band").agg(F.count("*").alias("members"), F.min("id").alias("center")).where("members > 1").select("band", "center")
    shared = common.table(shared, "shared")  # apart from the join, so that a band of very many members is split there
    buckets = common.table(banded.join(shared, "band").select("band", "id", "center"), "buckets")
    common.drop_table(banded)

    candidates = classes.join(buckets.select("id").distinct(), F.col("class") == F.col("id"), "left_semi")
    texts = common.restrict(docs, candidates, "doc_id", "rep").select("doc_id", "text").distinct()
    sets = common.table(texts.mapInArrow(_sets(k), "class long, n long, grams binary"), "sets")  # of candidates only
    met = buckets.where("id <> center").groupBy("id", "center").agg(F.count("*").alias("n"))
    near = met.groupBy("id").agg(F.max_by("center", F.struct("n", -F.col("center"))).alias("most"), F.min("center").alias("least"))
    stars = common.table(near.select(F.explode(F.array_distinct(F.array("most", "least"))).alias("center"), F.col("id").alias("member")), "stars")
    first = common.table(verify(sets, stars, percent), "links")
    parts = common.components(first)
    second = common.table(_rest(sets, buckets, parts, percent, block), "links")
    common.drop_table(buckets)

    # texts that share a doc_id are linked by it
    own = made.where("class is not null").groupBy("doc_id").agg(F.min("class").alias("a"), F.max("class").alias("z")).where("a <> z").select("doc_id", "a")
    own = common.table(made.select("doc_id", "class").where("class is not null").join(own, "doc_id").select("a", F.col("class").alias("b")).where("a <> b").distinct(), "same-id")
    if second.unionByName(own).limit(1).count():
        parts = common.components(first.unionByName(second).unionByName(own))

    known = common.table(classes.join(parts.withColumnRenamed("id", "pid"), F.col("class") == F.col("pid"), "left").select("class", "rep", F.coalesce("component", "class").alias("component")), "known")
    least = common.table(known.groupBy("component").agg(F.min("rep").alias("component_id")), "least")
    final = known.join(least, "component").select("class", "component_id")
    out = made.select("doc_id", "n_shingles", "class").join(final, "class", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def without_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document, that of the smallest id, of each component of near duplicates.

    Rows of one doc_id are one document: of a kept one all stay and of another
    one all go, whatever their texts. Rows without a doc_id stay.
    """
    return common.restrict(docs, near_duplicates(docs, k, percent).where("not kept"), "doc_id", "doc_id", "left_anti")
