"""Near-duplicate embeddings through robust-pruned flat graphs.

Vectors of one label are dealt to clusters, each to its ``OVERLAP`` nearest, so
that shards overlap. Centroids are fitted on a bounded sample of a cluster, on
the executors, and a cluster that is still too large is dealt again in the next
round, so their number grows with the label; a round deals a vector to the
``OVERLAP`` nearest parts of the cluster it is home in and to the nearest part
of the others it is in. Each shard builds a flat graph by robust pruning, the
adjacency lists of a vector from all its shards are united, and each vector then
searches the shard of its nearest cluster: greedily from the medoids of the
shard's regions, and from its own entry where it is a member, until the beam
holds no nearer vector to expand, then expanding its range, through every
neighbour within the radius, until nothing new is in range. Every ``EVERY``-th
member of a shard is audited: it is searched for and held against all members.
Where too little of that is found, the shard is searched exhaustively. What is
found is verified by cosines in double precision.

Equal vectors form one class, which is searched once and counted with its size.
A cluster that can't be dealt further is cut into blocks; its members are home
in one block and search all of them, one batch of askers at a time. A search
returns a number for each vector and one edge for each vector and component,
never pairs: a vector counts what is in the clusters it searches, and is told by
others only what its own search can't see.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm import common

COSINE = 0.93
OVERLAP = 3
#: Classes in a shard, about; twice as many are dealt again or cut.
SHARD = 1500
DEGREE = 24
POOL = 64
#: Random links from each vector, besides its degree.
FAR = 8
ALPHA = 1.2
BEAM = 32
#: Of the members of a shard one in so many, and eight at least, are audited; below this recall all searches are exhaustive.
EVERY, RECALL = 50, 0.9
#: Vectors that the centroids of a cluster are fitted on, and parts that it is dealt to in a round, at most.
SAMPLE, PARTS = 4_000, 256
#: A part with so much of its cluster is not dealt again.
STUCK = 0.9


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one. Scaled by the largest component first, so that no square over- or underflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


# ------------------------------------------------------------------- flat graph
def prune(own: np.ndarray, candidates: np.ndarray, near: np.ndarray, units: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """Robust pruning: keep the nearest candidate, drop those that it is ``alpha`` times nearer to, repeat.

    ``near``: cosines of the candidates with ``own``, in falling order.
    """
    distance = np.sqrt(np.maximum(2 - 2 * near, 0))
    among = np.sqrt(np.maximum(2 - 2 * (units[candidates] @ units[candidates].T), 0))
    alive, out = np.ones(len(candidates), bool), []
    for i in range(len(candidates)):
        if alive[i]:
            out.append(candidates[i])
            if len(out) == degree:
                break
            alive &= alpha * among[i] > distance
    return np.array(out, np.int64)


def build(units: np.ndarray) -> list[np.ndarray]:
    """Adjacency lists of a shard: pruned pools of nearest vectors, with edges back, pruned again where too many.

    Random links from each vector, and back, join regions that pools alone
    would not; no degree limit cuts them off.
    """
    n = len(units)
    if n == 1:
        return [np.zeros(0, np.int64)]
    pool = min(POOL, n - 1)
    rng = np.random.default_rng(n)
    lists: list[np.ndarray] = []
    joined: list[list[int]] = [[] for _ in range(n)]
    for a in range(0, n, 512):
        cosines = units[a : a + 512] @ units.T
        cosines[np.arange(len(cosines)), np.arange(a, a + len(cosines))] = -2
        nearest = np.argpartition(-cosines, pool - 1, axis=1)[:, :pool]
        for r in range(len(cosines)):
            for j in np.setdiff1d(rng.integers(0, n, FAR), [a + r]).tolist():
                joined[a + r].append(j)
                joined[j].append(a + r)
            some = nearest[r][np.argsort(-cosines[r, nearest[r]], kind="stable")]
            lists.append(prune(units[a + r], some, cosines[r, some], units))
    back: list[list[int]] = [[] for _ in range(n)]
    for i, own in enumerate(lists):
        for j in own.tolist():
            back[j].append(i)
    for i in range(n):
        both = np.union1d(lists[i], np.array(back[i], np.int64))
        if len(both) > 2 * DEGREE:
            near = units[both] @ units[i]
            order = np.argsort(-near, kind="stable")
            both = prune(units[i], both[order], near[order], units, 2 * DEGREE)
        lists[i] = np.union1d(both, np.array(joined[i], np.int64))
    return lists


def medoids(units: np.ndarray, least: float) -> np.ndarray:
    """The vector nearest to the mean, and one for each region: that with the most others within ``least``, then that of those not within ``least`` of one taken before, and so on.

    Pools of more than ``DEGREE`` near vectors can be links to themselves only;
    so many regions of that size at most are in a shard.
    """
    crowd = np.concatenate([(units[a : a + 512] @ units.T >= least).sum(axis=1) for a in range(0, len(units), 512)])
    out = [int(np.argmax(units @ units.mean(axis=0)))]
    for _ in range(len(units) // DEGREE + 1):
        i = int(np.argmax(crowd))
        if crowd[i] <= 1:  # no others
            break
        out.append(i)
        crowd[units @ units[i] >= least] = 0
        crowd[i] = 0
    return np.unique(out)


class Graph:
    def __init__(self, units: np.ndarray, lists: list[np.ndarray], least: float = COSINE):
        self.units, self.lists, self.starts = units, lists, medoids(units, least)

    def within(self, query: np.ndarray, least: float, beam: int = BEAM, own: int = -1) -> np.ndarray:
        """Vectors whose cosine with ``query`` is at least ``least``, as far as the search meets them.

        ``own``: where the query itself is in the shard, or -1.
        """
        ids = np.union1d(self.starts, [own]) if own >= 0 else self.starts
        seen = np.zeros(len(self.units), bool)
        seen[ids] = True
        near = self.units[ids] @ query
        order = np.argsort(-near, kind="stable")[:beam]
        ids, near, done = ids[order], near[order], np.zeros(len(order), bool)
        while not done.all():
            # greedily: the nearest few of the beam that are not expanded yet
            at = np.flatnonzero(~done)[:4]
            done[at] = True
            new = np.unique(np.concatenate([self.lists[i] for i in ids[at].tolist()]))
            new = new[~seen[new]]
            seen[new] = True
            ids, near, done = np.concatenate([ids, new]), np.concatenate([near, self.units[new] @ query]), np.concatenate([done, np.zeros(len(new), bool)])
            order = np.argsort(-near, kind="stable")[:beam]
            ids, near, done = ids[order], near[order], done[order]
        found, front = [], ids[near >= least]
        reached = np.zeros(len(self.units), bool)
        reached[front] = True
        while len(front):  # expand the range
            found.append(front)
            new = np.unique(np.concatenate([self.lists[i] for i in front.tolist()]))
            new = new[~reached[new]]
            front = new[self.units[new] @ query >= least]
            reached[front] = True
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def trusted(graph: Graph, least: float) -> bool:
    """Whether searches find at least ``RECALL`` of the links of audited members."""
    n = len(graph.units)
    audited = np.arange(0, n, max(1, min(EVERY, n // 8)))
    there = met = 0
    for a in range(0, len(audited), 512):
        some = audited[a : a + 512]
        for i, near in zip(some.tolist(), graph.units[some] @ graph.units.T, strict=True):
            exact = np.setdiff1d(np.flatnonzero(near >= least), [i])
            there += len(exact)
            met += int(np.isin(exact, graph.within(graph.units[i], least, own=i)).sum())
    return met >= RECALL * there


# --------------------------------------------------------------------- the plan
def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spherical k-means of each cluster's sample: its centroids in one row."""
    for (node,), rows in _groups(batches, ["node"]):
        x = unit(_matrix(rows["embedding"].combine_chunks()))
        rng = np.random.default_rng(0)
        c = x[rng.choice(len(x), min(rows["parts"][0].as_py(), len(x)), replace=False)]
        for _ in range(8):
            near = (x @ c.T).argmax(axis=1)
            for j in np.unique(near).tolist():
                mean = x[near == j].sum(axis=0)
                if (length := np.linalg.norm(mean)) > 0:
                    c[j] = mean / length
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([c.ravel()], pa.list_(pa.float64()))], names=["node", "embedding"])


def _segments(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Rows that come sorted by ``keys``, in parts of one key each."""
    for batch in batches:
        if batch.num_rows:
            columns = [common.column(batch, k).to_numpy(zero_copy_only=False) for k in keys]
            change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
            for a, b in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows], strict=True):
                yield tuple(c[a] for c in columns), batch.slice(a, b - a)


def _assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each member of a cluster its nearest parts; rows come sorted by (node, salt, rep), the centroids first, without a rep."""
    c = np.zeros((0, 0))
    for _, rows in _segments(batches, ["node", "salt"]):
        if not common.column(rows, "rep")[0].is_valid:
            width = common.column(rows, "width")[0].as_py()
            c, rows = common.column(rows, "embedding")[0].values.to_numpy().reshape(-1, width), rows.slice(1)
        if rows.num_rows:
            near = np.argsort(-(unit(_matrix(common.column(rows, "embedding"))) @ c.T), axis=1, kind="stable")[:, :OVERLAP]
            home = common.column(rows, "home").to_numpy(zero_copy_only=False)
            parts = [x if h else x[:1] for x, h in zip(near, home, strict=True)]
            yield pa.RecordBatch.from_arrays([common.column(rows, "node"), common.column(rows, "rep"), common.column(rows, "home"), pa.array(parts, pa.list_(pa.int64()))], names=["node", "rep", "home", "parts"])


def shards(classes: DataFrame) -> DataFrame:
    """(rep, node, home) of ``classes`` (rep, label, width, embedding): the clusters that each is in, home in one."""
    n = common.partitions(classes.sparkSession)
    nobody = F.lit(None).cast("long")
    now = common.table(classes.select("rep", F.xxhash64("label", "width").alias("node"), F.lit(True).alias("home"), nobody.alias("before")), "clusters")
    done = []
    while True:
        sizes = now.groupBy("node").agg(F.count("*").alias("n"), F.first("before").alias("before"))
        large = sizes.where((F.col("n") > 2 * SHARD) & F.expr(f"before is null or n < {STUCK} * before"))
        large = common.table(large.select("node", "n", F.least(F.lit(PARTS), F.ceil(F.col("n") / SHARD) * OVERLAP).cast("int").alias("parts"), F.ceil(F.col("n") / (16 * SHARD)).cast("int").alias("salts")), "large-clusters")
        if not large.limit(1).count():
            done.append(now)
            break
        done.append(common.table(now.join(large.select("node"), "node", "left_anti").select(*now.columns), "clusters"))
        rows = now.join(large, "node").join(classes.select("rep", "width", "embedding"), "rep")
        sample = rows.where(F.pmod(F.xxhash64("rep", F.lit(3)), F.lit(1 << 30)) < F.lit(float(SAMPLE * (1 << 30))) / F.col("n"))
        fitted = common.table(sample.select("node", "rep", "parts", "embedding").repartition(n, "node").sortWithinPartitions("node", "rep").mapInArrow(_fit, "node long, embedding array<double>"), "centroids")
        members = rows.select("node", F.pmod(F.xxhash64("rep", F.lit(4)), F.col("salts")).cast("int").alias("salt"), "rep", "width", "home", "embedding")
        centers = fitted.join(rows.groupBy("node").agg(F.first("width").alias("width"), F.first("salts").alias("salts")), "node")
        centers = centers.select("node", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), nobody.alias("rep"), "width", F.lit(False).alias("home"), "embedding")
        dealt = members.unionByName(centers).repartition(n, "node", "salt").sortWithinPartitions("node", "salt", F.col("rep").asc_nulls_first())
        near = dealt.mapInArrow(_assign, "node long, rep long, home boolean, parts array<long>").join(large.select("node", "n"), "node")
        near = near.select("rep", "node", "n", "home", F.posexplode("parts").alias("rank", "part"))
        now = common.table(near.select("rep", F.xxhash64("node", "part").alias("node"), (F.col("home") & (F.col("rank") == 0)).alias("home"), F.col("n").alias("before")), "clusters")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("rep", "node", "home")


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Whole groups, of bounded size, of rows that come sorted by ``keys``."""
    now, parts = None, []
    for key, rows in _segments(batches, keys):
        if key != now and parts:
            yield now, pa.Table.from_batches(parts)
            parts = []
        now = key
        parts.append(rows)
    if parts:
        yield now, pa.Table.from_batches(parts)


_SHARD_KEYS = ["node", "block"]


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, rows in _groups(batches, _SHARD_KEYS):
        ids = rows["rep"].to_numpy()
        lists = build(unit(_matrix(rows["embedding"].combine_chunks())))
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array([ids[x] for x in lists], pa.list_(pa.int64()))], names=["rep", "near"])


class Shard:
    """The members of a shard, what they are found by, and components as labels: the place of a member of the same component."""

    def __init__(self, members: pa.Table, least: float):
        members = members.take(pa.array(np.argsort(members["rep"].to_numpy(), kind="stable")))
        self.least, self.ids, self.size = least, members["rep"].to_numpy(), members["size"].to_numpy()
        self.home, self.lives = members["home"].to_numpy(zero_copy_only=False), members["lives"].to_numpy()
        lists = []
        for near in members["near"].combine_chunks():
            near = near.values.to_numpy()
            at = np.minimum(np.searchsorted(self.ids, near), len(self.ids) - 1)
            lists.append(at[self.ids[at] == near])
        self.graph = Graph(unit(_matrix(members["embedding"].combine_chunks())), lists, least)
        self.by_graph = trusted(self.graph, least)
        self.met = np.zeros((len(self.ids), len(self.ids)), bool)
        self.told, self.label = np.zeros(len(self.ids), np.int64), np.arange(len(self.ids))

    def join(self, places: np.ndarray) -> None:
        labels = np.unique(self.label[places])
        if len(labels) > 1:
            self.label[np.isin(self.label, labels)] = labels[0]

    def ask(self, rows: pa.RecordBatch) -> pa.RecordBatch:
        """What a batch of vectors finds, but for links between two homes of this shard, which are made mutual in the end."""
        own, sizes = common.column(rows, "rep").to_numpy(), common.column(rows, "size").to_numpy()
        clusters, units = common.column(rows, "nodes"), unit(_matrix(common.column(rows, "embedding")))
        place = np.minimum(np.searchsorted(self.ids, own), len(self.ids) - 1)
        place = np.where(self.ids[place] == own, place, -1)
        exact = None if self.by_graph else units @ self.graph.units.T >= self.least
        count, edges = np.zeros(len(own), np.int64), ([], [])
        for r, p in enumerate(place.tolist()):
            hits = self.graph.within(units[r], self.least, own=p) if exact is None else np.flatnonzero(exact[r])
            hits = hits[hits != p]
            if not len(hits):
                continue
            self.join(np.append(hits, p) if p >= 0 else hits)
            if p < 0:
                edges[0].append(own[r])
                edges[1].append(self.ids[hits[0]])
            homes, guests = hits[self.home[hits]], hits[~self.home[hits]]
            if p >= 0 and self.home[p]:
                self.met[p, homes] = True
            else:  # home in another block of the cluster
                count[r] += self.size[homes].sum()
            count[r] += self.size[guests].sum()
            blind = guests[~np.isin(self.lives[guests], clusters[r].values.to_numpy())]  # whose own search does not meet this vector
            self.told[blind] += sizes[r]
        return _found(own, count, *edges)

    def close(self) -> pa.RecordBatch:
        both = (self.met | self.met.T).astype(np.float32) @ self.size.astype(np.float64)
        joined = np.flatnonzero(self.label != np.arange(len(self.ids)))
        return _found(self.ids, both.astype(np.int64) + self.told, self.ids[joined], self.ids[self.label[joined]])


def _found(own: np.ndarray, count: np.ndarray, left, right) -> pa.RecordBatch:
    """Rows (a, n) of vectors with links and rows (a, b) of edges."""
    some = count > 0
    a, n = np.concatenate([own[some], np.array(left, np.int64)]), np.concatenate([count[some], np.zeros(len(left), np.int64)])
    b = pa.concat_arrays([pa.nulls(int(some.sum()), pa.int64()), pa.array(np.array(right, np.int64))])
    return pa.RecordBatch.from_arrays([pa.array(a), b, pa.array(n)], names=["a", "b", "n"])


def _search(least: float):
    """Each shard has its members (query false) and then the vectors that search it (query true)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, shard = None, [], None
        for (node, block, query), rows in _segments(batches, [*_SHARD_KEYS, "query"]):
            if (node, block) != now:
                if shard is not None:
                    yield shard.close()
                now, parts, shard = (node, block), [], None
            if not query:
                parts.append(rows)
            elif parts:
                shard = shard or Shard(pa.Table.from_batches(parts), least)
                yield shard.ask(rows)
        if shard is not None:
            yield shard.close()

    return run


def _valid() -> Column:
    """Whether a row's vector can be linked: a label, and finite components that are not all zero."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda x: x != 0.0), F.lit(False))


def _rows(embeddings: DataFrame) -> DataFrame:
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("long").alias("label")).where("vec_id is not null")


def near_duplicates(embeddings: DataFrame, least: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of ``embeddings`` (vec_id, embedding, label).

    Two vectors of the same non-null label and width are linked if their cosine
    in double precision is at least ``least`` and the search meets them.
    ``n_links`` counts other vectors linked directly, ``component_id`` is the
    smallest vec_id reachable by links.

    Vectors that are null, empty, zero, or hold null or non-finite components,
    and those without a label, are linked with nothing and kept. Finite vectors
    of any length, however large or small, count. Repeated rows are other
    vectors with the same content; rows with the same vec_id and other content
    are other vectors too, in one component by their id, whatever their order. A
    null vec_id is left out. Only these three columns are read. Equal vectors
    are told by 64-bit fingerprints.
    """
    spark = embeddings.sparkSession
    common.lean(spark)
    n = common.partitions(spark)
    rows = _rows(embeddings)
    content = F.transform("embedding", lambda x: x + F.lit(0.0))  # one zero, not two
    keyed = rows.where(_valid()).select("vec_id", "label", F.size("embedding").alias("width"), "embedding", F.xxhash64("label", F.size("embedding"), content).alias("class"))
    keyed = common.table(keyed, "vectors")
    sized = common.table(keyed.groupBy("class").agg(F.min("vec_id").alias("least_id"), F.count("*").alias("size")), "classes")
    classes = keyed.join(sized.withColumnRenamed("least_id", "vec_id"), ["class", "vec_id"]).dropDuplicates(["class"])
    classes = common.table(classes.select(F.col("class").alias("rep"), "label", "width", "embedding", "size"), "reps")

    placed = shards(classes)
    counts = placed.groupBy("node").agg((F.count("*") / (2 * SHARD) + 1).cast("int").alias("blocks"))
    placed = placed.join(counts, "node").withColumn("block", F.pmod(F.xxhash64("rep", F.lit(5)), F.col("blocks")).cast("int"))
    placed = common.table(placed.join(classes, "rep"), "shards")
    where = placed.groupBy("rep").agg(F.collect_list("node").alias("nodes"), F.max(F.when(F.col("home"), F.col("node"))).alias("lives"))  # a few for each round

    sort = lambda df, *keys: df.repartition(n, *_SHARD_KEYS).sortWithinPartitions(*_SHARD_KEYS, *keys)
    lists = sort(placed.select(*_SHARD_KEYS, "rep", "embedding"), "rep").mapInArrow(_build, "rep long, near array<long>")
    united = lists.groupBy("rep").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))  # a few bounded lists
    united = common.table(united.join(where, "rep"), "adjacency")

    columns = [*_SHARD_KEYS, "rep", "embedding", "near", "home", "size", "lives", "nodes"]
    members = placed.join(united, "rep").select(*columns, F.lit(False).alias("query"))
    asking = members.where("home").drop("block", "near", "query").join(counts, "node").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    asking = asking.withColumn("near", F.lit(None).cast("array<long>")).select(*columns, F.lit(True).alias("query"))
    found = common.table(sort(members.unionByName(asking), "query", "rep").mapInArrow(_search(least), "a long, b long, n long"), "found")

    # rows that share a vec_id are in one component
    own = keyed.groupBy("vec_id").agg(F.min("class").alias("a"), F.max("class").alias("z")).where("a <> z").select("vec_id", "a")
    own = keyed.select("vec_id", "class").join(own, "vec_id").select("a", F.col("class").alias("b")).where("a <> b").distinct()
    linked = found.where("b is null").groupBy(F.col("a").alias("lid")).agg(F.sum("n").alias("links"))
    parts = common.components(found.where("b is not null").select("a", "b").unionByName(own))

    known = sized.join(linked, F.col("class") == F.col("lid"), "left").join(parts.withColumnRenamed("id", "pid"), F.col("class") == F.col("pid"), "left")
    known = known.select("class", "least_id", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component", "class").alias("component"))
    known = common.table(known, "known")
    smallest = known.groupBy("component").agg(F.min("least_id").alias("component_id"))
    final = known.join(smallest, "component").select("class", "n_links", "component_id")
    good = keyed.select("vec_id", "class").join(final, "class").select("vec_id", "n_links", "component_id")
    rest = rows.where(~_valid()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(rest).withColumn("kept", F.col("vec_id") == F.col("component_id"))


#: Vectors that are held against the rows of a label at once, and rows that one task holds against them, about.
AUDITED, AGAINST = 256, 100_000


def _tally(least: float):
    """Links of each asked vector; rows come sorted by (label, width, part, salt, asked), those that ask first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, parts, asking, count = None, np.zeros(0, np.int64), [], None, None

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(count)], names=["vec_id", "hits"])

        for key, rows in _segments(batches, ["label", "width", "part", "salt", "other"]):
            if key[:4] != now:
                if count is not None:
                    yield told()
                now, ids, parts, asking, count = key[:4], np.zeros(0, np.int64), [], None, None
            if not key[4]:
                parts.append(rows)
                continue
            if not parts:
                continue
            if asking is None:
                table = pa.Table.from_batches(parts)
                ids, asking = table["vec_id"].to_numpy(), unit(_matrix(table["embedding"].combine_chunks()))
                count = np.zeros(len(ids), np.int64)
            count += (asking @ unit(_matrix(common.column(rows, "embedding"))).T >= least).sum(axis=1)
        if count is not None:
            yield told()

    return run


def audit(embeddings: DataFrame, found: DataFrame, least: float = COSINE, every: int = 50) -> DataFrame:
    """Recall of ``found`` (:func:`near_duplicates`) for the vectors whose id ``every`` divides, against all rows.

    Links found are verified, so they are among the exact ones. Rows: vec_id,
    n_links, exact_links; both are 0 for a vector that can't be linked or is
    alone in its label and width. Asked vectors meet the rows of their label in
    blocks of ``AUDITED``. Ids are taken to be distinct.
    """
    n = common.partitions(embeddings.sparkSession)
    rows = common.table(_rows(embeddings).where(_valid()).withColumn("width", F.size("embedding")), "audited")
    groups = rows.groupBy("label", "width").agg((F.sum((F.col("vec_id") % every == 0).cast("long")) / AUDITED + 1).cast("int").alias("parts"), (F.count("*") / AGAINST + 1).cast("int").alias("salts"))
    rows = rows.join(groups, ["label", "width"])
    spread = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    columns = ["label", "width", "part", "salt", "vec_id", "embedding"]
    asked = rows.where(F.col("vec_id") % every == 0).withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(6)), F.col("parts")).cast("int")).withColumn("salt", spread("salts")).select(*columns, F.lit(False).alias("other"))
    other = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id", F.lit(7)), F.col("salts")).cast("int")).withColumn("part", spread("parts")).select(*columns, F.lit(True).alias("other"))
    keys = ["label", "width", "part", "salt"]
    exact = asked.unionByName(other).repartition(n, *keys).sortWithinPartitions(*keys, "other").mapInArrow(_tally(least), "vec_id long, hits long")
    exact = exact.groupBy(F.col("vec_id").alias("asked_id")).agg((F.sum("hits") - 1).alias("exact"))  # each meets itself
    chosen = found.where(F.col("vec_id") % every == 0)
    return chosen.join(exact, F.col("vec_id") == F.col("asked_id"), "left").select("vec_id", "n_links", F.coalesce("exact", F.lit(0)).alias("exact_links"))
