"""Shared pieces of the training-data operators.

* tables in the shared folder (``spark.checkpoint.dir``) that cut lineage and
  survive lost executors,
* vectorised word and shingle hashing over Arrow batches,
* connected components as DataFrame rounds.
"""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
_LEFT: dict[str, SparkSession] = {}


# --------------------------------------------------------------- shared folder
def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    ``spark.checkpoint.dir`` of the session where it is set; else a folder that
    was given to ``setCheckpointDir``; else, where driver and executors are one
    process, a new temporary one. A cluster must name its folder.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.partition("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="foliospark-")
        sc.setCheckpointDir(named)
        named = sc.getCheckpointDir()
    return named.rstrip("/")


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/foliospark/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _LEFT[path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    out._foliospark_path = path  # type: ignore[attr-defined]
    return out


def left(path: str, spark: SparkSession) -> None:
    """Delete ``path`` of the shared folder when the process ends."""
    _LEFT[path] = spark


def drop_table(df: DataFrame) -> None:
    """Delete what :func:`table` wrote; only for tables nothing refers to any more."""
    _delete(getattr(df, "_foliospark_path", None))


def _delete(path: str | None) -> None:
    spark = _LEFT.pop(path, None) if path else None
    if spark is None:
        return
    try:
        jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)
    except Exception:  # the session may be gone at interpreter exit
        pass


@atexit.register
def _sweep() -> None:
    for path in list(_LEFT):
        _delete(path)


#: At most so many ids are broadcast (16 MB as such, some 60 MB as a hash table).
BROADCAST_IDS = 1_000_000


def restrict(rows: DataFrame, ids: DataFrame, key: str, id_: str, how: str = "left_semi", most: int = BROADCAST_IDS) -> DataFrame:
    """``rows`` whose ``key`` is (``left_anti``: is not) among ``ids``.

    The ids are counted: up to ``most`` they are broadcast, so that texts are
    not shuffled for the sake of a few; beyond, the join is shuffled.
    """
    ids = table(ids.select(F.col(id_).cast("long").alias("_id")).where("_id is not null").distinct(), "ids")
    side = F.broadcast(ids) if ids.count() <= most else ids.hint("merge")
    return rows.join(side, rows[key].cast("long") == side["_id"], how)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ----------------------------------------------------------------- Arrow pieces
#: Rows in an Arrow batch at most; texts may be very long.
BATCH_ROWS = 1000


def lean(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``BATCH_ROWS`` rows: a worker holds one or two whole batches."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def give_back() -> None:
    """Return free memory to the system: Python workers live on after a task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``most`` bytes of text in each."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        total = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < n:
            base = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, base + most, side="right")))
            yield batch.slice(start, end - start)
            start = end
    give_back()


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, on arrays."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def hash_strings(words: pa.Array) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) for w in words.to_pylist()), dtype=U64, count=len(words))


def word_hashes(texts: pa.Array, lower: bool = True, clean=None) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (one more than rows) and a 64-bit hash for each word.

    A word is a run of characters other than space and ``\\x09-\\x0D``;
    ``lower`` folds A-Z only. Null texts have no words. ``clean`` rewrites the
    distinct words (``None`` or empty drops a word).
    """
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts)
    listed = pc.ascii_split_whitespace(texts)
    offsets = listed.offsets.to_numpy().astype(np.int64)
    flat = listed.values.slice(offsets[0], offsets[-1] - offsets[0])
    offsets = offsets - offsets[0]
    if not len(flat):
        return np.zeros(len(texts) + 1, np.int64), np.zeros(0, U64)
    coded = flat.dictionary_encode()
    words = coded.dictionary
    which = coded.indices.to_numpy().astype(np.int64)
    if clean is not None:
        new = [clean(w) for w in words.to_pylist()]
        keep = np.array([bool(w) for w in new])
        words = pa.array([w or "" for w in new], pa.string())
    else:
        keep = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    hashes = hash_strings(words)[which]
    kept = keep[which]
    if not kept.all():
        before = np.concatenate([[0], np.cumsum(kept)])
        offsets, hashes = before[offsets], hashes[kept]
    return offsets, hashes


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of ``k`` consecutive entries (document borders ignored).

    Runs of a power of two are joined from halves, and ``k`` from the two
    (overlapping) runs of the largest power that fit at its ends.
    """
    if len(hashes) < k:
        return np.zeros(0, U64)
    size, runs = 1, mix(hashes + U64(0x632BE59BD9B4E019))
    while 2 * size <= k:
        runs = mix(runs[:-size] * U64(0x9E3779B97F4A7C15) + runs[size:] + U64(size))
        size *= 2
    rest = k - size
    n = len(hashes) - k + 1
    return mix(runs[:n] * U64(0xD6E8FEB86659FD93) + runs[rest : rest + n] + U64(k))


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct ``k``-word shingle hashes for each text; a shorter text is one shingle."""
    offsets, hashes = word_hashes(texts)
    grams = gram_hashes(hashes, k)
    out = []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        if b - a >= k:
            out.append(np.unique(grams[a : b - k + 1]))
        elif b > a:
            out.append(gram_hashes(hashes[a:b], int(b - a)))
        else:
            out.append(np.zeros(0, U64))
    return out


# ------------------------------------------------------------------- components
def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected ``edges`` as rows (id, component = smallest id).

    Rounds of least-neighbour labels with pointer jumping; each round is
    aggregated before it is shuffled and ends in a shared table. A vertex of
    any degree is safe: its edges are only aggregated or joined, and a skewed
    join is split by AQE. Labels only fall, so the rounds end; pointer jumping
    makes them few.
    """
    spark = edges.sparkSession
    pairs = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    both = table(pairs.unionAll(pairs.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "edges")
    labels = table(both.groupBy(F.col("x").alias("id")).agg(F.min("y").alias("m")).select("id", F.least("id", "m").alias("component"), F.lit(True).alias("changed")), "labels")
    while True:
        near = both.join(labels, both.y == labels.id).groupBy(F.col("x").alias("nid")).agg(F.min("component").alias("m"))
        lower = labels.join(near, F.col("id") == F.col("nid"), "left").select("id", F.col("component").alias("old"), F.least("component", F.coalesce("m", "component")).alias("label"))
        roots = labels.select(F.col("id").alias("rid"), F.col("component").alias("root"))
        jumped = lower.join(roots, F.col("label") == F.col("rid"), "left").select("id", F.least("label", F.coalesce("root", "label")).alias("component"), "old")
        new = table(jumped.select("id", "component", (F.col("component") != F.col("old")).alias("changed")), "labels")
        drop_table(labels)
        labels = new
        if labels.where("changed").limit(1).count() == 0:
            drop_table(both)
            return labels.select("id", "component")
