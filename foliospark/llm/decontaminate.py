"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are token sequences (words, case-folded, without
punctuation at their ends). A document and an item that share a seed of
``SEED`` tokens are tiled: the longest common runs of unmarked tokens are
marked first, ties by place in the item and then in the document, until no
common run of ``SEED`` tokens is left. Candidates are found by running
Karp-Rabin: the fingerprint of each window follows from the one before it by
the token that leaves and the one that comes, and equal fingerprints are
verified token by token and extended. The share of an item's tokens that tiles
cover does not depend on their order, so reordered passages count too.

Tiles are runs of ``SEED`` tokens or more, each of whose tokens is in a shared
seed; a pair whose shared seeds are too few for ``percent`` is not tiled.

The benchmark's index is broadcast where its size is proven small
(``MOST_TOKENS``); a larger benchmark is met by a shuffled join on seeds, which
leads to the same candidates, the same tiling and the same rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm import common
from foliospark.llm.common import U64

SEED = 5
PERCENT = 80
MOST_TOKENS = 2_000_000


def plain(word: str) -> str:
    """A word as it is compared: case-folded, without other than letters and digits at its ends."""
    a, b = 0, len(word)
    while a < b and not word[a].isalnum():
        a += 1
    while b > a and not word[b - 1].isalnum():
        b -= 1
    return word[a:b].casefold()


#: Of the rolling fingerprint: an odd base, so that it has an inverse among 64-bit numbers.
BASE = 0x9E3779B97F4A7C15
_BACK = pow(BASE, -1, 2**64)


def rolled(tokens: np.ndarray, n: int) -> np.ndarray:
    """The Karp-Rabin fingerprint of each window of ``n`` tokens.

    Tokens are weighed by rising powers of the base and summed from the left;
    the sum of a window is the difference of two such sums, which a power of the
    inverse shifts back to the window's beginning.
    """
    if not 0 < n <= len(tokens):
        return np.zeros(0, U64)
    power, back = np.full(len(tokens), BASE, U64), np.full(len(tokens) - n + 1, _BACK, U64)
    power[0] = back[0] = 1
    total = np.concatenate([np.zeros(1, U64), np.cumsum(tokens * np.cumprod(power), dtype=U64)])
    return common.mix((total[n:] - total[:-n]) * np.cumprod(back) + U64(n))


def tiles(item: np.ndarray, doc: np.ndarray, least: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy tiling of two token sequences: (place in item, place in doc, length), longest first."""
    least = min(least, len(item))
    if not least or len(doc) < least:
        return []
    print_item, print_doc = rolled(item, least), rolled(doc, least)
    where = defaultdict(list)
    for i, h in enumerate(print_item.tolist()):
        where[h].append(i)
    hits = np.flatnonzero(np.isin(print_doc, print_item))
    used_item, used_doc = np.zeros(len(item), bool), np.zeros(len(doc), bool)

    def run(i: int, j: int) -> int:
        """Tokens that agree and are unmarked from (i, j) on."""
        n = min(len(item) - i, len(doc) - j)
        bad = (item[i : i + n] != doc[j : j + n]) | used_item[i : i + n] | used_doc[j : j + n]
        return int(np.argmax(bad)) if bad.any() else n

    heap: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for j in hits.tolist():
        for i in where[int(print_doc[j])]:
            if not (i and j and item[i - 1] == doc[j - 1]) and (n := run(i, j)) >= least:
                heap[n].append((i, j))
    out = []
    while heap:
        length = max(heap)
        again = sorted(heap.pop(length))
        for i, j in again:
            start = 0
            while start + least <= length:  # a run that marks have cut leaves shorter ones
                n = min(run(i + start, j + start), length - start)
                if n == length:
                    used_item[i : i + n] = used_doc[j : j + n] = True
                    out.append((i, j, n))
                    break
                if n >= least:
                    heap[n].append((i + start, j + start))
                start += max(n, 1)
    return out


def _sequences(texts: pa.Array) -> list[np.ndarray]:
    offsets, words = common.word_hashes(texts, lower=False, clean=plain)
    return [words[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _seeds(tokens: np.ndarray) -> np.ndarray:
    """The seed at each place of an item; an item shorter than a seed is one as a whole."""
    return rolled(tokens, min(SEED, len(tokens)))


def _enough(shared: np.ndarray, tokens: np.ndarray, percent: int) -> np.ndarray:
    """Whether so many seed places of an item that are shared can cover ``percent`` of its tokens."""
    return 100 * shared * np.minimum(SEED, tokens) >= percent * tokens


_COLUMNS = "doc_id long, item_id long, item_tokens int, covered_tokens int, tiles int, longest int, coverage double"
_NAMES = [x.split()[0] for x in _COLUMNS.split(", ")]


def _row(doc_id: int, item_id: int, item: np.ndarray, doc: np.ndarray, percent: int) -> tuple | None:
    found = tiles(item, doc)
    covered = sum(n for _, _, n in found)
    if not covered or 100 * covered < percent * len(item):
        return None
    return doc_id, item_id, len(item), covered, len(found), found[0][2], covered / len(item)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds)], names=_NAMES)


class Index:
    """Items by seed, in sorted arrays: 24 bytes for a token at most."""

    def __init__(self, ids: list[int], items: list[np.ndarray]):
        self.ids, self.sizes = np.array(ids, np.int64), np.array([len(t) for t in items], np.int64)
        self.ends = np.concatenate([[0], np.cumsum(self.sizes)])
        self.tokens = np.concatenate([np.zeros(0, U64), *items])
        places = [_seeds(t) for t in items]
        seeds, of = np.concatenate([np.zeros(0, U64), *places]), np.repeat(np.arange(len(items), dtype=np.int32), [len(x) for x in places])
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.of = seeds[order], of[order]
        self.lengths = np.unique(np.minimum(SEED, self.sizes))

    def item(self, k: int) -> np.ndarray:
        return self.tokens[self.ends[k] : self.ends[k + 1]]

    def candidates(self, offsets: np.ndarray, words: np.ndarray, percent: int) -> np.ndarray:
        """(document, item) pairs, sorted, that share enough seeds; documents are cut by ``offsets``."""
        docs, hits = [], []
        for size in self.lengths.tolist():
            grams = rolled(words, size)
            at = np.flatnonzero(np.isin(grams, self.seeds))
            doc = np.searchsorted(offsets, at, side="right") - 1
            inside = at + size <= offsets[doc + 1]
            docs.append(doc[inside])
            hits.append(grams[at[inside]])
        if not docs:
            return np.zeros((0, 2), np.int64)
        doc, gram = (np.concatenate(x) for x in (docs, hits))
        order = np.lexsort((gram, doc))
        doc, gram = doc[order], gram[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (gram[1:] != gram[:-1])
        doc, gram = doc[new], gram[new]
        low, high = np.searchsorted(self.seeds, gram, side="left"), np.searchsorted(self.seeds, gram, side="right")
        n = high - low
        item = self.of[np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())]
        pair, shared = np.unique(np.repeat(doc, n) * np.int64(len(self.ids)) + item, return_counts=True)
        pairs = np.stack([pair // max(1, len(self.ids)), pair % max(1, len(self.ids))], axis=1)
        return pairs[_enough(shared, self.sizes[pairs[:, 1]], percent)]


def _tile_all(shared, percent: int):
    """The scan with a broadcast :class:`Index`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        for batch in common.slices(batches, "text"):
            offsets, words = common.word_hashes(common.column(batch, "text"), lower=False, clean=plain)
            ids = common.column(batch, "doc_id")
            pairs = index.candidates(offsets, words, percent).tolist()
            rows = [r for d, k in pairs if (r := _row(ids[d].as_py(), int(index.ids[k]), index.item(k), words[offsets[d] : offsets[d + 1]], percent))]
            if rows:
                yield _batch(rows)

    return run


def _seed_rows(lengths: list[int] | None = None):
    """(id, text_hash, tokens, seed, places) of each item, or of each document with its seeds of ``lengths``, once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            for own, text, tokens in zip(common.column(batch, "id").to_pylist(), common.column(batch, "text_hash").to_pylist(), _sequences(common.column(batch, "text")), strict=True):
                if lengths is not None:
                    seeds = np.unique(np.concatenate([np.zeros(0, U64), *(rolled(tokens, n) for n in lengths)]))
                    places = np.ones(len(seeds), np.int64)
                elif len(tokens):
                    seeds, places = np.unique(_seeds(tokens), return_counts=True)
                else:
                    continue
                if len(seeds):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(seeds), x, np.int64)) for x in (own, text, len(tokens))] + [pa.array(seeds.view(np.int64)), pa.array(places)], names=["id", "text_hash", "tokens", "seed", "places"])

    return run


_SEEDS = "id long, text_hash long, tokens long, seed long, places long"


def _tile_pairs(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text", 1 << 20):
            docs, items = _sequences(common.column(batch, "text")), _sequences(common.column(batch, "item_text"))
            pairs = zip(common.column(batch, "doc_id").to_pylist(), common.column(batch, "item_id").to_pylist(), items, docs, strict=True)
            rows = [r for d, k, item, doc in pairs if (r := _row(d, k, item, doc, percent))]
            if rows:
                yield _batch(rows)

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT, most_tokens: int = MOST_TOKENS) -> DataFrame:
    """Pairs of a document and a benchmark item of whose tokens tiles cover ``percent`` or more.

    Rows: doc_id, item_id, item_tokens, covered_tokens, tiles, longest (tile),
    coverage. Null, empty and wordless texts and items make no pairs; an item
    shorter than a seed is a seed as a whole. A null doc_id or item_id is left
    out. Rows that repeat a doc_id or an item_id with other texts are tiled
    each for itself, and of a pair of ids the best covered of its texts tells
    (then the one with more tokens, a longer tile, fewer tiles), whatever their
    order. Only ``doc_id``, ``item_id`` and ``text`` are read. Words are
    compared by 64-bit fingerprints.
    """
    spark = docs.sparkSession
    common.lean(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null").distinct()
    size = items.agg(F.coalesce(F.sum(F.length("text") / 2 + 1), F.lit(0)).alias("n")).first()["n"]
    if size <= most_tokens:
        held = [(r["item_id"], r["text"]) for r in items.orderBy("item_id", "text").collect()]  # of proven size: at most most_tokens words
        known = [(i, t) for (i, _), t in zip(held, _sequences(pa.array([t for _, t in held], pa.string())), strict=True) if len(t)]
        found = docs.mapInArrow(_tile_all(spark.sparkContext.broadcast(Index([i for i, _ in known], [t for _, t in known])), percent), _COLUMNS)
    else:
        items = common.table(items.withColumn("item_hash", F.xxhash64("text")), "items")
        keyed = docs.withColumn("text_hash", F.xxhash64("text"))
        item_seeds = items.select(F.col("item_id").alias("id"), F.col("item_hash").alias("text_hash"), "text").mapInArrow(_seed_rows(), _SEEDS).toDF("item_id", "item_hash", "tokens", "seed", "places")
        item_seeds = common.table(item_seeds, "item-seeds")
        lengths = [r["n"] for r in item_seeds.select(F.least(F.lit(SEED), F.col("tokens")).alias("n")).distinct().collect()]  # SEED at most
        doc_seeds = keyed.select(F.col("doc_id").alias("id"), "text_hash", "text").mapInArrow(_seed_rows(lengths), _SEEDS).select(F.col("id").alias("doc_id"), "text_hash", "seed").distinct()
        pairs = doc_seeds.join(item_seeds, "seed").groupBy("doc_id", "text_hash", "item_id", "item_hash").agg(F.sum("places").alias("shared"), F.first("tokens").alias("tokens"))
        pairs = common.table(pairs.where(F.lit(100) * F.col("shared") * F.least(F.lit(SEED), F.col("tokens")) >= F.lit(percent) * F.col("tokens")).drop("shared", "tokens"), "pairs")
        texts = keyed.join(pairs, ["doc_id", "text_hash"]).join(items.withColumnRenamed("text", "item_text"), ["item_id", "item_hash"])
        found = texts.select("doc_id", "item_id", "text", "item_text").mapInArrow(_tile_pairs(percent), _COLUMNS)
    best = F.max(F.struct("coverage", "item_tokens", "longest", (-F.col("tiles")).alias("fewer"), "covered_tokens"))
    found = found.groupBy("doc_id", "item_id").agg(best.alias("b"))
    return found.select("doc_id", "item_id", "b.item_tokens", "b.covered_tokens", (-F.col("b.fewer")).alias("tiles"), "b.longest", "b.coverage")


def without_leaks(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item."""
    return common.restrict(docs, leaks(docs, benchmark, percent), "doc_id", "doc_id", "left_anti")
