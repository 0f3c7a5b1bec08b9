"""Language-model scoring: an n-gram trie of Elias-Fano sequences, in files that workers map.

Model: interpolated absolute discounting. A word of count c after a context of
count C, which N different words follow, has the probability
max(c - D, 0) / C + D * N / C * (its probability after the context without its
first word); the shortest context gives (c + 1) / (tokens + distinct + 1), so
the probabilities after each context add up to one.

A level of the trie holds the n-grams of one length, in the order of (place of
the first n - 1 words in the level before, last word), cut into pieces of that
order. A piece is one file:

* ``ptr``: for each context where its words begin (never falls);
* ``gram``: the words' numbers, each added to the last one of the context before,
  so that they never fall; a word is found as the successor of the number
  relative to its context's base;
* ``sum``: counts, as sums that never fall;
* ``prob``, ``back``: the discounted part and the share that is passed on, as
  one byte each, with the means of the bytes' ranges.

The first level holds the words themselves, by 64-bit fingerprint, with exact
counts; a word's place there is its number.

Plan, for each level: one scan of the documents looks up what the levels before
have and tells each block's distinct n-grams with counts, delta-coded, by piece
(so a frequent context spreads over as many pieces as it fills); a task for each
piece merges them and writes its file into the shared folder. Nothing of the
model passes through the driver but a line for each piece. Scoring is one more
scan; a worker maps the files, and of these only pages that its texts ask for
are in memory.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm import common, eliasfano
from foliospark.llm.common import U64, column
from foliospark.llm.eliasfano import Monotone

#: Words of the longest n-grams.
ORDER = 2
#: Taken from each count and passed on to the shorter context.
DISCOUNT = 0.75
#: Tokens of a piece of a level, about; a small corpus is cut finer, for as many tasks as there are partitions.
PIECE, FINE = 3_000_000, 100_000
#: Bytes of text that a task looks at in one go.
BLOCK = 8 << 20
#: What ends a text is a token; what begins it is a context only. Neither is a word.
END, BEGIN = (U64(xxhash.xxh64_intdigest(x)) for x in ("\n", " "))


# ------------------------------------------------------------------- the model
@dataclass(frozen=True)
class Piece:
    """One file of a level. ``base``: the place of its first n-gram; ``first``, ``last``: its outermost contexts."""

    uri: str
    n: int
    total: int
    base: int
    first: int
    last: int


@dataclass
class Level:
    """Pieces by the keys that they begin at (None where a range is empty), and what crosses their borders."""

    bounds: np.ndarray
    pieces: list[Piece | None]
    shared: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # outermost contexts of pieces
    shared_back: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @property
    def n(self) -> int:
        return sum(p.n for p in self.pieces if p)

    @property
    def total(self) -> int:
        return sum(p.total for p in self.pieces if p)

    def by_piece(self, keys: np.ndarray) -> Iterator[tuple[Piece, slice]]:
        """Pieces with the stretch of the sorted ``keys`` that each holds."""
        ends = np.searchsorted(keys, self.bounds[1:]).tolist() + [len(keys)]
        start = 0
        for piece, end in zip(self.pieces, ends, strict=True):
            if piece and end > start:
                yield piece, slice(start, end)
            start = max(start, end)

    def counts(self, places: np.ndarray) -> np.ndarray:
        """Counts of the n-grams at the sorted ``places``."""
        out = np.zeros(len(places), np.int64)
        for piece in self.pieces:
            if piece:
                a, b = np.searchsorted(places, [piece.base, piece.base + piece.n])
                if a < b:
                    sums = Monotone(eliasfano.split(eliasfano.opened(piece.uri), "sum"))
                    at = places[a:b] - piece.base
                    out[a:b] = (sums.take(at + 1) - sums.take(at)).astype(np.int64)
        return out

    def at_share(self, share: float) -> tuple[int, float]:
        """Place of the n-gram at which ``share`` of all tokens is reached, and how far into its tokens that is."""
        want = share * self.total
        for piece in self.pieces:
            if piece:
                if want < piece.total:
                    sums = Monotone(eliasfano.split(eliasfano.opened(piece.uri), "sum"))
                    after, same = sums.successor(np.array([int(want)], U64))
                    i = int(after[0]) if same[0] else int(after[0]) - 1
                    while i + 1 < piece.n and int(sums.take(np.array([i + 1]))[0]) <= want:  # equal sums: n-grams without tokens
                        i += 1
                    low, high = (int(x) for x in sums.take(np.array([i, i + 1])))
                    return piece.base + i, min(1.0, (want - low) / max(1, high - low))
                want -= piece.total
        return self.n, 0.0


@dataclass
class Model:
    """A trained model: levels of pieces in the shared folder. Small enough to go with each task."""

    levels: list[Level]
    documents: int  # learned from

    @property
    def order(self) -> int:
        return len(self.levels)

    @property
    def tokens(self) -> int:
        return self.levels[0].total

    @property
    def distinct(self) -> int:
        return max(0, self.levels[0].n - 1)  # without what begins a text

    @property
    def width(self) -> int:
        """Keys are context * width + number."""
        return self.levels[0].n + 1

    def numbers(self, words: np.ndarray) -> np.ndarray:
        """Numbers of sorted distinct fingerprints; -1 for unknown words."""
        out = np.full(len(words), -1, np.int64)
        for piece, own in self.levels[0].by_piece(words):
            grams = Monotone(eliasfano.split(eliasfano.opened(piece.uri), "gram"))
            at, same = grams.successor(words[own])
            out[own] = np.where(same, at + piece.base, -1)
        return out

    def find(self, level: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in a level (from 1) of sorted distinct keys, -1 where there is none, and their discounted probabilities."""
        out, prob = np.full(len(keys), -1, np.int64), np.zeros(len(keys))
        for piece, own in self.levels[level].by_piece(keys):
            arrays = eliasfano.opened(piece.uri)
            ptr, grams = (Monotone(eliasfano.split(arrays, c)) for c in ("ptr", "gram"))
            context, number = np.divmod(keys[own], U64(self.width))
            some = np.flatnonzero((context >= U64(piece.first)) & (context <= U64(piece.last)))
            known, which = np.unique(context[some].astype(np.int64) - piece.first, return_inverse=True)
            start, end = ptr.take(known).astype(np.int64), ptr.take(known + 1).astype(np.int64)
            base = np.where(start > 0, grams.take(np.maximum(start - 1, 0)), U64(0))
            at, same = grams.successor(base[which] + number[some] + U64(1))
            same &= (at >= start[which]) & (at < end[which])
            hit = some[same] + own.start
            out[hit] = at[same] + piece.base
            prob[hit] = arrays["prob.means"][arrays["prob.codes"][at[same]]]
        return out, prob

    def back(self, level: int, contexts: np.ndarray) -> np.ndarray:
        """The share that each of the sorted ``contexts`` passes on; 1 where nothing is known to follow."""
        here, out = self.levels[level], np.ones(len(contexts))
        for piece in here.pieces:
            if piece:
                a, b = np.searchsorted(contexts, [piece.first, piece.last + 1])
                if a < b:
                    arrays = eliasfano.opened(piece.uri)
                    out[a:b] = arrays["back.means"][arrays["back.codes"][contexts[a:b] - piece.first]]
        if len(here.shared):
            at = np.minimum(np.searchsorted(here.shared, contexts), len(here.shared) - 1)
            out = np.where(here.shared[at] == contexts, here.shared_back[at], out)
        return out

    def begin(self) -> int:
        return int(self.numbers(np.array([BEGIN]))[0])


def _quantised(values: np.ndarray) -> dict[str, np.ndarray]:
    """One byte for each value, of 256 ranges of equal ratio, and the mean of each range."""
    logs = np.log(np.maximum(values, 1e-30))
    low, high = (float(logs.min()), float(logs.max())) if len(logs) else (0.0, 0.0)
    codes = np.minimum(255, ((logs - low) * (256 / max(high - low, 1e-12)))).astype(np.uint8)
    n = np.bincount(codes, minlength=256)
    means = np.bincount(codes, values, 256) / np.maximum(n, 1)
    return {"codes": codes, "means": means}


# ---------------------------------------------------------------------- blocks
@dataclass
class Block:
    """Tokens of some documents, each with its end, as places among the distinct fingerprints."""

    rows: list[pa.RecordBatch]
    offsets: np.ndarray
    words: np.ndarray  # distinct, sorted
    which: np.ndarray  # of each token

    @property
    def first(self) -> np.ndarray:
        """Whether a token is the first of its document."""
        out = np.zeros(len(self.which), bool)
        out[self.offsets[:-1]] = True
        return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    rows: list[pa.RecordBatch] = []
    sizes: list[np.ndarray] = []
    hashes: list[np.ndarray] = []
    held = 0

    def block() -> Block:
        n = np.concatenate(sizes) + 1
        offsets = np.concatenate([[0], np.cumsum(n)])
        tokens = np.full(int(offsets[-1]), END, U64)
        inside = np.ones(len(tokens), bool)
        inside[offsets[1:] - 1] = False
        tokens[inside] = np.concatenate(hashes)
        words, which = np.unique(tokens, return_inverse=True)
        return Block(rows, offsets, words, which)

    for batch in common.slices(batches, "text"):
        offsets, found = common.word_hashes(column(batch, "text"))
        rows.append(batch.drop_columns(["text"]))
        sizes.append(np.diff(offsets))
        hashes.append(found)
        held += column(batch, "text").nbytes
        if held >= BLOCK:
            yield block()
            rows, sizes, hashes, held = [], [], [], 0
    if rows:
        yield block()


def _contexts(model: Model, block: Block, numbers: np.ndarray, level: int, places: np.ndarray | None) -> np.ndarray:
    """Of each token the place of the ``level`` words before it in the level of that length; -1 where it is not known."""
    before = numbers if places is None else places
    out = np.full(len(before), -1, np.int64)
    out[1:] = before[:-1]
    out[block.offsets[:-1]] = model.begin() if level == 1 else -1
    return out


def _keys(model: Model, contexts: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens whose context and word are known, their distinct keys and which of these each has."""
    known = np.flatnonzero((contexts >= 0) & (numbers >= 0))
    keys, which = np.unique(contexts[known].astype(U64) * U64(model.width) + numbers[known].astype(U64), return_inverse=True)
    return known, keys, which


# -------------------------------------------------------------------- counting
def _packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys as differences, byte by byte of their places, with counts, compressed."""
    steps = np.diff(keys, prepend=U64(0))
    planes = steps.view(np.uint8).reshape(-1, 8).T
    raw = np.ascontiguousarray(planes).tobytes() + np.ascontiguousarray(counts.astype(np.uint32).view(np.uint8).reshape(-1, 4).T).tobytes()
    return len(keys).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(blob[:8], "little")
    raw = np.frombuffer(pa.Codec("zstd").decompress(blob[8:], decompressed_size=12 * n, asbytes=True), np.uint8)
    steps = np.ascontiguousarray(raw[: 8 * n].reshape(8, n).T).view(U64).ravel()
    counts = np.ascontiguousarray(raw[8 * n :].reshape(4, n).T).view(np.uint32).ravel()
    return np.cumsum(steps, dtype=U64), counts.astype(np.int64)


def _told(model: Model, bounds: np.ndarray, dealt: list[int]):
    """Distinct n-grams of a block with their counts, by piece of the level after those of ``model``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            if not model.order:
                keys = np.append(block.words, BEGIN)
                counts = np.append(np.bincount(block.which, minlength=len(block.words)), 0)
                order = np.argsort(keys)
                keys, counts = keys[order], counts[order]
            else:
                numbers, places = model.numbers(block.words)[block.which], None
                for level in range(1, model.order + 1):
                    contexts = _contexts(model, block, numbers, level, places)
                    known, keys, which = _keys(model, contexts, numbers)
                    if level < model.order:
                        places = np.full(len(numbers), -1, np.int64)
                        places[known] = model.find(level, keys)[0][which]
                counts = np.bincount(which, minlength=len(keys))
            ends = np.searchsorted(keys, bounds[1:]).tolist() + [len(keys)]
            starts = [0, *ends[:-1]]
            full = [i for i, (a, b) in enumerate(zip(starts, ends, strict=True)) if a < b]
            yield pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int32()), pa.array([dealt[i] for i in full], pa.int64()), pa.array([_packed(keys[starts[i] : ends[i]], counts[starts[i] : ends[i]]) for i in full], pa.binary())],
                names=["piece", "task", "grams"],
            )

    return run


_WRITTEN = "piece int, uri string, n long, total long, first long, last long, first_n long, last_n long"


def _merged(model: Model, folder: str):
    """Writes the pieces that a task has got all of; a row for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            for piece, blob in zip(column(batch, "piece").to_pylist(), column(batch, "grams"), strict=True):
                parts.setdefault(piece, []).append(_unpacked(blob.as_py()))
        for piece in sorted(parts):
            found = parts.pop(piece)
            keys, counts = np.concatenate([k for k, _ in found]), np.concatenate([c for _, c in found])
            del found
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order]
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            keys, counts = keys[starts], np.add.reduceat(counts, starts)
            sums = np.concatenate([[0], np.cumsum(counts)])
            arrays = eliasfano.named("sum", eliasfano.encode(sums))
            first = last = first_n = last_n = 0
            if not model.order:
                arrays |= eliasfano.named("gram", eliasfano.encode(keys))
            else:
                context, number = np.divmod(keys, U64(model.width))
                context = context.astype(np.int64)
                first, last = int(context[0]), int(context[-1])
                each = np.bincount(context - first, minlength=last - first + 1)
                first_n, last_n = int(each[0]), int(each[-1])
                begins = np.concatenate([[0], np.cumsum(each)])
                some = np.flatnonzero(each)
                tops = number[begins[some + 1] - 1] + U64(1)
                base = np.concatenate([[0], np.cumsum(tops)[:-1]]).astype(U64)
                size = _context_counts(model, some + first)
                arrays |= eliasfano.named("ptr", eliasfano.encode(begins)) | eliasfano.named("gram", eliasfano.encode(np.repeat(base, each[some]) + number + U64(1)))
                arrays |= eliasfano.named("prob", _quantised((counts - DISCOUNT) / np.repeat(size, each[some])))
                back = np.ones(len(each))
                back[some] = DISCOUNT * each[some] / size
                arrays |= eliasfano.named("back", _quantised(back))
            uri = f"{folder}/{model.order + 1}-{piece}-{uuid.uuid4().hex}"
            eliasfano.save(uri, arrays)
            values = [piece, uri, len(keys), int(sums[-1]), first, last, first_n, last_n]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, [pa.int32(), pa.string(), *[pa.int64()] * 6], strict=True)], names=[c.split()[0] for c in _WRITTEN.split(", ")])
        common.give_back()

    return run


def _context_counts(model: Model, contexts: np.ndarray) -> np.ndarray:
    """Tokens that follow each of the sorted ``contexts``."""
    size = model.levels[-1].counts(contexts)
    if model.order == 1:
        size[contexts == model.begin()] = model.documents
    return np.maximum(size, 1)


def _dealt(spark: SparkSession, n: int) -> list[int]:
    """A number for each of ``n`` tasks that hash partitioning into ``n`` brings there."""
    rows = spark.range(40 * n + 200).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("task")).agg(F.min("id").alias("id")).collect()  # n rows
    at = {r["task"]: r["id"] for r in rows}
    return [at.get(i, i) for i in range(n)]


def _level(docs: DataFrame, model: Model, bounds: np.ndarray, folder: str) -> Level:
    spark, n = docs.sparkSession, len(bounds)
    told = docs.select("text").mapInArrow(_told(model, bounds, _dealt(spark, n)), "piece int, task long, grams binary")
    rows = {r.piece: r for r in told.repartition(n, "task").mapInArrow(_merged(model, folder), _WRITTEN).collect()}  # a row for each piece
    pieces: list[Piece | None] = []
    base = 0
    followers: dict[int, int] = {}
    for i in range(n):
        r = rows.get(i)
        pieces.append(Piece(r.uri, r.n, r.total, base, r.first, r.last) if r else None)
        if r:
            base += r.n
            followers[r.first] = followers.get(r.first, 0) + r.first_n
            if r.last != r.first:
                followers[r.last] = followers.get(r.last, 0) + r.last_n
    if not model.order:
        return Level(bounds, pieces)
    shared = np.array(sorted(followers), np.int64)
    share = DISCOUNT * np.array([followers[c] for c in shared.tolist()], float) / _context_counts(model, shared)
    return Level(bounds, pieces, shared, share)


def train(docs: DataFrame, order: int = ORDER, piece: int = PIECE) -> Model:
    """A model of the ``text`` of all rows of ``docs``; null and empty texts are an end only. Its files stay until the process ends."""
    spark = docs.sparkSession
    common.lean(spark)
    folder = f"{common.shared_dir(spark)}/foliospark/ngrams-{uuid.uuid4().hex}"
    common.left(folder, spark)
    model, n = Model([], 0), common.partitions(spark)
    bounds = np.array([(i << 64) // n for i in range(n)], U64)
    while model.order < order:
        level = _level(docs, model, bounds, folder)
        if not model.order:
            model.documents = int(_count_of_end(level))
        model.levels.append(level)
        n = max(1, min(common.partitions(spark), model.tokens // FINE), -(-model.tokens // piece))
        if (level.n + 1) * model.width >= 1 << 64:
            raise ValueError("keys of the next level are too large for 64 bits")
        cuts = [level.at_share(i / n) for i in range(n)]
        bounds = np.array([0, *(place * model.width + int(share * model.width) for place, share in cuts[1:])], U64)
    return model


def _count_of_end(level: Level) -> int:
    for piece, _ in level.by_piece(np.array([END])):
        at, same = Monotone(eliasfano.split(eliasfano.opened(piece.uri), "gram")).successor(np.array([END]))
        return int(level.counts(at + piece.base)[0]) if same[0] else 0
    return 0


# --------------------------------------------------------------------- scoring
def _scored(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass = model.tokens + model.distinct + 1
        for block in _blocks(batches):
            of_words = model.numbers(block.words)
            counts = np.zeros(len(of_words), np.int64)
            known = np.flatnonzero(of_words >= 0)
            counts[known] = model.levels[0].counts(of_words[known]) if len(known) else 0
            numbers, p, places = of_words[block.which], ((counts + 1) / mass)[block.which], None
            starts = block.offsets[:-1]
            base = np.add.reduceat(np.log10((counts + 1) / mass)[block.which], starts)
            n_known = np.add.reduceat((counts > 0)[block.which].astype(np.int64), starts)
            for level in range(1, model.order):
                contexts = _contexts(model, block, numbers, level, places)
                after, of = np.unique(contexts, return_inverse=True)
                p = p * np.where(after >= 0, model.back(level, after), 1.0)[of]
                at, keys, which = _keys(model, contexts, numbers)
                found, prob = model.find(level, keys)
                p[at] += prob[which]
                places = np.full(len(numbers), -1, np.int64)
                places[at] = found[which]
            score = np.add.reduceat(np.log10(np.minimum(p, 1.0)), starts)
            rows = pa.Table.from_batches(block.rows).combine_chunks().to_batches()[0]
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(np.diff(block.offsets)), pa.array(n_known), pa.array(np.full(len(starts), model.tokens)), pa.array(base), pa.array(score)],
                names=[*rows.schema.names, "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return run


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` of each row of ``docs`` with n_tokens, n_known, train_tokens, base_score and score of its text."""
    common.lean(docs.sparkSession)
    rows = docs.select(*keep, "text")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text")
    return rows.mapInArrow(_scored(model), f"{kinds}, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def held_out(doc_id: Column) -> Column:
    """Whether the crc32 of a doc_id's digits leaves 2 when divided by 7; a null doc_id is none."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


def scores(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs``.

    The model learns from all rows that are not held out, a row as often as it
    stands there. Words are runs of characters other than space and \\x09-\\x0D
    with A-Z lower-cased, and one end follows them; null and empty texts are an
    end only. ``base_score`` sums log10((c + 1) / (N + V + 1)) over the tokens
    with exact counts; ``score`` sums the model's log10 probabilities, which are
    quantised. A row with a null doc_id is learned from. Texts of any length
    are taken whole. An empty table, or one of held-out rows alone, is scored by
    counts of nothing. Only ``doc_id`` and ``text`` are read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = train(rows.where(~held_out(F.col("doc_id"))), order)
    return score(rows.withColumn("held_out", held_out(F.col("doc_id"))), model, ("doc_id", "held_out"))
