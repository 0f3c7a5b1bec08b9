"""Passages that repeat across documents: a sparse suffix array over minimiser positions.

A suffix is retained where its first ``GRAM`` words hash lowest among
``window`` neighbouring positions, so equal passages retain the same suffixes:
each run of ``least`` words has one position of its own, within its first
``window``, from which ``least - window + 1`` words (the reach) are inside it.

Plan
----
1. Sort. Retained suffixes are ordered block by block, a block of ``GRAM`` words
   being one letter of the alphabet (in the order of the letters'
   fingerprints), for ``BLOCKS`` letters. Range partitions are consecutive
   pieces of the suffix array; suffixes with the same beginning, however many,
   are spread over several by document and position.
2. Compare neighbours. The common prefix of each suffix with the one before it
   and the one after it is counted. Where neither has all letters, the suffix is
   in no repeated passage. The first and the last of a partition stay.
3. Extend. The others are sorted again, down to the last word that a passage
   with them can have, each with its words to the left. Common prefixes of
   neighbours, counted in words, make the intervals of the array: for each d,
   suffixes in one interval of ``least - d`` words whose d words to the left are
   the same too (told word by word, from the suffix outwards) match over
   ``least`` words. Places where another document's do are joined to passages.

An interval is settled where it lies, in one piece of the array, unless it
crosses the border of a piece or is larger than ``PIECE``. Then a piece tells
each passage of ``least`` words by its fingerprint and the smallest document that
has it there, and these few rows are aggregated over all pieces. Its other
documents are known to come later; each stretch of their places is one row, and
stretches of the same passages are looked up once. Equal texts are held once, by
their smallest doc_id.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm import common
from foliospark.llm.common import U64

LEAST = 50
WINDOW = 19
GRAM, BLOCKS = 8, 4
#: Words that the letters of a suffix stand for.
HEAD = GRAM * BLOCKS
#: Suffixes of the array that are held at once.
PIECE = 20_000
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def chosen(grams: np.ndarray, window: int) -> np.ndarray:
    """For each ``window`` consecutive ``grams`` the position of the lowest (the rightmost of equals). It never falls."""
    n = max(0, len(grams) - window + 1)
    order = np.arange(len(grams))
    best, at = grams[:n].copy(), order[:n].copy()
    for j in range(1, window):
        lower = grams[j : j + n] <= best
        best[lower] = grams[j : j + n][lower]
        at[lower] = order[j : j + n][lower]
    return at


def letters(grams: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first four blocks of the suffixes at ``at``, 32 bits of each, two to a number. ``grams`` are blocks from every position."""
    block = [(grams[at + i * GRAM] if len(at) else grams[:0]) >> U64(32) for i in range(BLOCKS)]
    return (block[0] << U64(32) | block[1]).view(np.int64), (block[2] << U64(32) | block[3]).view(np.int64)


def common_letters(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Letters that suffixes have in common at their beginnings."""
    (a, b), (c, d) = one, other
    first = np.where(a == c, 2, (a >> 32 == c >> 32).astype(np.int64))
    second = np.where(b == d, 2, (b >> 32 == d >> 32).astype(np.int64))
    return first + np.where(first == 2, second, 0)


def _retained(least: int, window: int):
    reach = least - window + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            offsets, words = common.word_hashes(common.column(batch, "text"), lower=False)
            grams = common.gram_hashes(words, GRAM)
            at = [np.unique(chosen(grams[a : b - reach + 1], window)) if b - a >= least else np.zeros(0, np.int64) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in at])]).astype(np.int32)
            place = np.concatenate([x + a for x, a in zip(at, offsets[:-1], strict=True)])
            values = [*letters(grams, place), np.concatenate(at).astype(np.int32)]
            yield pa.RecordBatch.from_arrays(
                [common.column(batch, c) for c in ("doc_id", "text_hash", "digest")] + [pa.array(np.diff(offsets).astype(np.int32)), *(pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in values)],
                names=["doc_id", "text_hash", "digest", "n_words", "high", "low", "pos"],
            )

    return run


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a piece of the suffix array, the suffixes that share all letters with a neighbour, and the first and the last."""
    held = None  # the row not told yet, and whether it stays
    for batch in batches:
        if not batch.num_rows:
            continue
        piece = pa.Table.from_batches([batch])
        keep = np.zeros(batch.num_rows, bool)
        if held is None:
            keep[0] = True
        else:
            piece = pa.concat_tables([held[0], piece])
            keep = np.concatenate([[held[1]], keep])
        high, low = piece["high"].to_numpy(), piece["low"].to_numpy()
        alike = common_letters((high[1:], low[1:]), (high[:-1], low[:-1])) == BLOCKS
        keep[1:] |= alike
        keep[:-1] |= alike
        held = piece.slice(len(keep) - 1), bool(keep[-1])
        yield from piece.slice(0, len(keep) - 1).filter(pa.array(keep[:-1])).select(["doc_id", "pos"]).to_batches()
    if held is not None:
        yield from held[0].select(["doc_id", "pos"]).to_batches()


def _spelled(words: np.ndarray, begin: np.ndarray, size: np.ndarray, step: int) -> pa.Array:
    """For each row ``size`` words from ``begin`` on, or backwards, four bytes of each fingerprint, so that bytes sort as words do."""
    ends = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(begin, size) + step * (np.arange(ends[-1]) - np.repeat(ends[:-1], size))
    data = (words[at] >> U64(32)).astype(">u4").tobytes()
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer((4 * ends).astype(np.int32).tobytes()), pa.py_buffer(data)])


def _surroundings(least: int, window: int):
    """Each suffix that stayed with the words that passages with it can have, beyond its letters and to its left.

    A suffix stands for the passages that retain it, which begin ``d`` words
    before it for consecutive d; the words left of it are as many as the
    largest d, those to its right as the smallest leaves.
    """
    reach = least - window + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text", 1 << 20):
            offsets, words = common.word_hashes(common.column(batch, "text"), lower=False)
            grams = common.gram_hashes(words, GRAM)
            found = common.column(batch, "found").to_pylist()
            rows, places, begins, ends = [], [], [], []
            for row, a, b in zip(range(len(found)), offsets[:-1], offsets[1:], strict=True):
                if b - a < least:
                    continue
                at = chosen(grams[a : b - reach + 1], window)
                stays = np.flatnonzero(np.isin(at, np.array(found[row], np.int64)))
                if not len(stays):
                    continue
                first = np.concatenate([[0], np.flatnonzero(np.diff(at[stays])) + 1])
                last = np.append(first[1:], len(stays)) - 1
                rows.append(np.full(len(first), row))
                places.append(a + at[stays[first]])
                begins.append(a + stays[first])
                ends.append(a + stays[last])
            if rows:
                row, place, begin, end = (np.concatenate(x) for x in (rows, places, begins, ends))
                of = pa.array(row)
                high, low = letters(grams, place)
                yield pa.RecordBatch.from_arrays(
                    [
                        common.column(batch, "doc_id").take(of),
                        common.column(batch, "text_hash").take(of),
                        pa.array((place - offsets[row]).astype(np.int32)),
                        pa.array(high),
                        pa.array(low),
                        _spelled(words, place + HEAD, end + least - place - HEAD, 1),
                        _spelled(words, place - 1, place - begin, -1),
                    ],
                    names=["doc_id", "text_hash", "pos", "high", "low", "right", "left"],
                )

    return run


#: Stretches of places where another document has the passage too: settled with its smallest document, or later than that
#: of the same ``stretch``, whose passages (``run``) are told apart; and open ones, of which ``several`` documents of the piece
#: may have one.
_MATCH = "doc_id long, text_hash long, start int, last int, first_doc_id long, run long, several boolean, stretch long"


def _words(column: pa.ChunkedArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The spelled words of each row as a matrix, and their numbers."""
    spelled = column.combine_chunks()
    size = pc.binary_length(spelled).to_numpy().astype(np.int64) // 4
    out = np.zeros((len(size), max(1, width)), np.uint32)
    flat = np.frombuffer(b"".join(spelled.to_pylist()), ">u4")
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out, size


def common_words(one: np.ndarray, other: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Words that rows of two matrices have in common at their beginnings, ``most`` at most."""
    same = (one == other) & (np.arange(one.shape[1]) < most[:, None])
    return np.cumprod(same, axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)


def _matched(piece: pa.Table, least: int, window: int) -> tuple[np.ndarray, ...]:
    """(row, place, class, fingerprint) of all passages of a piece of the array; passages of one class are the same words.

    For each d, the class is the interval of the array over ``least - d`` words
    and the class of the d words to the left, which is told anew from that of
    the d - 1 words nearer to the suffix and the next one.
    """
    high, low, pos = (piece[c].to_numpy() for c in ("high", "low", "pos"))
    right, n_right = _words(piece["right"], least - HEAD)
    left, n_left = _words(piece["left"], window - 1)
    n = len(high)
    prefix = np.full(n, -1, np.int64)  # with the suffix before, in words
    whole = common_letters((high[1:], low[1:]), (high[:-1], low[:-1])) == BLOCKS
    prefix[1:] = np.where(whole, HEAD + common_words(right[1:], right[:-1], np.minimum(n_right[1:], n_right[:-1])), 0)
    heads = [common.mix(high.view(U64) * U64(0x9E3779B97F4A7C15) + common.mix(low.view(U64)))]
    for k in range(right.shape[1]):
        heads.append(common.mix(heads[-1] + right[:, k] + U64(1)))
    tail, outwards = np.zeros(n, U64), np.zeros(n, np.int64)
    told = []
    for d in range(window):
        if d:
            word = left[:, d - 1].astype(U64)
            _, outwards = np.unique(outwards.astype(U64) << U64(32) | word, return_inverse=True)
            tail = common.mix(tail * U64(0xD6E8FEB86659FD93) + word + U64(1))
        beyond = least - HEAD - d
        own = np.flatnonzero((n_left >= d) & (n_right >= beyond))
        if beyond < 0 or not len(own):
            continue
        interval = np.cumsum(prefix < least - d)
        _, same = np.unique(interval[own].astype(U64) << U64(32) | outwards[own].astype(U64), return_inverse=True)
        told.append((own, pos[own].astype(np.int64) - d, d * n + same, common.mix(heads[beyond][own] ^ common.mix(tail[own] + U64(d))).view(np.int64)))
    row, place, same, run = (np.concatenate(x) for x in zip(*told, strict=True))
    doc, text = piece["doc_id"].to_numpy()[row], piece["text_hash"].to_numpy()[row]
    order = np.lexsort((place, text, doc))
    return doc[order], text[order], place[order], same[order], run[order]


def _holders(doc: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each passage the smallest document with one of its class, and whether another one has it."""
    order = np.lexsort((doc, run))
    _, first, which = np.unique(run[order], return_index=True, return_inverse=True)
    low, high = doc[order][first], doc[order][np.append(first[1:], len(order)) - 1]
    smallest, several = np.empty(len(run), np.int64), np.empty(len(run), bool)
    smallest[order], several[order] = low[which], (low != high)[which]
    return smallest, several


def _stretches(place: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last entry of each stretch of consecutive places with the same values, over the rows of any suffixes."""
    new = np.ones(len(place), bool)
    new[1:] = place[1:] != place[:-1] + 1
    for values in same:
        new[1:] |= values[1:] != values[:-1]
    begin = np.flatnonzero(new)
    return begin, np.append(begin[1:], len(place))[: len(begin)] - 1


def _settled(piece: pa.Table, least: int, window: int) -> pa.RecordBatch:
    """Matches within whole intervals: places start to last whose passages another document has too, the smallest such one."""
    doc, text, place, same, _ = _matched(piece, least, window)
    smallest, several = _holders(doc, same)
    doc, text, place, smallest = doc[several], text[several], place[several], smallest[several]
    begin, end = _stretches(place, doc, text, smallest)
    return _matches(len(begin), doc_id=doc[begin], text_hash=text[begin], start=place[begin], last=place[end], first_doc_id=smallest[begin])


def _open(piece: pa.Table, least: int, window: int) -> pa.RecordBatch:
    """What a piece has of intervals that go on in others; see :data:`_MATCH`."""
    doc, text, place, same, run = _matched(piece, least, window)
    smallest, several = _holders(doc, same)
    first = doc == smallest
    rows = [_matches(int(first.sum()), doc_id=doc[first], text_hash=text[first], start=place[first], last=place[first], run=run[first], several=several[first])]
    doc, text, place, run = doc[~first], text[~first], place[~first], run[~first]
    begin, end = _stretches(place, doc, text)
    keys = np.array([xxhash.xxh3_64_intdigest(run[a : b + 1].tobytes()) for a, b in zip(begin.tolist(), end.tolist(), strict=True)], U64).view(np.int64)
    rows.append(_matches(len(begin), doc_id=doc[begin], text_hash=text[begin], start=place[begin], last=place[end], stretch=keys))
    distinct, at = np.unique(keys, return_index=True)
    sizes = (end - begin + 1)[at]
    own = np.repeat(begin[at] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    rows.append(_matches(len(own), run=run[own], stretch=np.repeat(distinct, sizes)))
    return pa.Table.from_batches(rows).combine_chunks().to_batches()[0] if sum(x.num_rows for x in rows) else rows[0]


_KINDS = [(x.split()[0], {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}[x.split()[1]]) for x in _MATCH.split(", ")]


def _matches(n: int, **columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in _KINDS], names=[c for c, _ in _KINDS])


def _extend(most: int, least: int, window: int):
    """Matches of a piece of the array, which comes in its order; see :data:`_MATCH`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts, n, border = None, [], 0, True  # border: the interval that ``held`` begins with began before it

        def cut(rows: pa.Table, border: bool, end: bool) -> tuple[list[pa.RecordBatch], pa.Table | None, bool]:
            """What is told now, what is held, and whether that continues an interval that is told as open."""
            high, low = rows["high"].to_numpy(), rows["low"].to_numpy()
            starts = np.flatnonzero(common_letters((high[1:], low[1:]), (high[:-1], low[:-1])) < BLOCKS) + 1
            if not len(starts):  # one interval
                return ([_open(rows, least, window)], None, True) if end or border or len(high) >= most else ([], rows, border)
            out, a, b = [], 0, int(starts[-1])
            if border:
                a = int(starts[0])
                out.append(_open(rows.slice(0, a), least, window))
            if a < b:
                out.append(_settled(rows.slice(a, b - a), least, window))
            if end:
                return [*out, _open(rows.slice(b), least, window)], None, True
            return out, rows.slice(b), False

        for batch in batches:
            if batch.num_rows:
                parts.append(batch)
                n += batch.num_rows
            if n >= most:
                rows = pa.Table.from_batches(parts)
                rows = pa.concat_tables([held, rows]) if held is not None else rows
                told, held, border = cut(rows, border, False)
                yield from told
                parts, n = [], 0
        if parts or held is not None:
            rows = pa.concat_tables(([held] if held is not None else []) + ([pa.Table.from_batches(parts)] if parts else []))
            yield from cut(rows, border, True)[0]
        common.give_back()

    return run


def repeated_spans(docs: DataFrame, least: int = LEAST, window: int = WINDOW, piece: int = PIECE) -> DataFrame:
    """Spans of words that are in ``least``-word passages found in two documents or more.

    Rows: doc_id, start_word, end_word (exclusive), n_words, first_doc_id (the
    smallest document with the passage; of a span with several, the smallest),
    first (the document is the one that holds the passages first, so that they
    can stay here and go elsewhere), text_hash (xxhash64 of the text). Spans
    with ``first`` and without may overlap in one document. Words are runs of
    characters other than space and \\x09-\\x0D, compared exactly. ``least`` is
    ``window`` and four blocks of ``GRAM`` words at least.

    Null, empty and short texts have no spans; a passage that repeats only
    within one document is none. Of rows with the same text each has its whole
    text as a span, if it is long enough. Rows of one doc_id are one document:
    equal ones count once, and of different texts each has its own spans, told
    by ``text_hash``, in whatever order they come. A null doc_id is left out.
    Only ``doc_id`` and ``text`` are read. Blocks and words are compared by
    32-bit fingerprints of each, so that passages are by four of the former and
    ``least - 32`` of the latter; passages across pieces by 64 bits.
    """
    spark = docs.sparkSession
    common.lean(spark)
    n = common.partitions(spark)
    if least - window + 1 < HEAD:
        raise ValueError(f"least must be {HEAD + window - 1} for this window, or more")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").where("doc_id is not null and text is not null")
    digested = docs.select("doc_id", "text_hash", "text", F.unhex(F.md5("text")).alias("digest"))
    made = digested.mapInArrow(_retained(least, window), "doc_id long, text_hash long, digest binary, n_words int, high array<long>, low array<long>, pos array<int>")
    made = common.table(made.where(F.col("n_words") >= least), "suffixes")
    texts = common.table(made.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("high_id")), "texts")
    copies = made.select("doc_id", "text_hash", "digest", "n_words").join(texts.where("rep < high_id"), "digest").select("doc_id", "text_hash", "digest", "n_words", "rep")
    copies = common.table(copies, "copies").distinct()  # apart from the join, so that very many copies are split there

    again = common.table(copies.where("doc_id <> rep").select("doc_id", "digest"), "again")
    again = F.broadcast(again) if again.count() <= common.BROADCAST_IDS else again.hint("merge")  # suffixes are not shuffled for the sake of a few copies
    suffix = made.join(again, ["doc_id", "digest"], "left_anti").select("doc_id", F.explode(F.arrays_zip("high", "low", "pos")).alias("s")).select("s.*", "doc_id")
    order = ("high", "low", "doc_id", "pos")
    array = suffix.repartitionByRange(n, *order).sortWithinPartitions(*order)
    stays = array.mapInArrow(_neighbours, "doc_id long, pos int")
    found = common.table(stays.groupBy("doc_id").agg(F.collect_set("pos").alias("found")), "survivors")  # of several texts of an id, what stays of any

    told = docs.join(found, "doc_id").select("doc_id", "text_hash", "text", "found").mapInArrow(_surroundings(least, window), "doc_id long, text_hash long, pos int, high long, low long, right binary, left binary")
    order = ("high", "low", "right", "doc_id", "pos")
    pieces = told.repartitionByRange(n, *order).sortWithinPartitions(*order)
    matches = common.table(pieces.mapInArrow(_extend(piece, least, window), _MATCH), "matches")
    open_ = matches.where("run is not null and doc_id is not null").select("doc_id", "text_hash", "start", "last", "run", "several")
    shared = open_.groupBy("run").agg(F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last_doc_id"), F.max("several").alias("several")).where("first_doc_id <> last_doc_id or several").select("run", "first_doc_id")
    shared = common.table(shared, "shared")  # apart from the joins, so that what very many documents hold is split there
    stretches = matches.where("run is not null and doc_id is null").select("stretch", "run").distinct().join(shared, "run")
    stretches = common.table(stretches.groupBy("stretch").agg(F.min("first_doc_id").alias("first_doc_id")), "stretches")
    columns = ["doc_id", "text_hash", "start", "last", "first_doc_id"]
    later = matches.where("stretch is not null and doc_id is not null").drop("first_doc_id").join(stretches, "stretch")
    marked = matches.where("first_doc_id is not null").select(*columns).unionByName(open_.join(shared, "run").select(*columns)).unionByName(later.select(*columns))
    marked = marked.withColumn("first", F.col("doc_id") == F.col("first_doc_id"))

    by = Window.partitionBy("doc_id", "text_hash", "first").orderBy("start", "last")
    opens = F.when(F.col("start") > F.lag("last").over(by) + least, 1).otherwise(0)
    spans = marked.withColumn("opens", opens).withColumn("island", F.sum("opens").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    spans = spans.groupBy("doc_id", "text_hash", "first", "island").agg(F.min("start").alias("start_word"), (F.max("last") + least).alias("end_word"), F.min("first_doc_id").alias("first_doc_id"))
    spans = spans.select("doc_id", "start_word", "end_word", "first_doc_id", "first", "text_hash")
    whole = copies.select("doc_id", F.lit(0).alias("start_word"), F.col("n_words").alias("end_word"), F.col("rep").alias("first_doc_id"), (F.col("doc_id") == F.col("rep")).alias("first"), "text_hash")
    out = spans.unionByName(whole)
    return out.select("doc_id", "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"), "first_doc_id", "first", "text_hash")


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of ``spans`` and the white space after them."""
    at = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    out, done = [], 0
    for start, end in sorted(spans):
        start = max(start, done)
        if start < end:
            out.append(text[at[done] if done else 0 : at[start]])
            done = min(end, len(at) - 1)
    out.append(text[at[done] if done else 0 :])
    return "".join(out)


def _cut(spans_name: str):
    """Rows with their texts cut where they have spans, and ``n_chars`` set to the new length there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            spans = common.column(batch, spans_name)
            out = batch.select([c for c in batch.schema.names if c != spans_name])
            if spans.null_count < len(spans):
                text = [t if s is None else cut(t, [(x["start_word"], x["end_word"]) for x in s]) for t, s in zip(common.column(batch, "text").to_pylist(), spans.to_pylist(), strict=True)]
                i = out.schema.get_field_index("text")
                out = out.set_column(i, out.schema.field(i), pa.array(text, out.schema.field(i).type))
                if (i := out.schema.get_field_index("n_chars")) >= 0 and pa.types.is_integer(out.schema.field(i).type):
                    kind = out.schema.field(i).type
                    new = pc.if_else(spans.is_valid(), pc.utf8_length(common.column(out, "text")).cast(kind), common.column(out, "n_chars"))
                    out = out.set_column(i, out.schema.field(i), new)
            yield out

    return run


def without_repeats(docs: DataFrame, least: int = LEAST, window: int = WINDOW) -> DataFrame:
    """``docs`` with each repeated passage left only in the first document that has it.

    No row is dropped; a text may become shorter or empty, and ``n_chars``,
    where there is such a number, follows it. Rows without repeated passages
    stay as they are. Each row is cut by the spans of its own text, also where
    its doc_id stands before other texts.
    """
    spans = common.table(repeated_spans(docs, least, window).where("not first"), "spans")
    grouped = spans.groupBy(F.col("doc_id").alias("own_id"), F.col("text_hash").alias("own_hash")).agg(F.collect_list(F.struct("start_word", "end_word")).alias("own_spans"))
    name = "spans"
    while name in docs.columns:
        name += "_"
    columns = [docs[f"`{c}`"] for c in docs.columns]
    joined = docs.join(grouped, (docs["doc_id"].cast("long") == grouped["own_id"]) & (F.xxhash64(docs["text"]) == grouped["own_hash"]), "left")
    return joined.select(*columns, grouped["own_spans"].alias(name)).mapInArrow(_cut(name), docs.schema)
