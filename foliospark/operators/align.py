"""Aligning one long text with documents: anchors, boundaries, pieces, pages."""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from foliospark.operators import ranks, successors
from foliospark.operators.lineage import written

#: Characters between a path and its title, and of a body's beginning that it is known by, at most.
GAP, BODY = 300, 120


def page_offsets(pages: DataFrame, book: str, page: str, text: str) -> DataFrame:
    """(book, page, start): where each page begins in the book's joined text, pages with one blank between."""
    order = Window.partitionBy(book).orderBy(page).rowsBetween(Window.unboundedPreceding, -1)
    return pages.where(F.length(text) > 0).select(book, page, F.coalesce(F.sum(F.length(text) + 1).over(order), F.lit(0)).cast("long").alias("start"))


def page_of(offsets: DataFrame, starts: DataFrame, book: str, offset: str, page: str) -> DataFrame:
    """``offsets`` with the page that each falls on: the last that starts at or before it.

    Starts and offsets are dealt out together by ranges of (book, place), so a
    book of any size is spread; a range knows the last start of the ranges
    before it.
    """
    a = starts.select(F.col(book).alias("_b"), F.col("start").cast("long").alias("_o"), F.col(page).alias("_p"), F.lit(0).alias("_k"))
    rows = offsets.select(F.col(book).alias("_b"), F.col(offset).cast("long").alias("_o"), F.lit(None).cast(starts.schema[page].dataType).alias("_p"), F.lit(1).alias("_k"), F.struct("*").alias("_r"))
    both = rows.unionByName(a, allowMissingColumns=True)
    n = int(offsets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(both.repartitionByRange(n, "_b", "_o", "_k", F.xxhash64("_r")).withColumn("_part", F.spark_partition_id()), "places")
    before = Window.partitionBy("_c").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    lasts = dealt.groupBy(F.col("_b").alias("_c"), F.col("_part").alias("_at")).agg(F.max_by("_p", F.when(F.col("_k") == 0, F.struct("_o", "_p"))).alias("_last"))
    carried = lasts.select("_c", "_at", F.last("_last", ignorenulls=True).over(before).alias("_carry"))
    inside = F.last("_p", ignorenulls=True).over(Window.partitionBy("_b", "_part").orderBy("_o", "_k", "_p").rowsBetween(Window.unboundedPreceding, 0))
    found = dealt.withColumn("_in", inside).where("_k = 1").join(carried, F.col("_b").eqNullSafe(F.col("_c")) & (F.col("_part") == F.col("_at")), "left")
    return found.select("_r.*", F.coalesce("_in", "_carry").alias(page))


# ------------------------------------------------------------ texts in a text
#: Characters of patterns in one automaton, and of a text in one slice, about.
PATTERNS, SLICE = 4_000_000, 50_000


def lowered(text: str) -> str:
    """In small letters, of the same length: a letter that would become two stays, so that places hold in the text itself."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x) == 1 else c for c in text for x in (c.lower(),))


def automaton(words: Iterable[tuple[str, int]]):
    """An Aho-Corasick automaton whose words tell which numbers they have; None without words."""
    import ahocorasick

    numbers: dict[str, list[int]] = {}
    for word, number in words:
        if word:
            numbers.setdefault(word, []).append(number)
    if not numbers:
        return None
    made = ahocorasick.Automaton()
    for word, own in numbers.items():
        made.add_word(word, (len(word), own))
    made.make_automaton()
    return made


def pattern_blocks(patterns: DataFrame, size: Column) -> Iterator[list[Row]]:
    """The rows of ``patterns`` in blocks of about ``PATTERNS`` characters, each of which is broadcast by itself."""
    total = patterns.agg(F.sum(size).alias("n")).first()["n"] or 0
    n = int(total // PATTERNS) + 1
    dealt = patterns if n == 1 else patterns.withColumn("_block", F.pmod(F.xxhash64(*patterns.columns), F.lit(n)))
    for i in range(n):
        yield (dealt if n == 1 else dealt.where(F.col("_block") == i).drop("_block")).collect()


def first_hits(texts: DataFrame, patterns: DataFrame, key: str, text: str, pattern_key: str, pattern: str) -> DataFrame:
    """(key, pattern_key, first_hit): where each text first holds each pattern, from 1; texts that hold it only.

    One pass over the texts finds all patterns of a block; no text is shuffled.
    An empty pattern is in every text.
    """
    sc, parts = texts.sparkSession.sparkContext, []
    schema = T.StructType([texts.schema[key], patterns.schema[pattern_key], T.StructField("first_hit", T.LongType())])
    for block in pattern_blocks(patterns.select(pattern_key, pattern).where(F.col(pattern).isNotNull()), F.length(pattern) + 8):
        shared = sc.broadcast([tuple(r) for r in block])

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            words = shared.value
            seek, always = automaton((w, i) for i, (_, w) in enumerate(words)), [i for i, (_, w) in enumerate(words) if not w]
            for batch in batches:
                rows: list[tuple] = []
                for own, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    first = dict.fromkeys(always, 1)
                    for end, (length, numbers) in seek.iter(body) if seek is not None else ():
                        for i in numbers:
                            first.setdefault(i, end - length + 2)
                    rows += [(own, words[i][0], at) for i, at in first.items()]
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=to_arrow_schema(schema))

        parts.append(texts.select(key, text).where(F.col(text).isNotNull()).mapInArrow(find, schema))
    return functools.reduce(DataFrame.unionAll, parts)


def occurrences(path: str, title: str, body: str, text: str, gap: int = GAP) -> list[tuple[int, int, str]]:
    """Where a document begins in a text: (head, body start, how), all lower-cased beforehand.

    Each place of the path counts if the title follows within ``gap`` (a title
    inside the path does); without any, the first place of the body's first 120
    characters, if it has 40. A document without a title has no headings.
    """
    heads = [h for m in re.finditer(f"(?={re.escape(path)})", text) if (h := heading_at(m.start(), path, title, text, gap))] if title else []
    start = -1 if heads or len(body[:BODY]) < 40 else text.find(body[:BODY])
    return heads if start < 0 else [(start, start, "body")]


def heading_at(head: int, path: str, title: str, text: str, gap: int) -> tuple[int, int, str] | None:
    """The heading whose path stands at ``head``, if its title follows within ``gap``."""
    at = text.find(title, head, head + len(path) + gap + len(title))
    return (head, at + len(title), "heading") if at >= 0 else None


def placed(pages: DataFrame, book: str = "book", page: str = "page", text: str = "text") -> DataFrame:
    """(book, page, text, start): pages that have text, with where each begins in the book's joined text, one blank between pages.

    Pages are dealt out by ranges of (book, page); a range knows how much text
    the ranges before it have, so no task sees a whole book. Their texts are
    made once, before ranges are told from samples.
    """
    n = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = written(pages.select(F.col(book).alias("book"), F.col(page).alias("page"), F.col(text).alias("text")), "texts").where(F.length("text") > 0)
    dealt = written(rows.repartitionByRange(n, "book", "page", "text").withColumn("_part", F.spark_partition_id()), "pages")
    size = F.length("text").cast("long") + 1
    before = Window.partitionBy("_c").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy(F.col("book").alias("_c"), F.col("_part").alias("_at")).agg(F.sum(size).alias("_n"))
    carried = sums.select("_c", "_at", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.sum(size).over(Window.partitionBy("book", "_part").orderBy("page", "text").rowsBetween(Window.unboundedPreceding, -1))
    found = dealt.withColumn("_in", F.coalesce(inside, F.lit(0))).join(carried, F.col("book").eqNullSafe(F.col("_c")) & (F.col("_part") == F.col("_at")))
    return found.select("book", "page", "text", (F.col("_before") + F.col("_in")).alias("start"))


def slices(books: DataFrame, width: int, over: int = 0) -> DataFrame:
    """(book, begin, text): each book's text in slices of ``width`` characters and ``over`` more of the next.

    ``books``: (book, text), whole texts, or the pages (book, start, text) of :func:`placed`.
    """
    if "start" not in books.columns:
        schema = T.StructType([books.schema["book"], T.StructField("begin", T.LongType()), T.StructField("text", T.StringType())])

        def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i, text in enumerate(batch.column(1).to_pylist()):
                    for begin in range(0, len(text), width):
                        yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([begin], pa.int64()), pa.array([text[begin : begin + width + over]])], names=schema.names)

        return books.select("book", "text").where(F.length("text") > 0).mapInArrow(cut_up, schema)
    # a page but the first begins with the blank before it
    whole = F.when(F.col("start") > 0, F.concat(F.lit(" "), "text")).otherwise(F.col("text"))
    own = books.select("book", whole.alias("_t"), (F.col("start") - (F.col("start") > 0).cast("long")).alias("_from")).withColumn("_to", F.col("_from") + F.length("_t"))
    cells = F.sequence(F.greatest(F.lit(0), F.floor((F.col("_from") - over) / width)).cast("long"), F.floor((F.col("_to") - 1) / width).cast("long"))
    cut_rows = own.select("*", F.explode(cells).alias("_cell")).withColumn("_low", F.greatest("_from", F.col("_cell") * width))
    high = F.least(F.col("_to"), (F.col("_cell") + 1) * width + over)
    part = F.substring("_t", (F.col("_low") - F.col("_from") + 1).cast("int"), (high - F.col("_low")).cast("int"))
    lists = cut_rows.select("book", "_cell", F.struct("_low", part.alias("_part")).alias("_x")).groupBy("book", "_cell").agg(F.array_sort(F.collect_list("_x")).alias("_l"))  # a slice's text
    return lists.select("book", (F.col("_cell") * width).alias("begin"), F.array_join(F.transform("_l", lambda x: x["_part"]), "").alias("text"))


#: What is searched for: paths, titles, titles of documents without a path, beginnings of bodies.
PATHS, TITLES, BARE, BODIES = range(4)
#: Bits of the filter that tasks hold: for each document, and at most; a fuller one lets more places pass to the join.
BITS, MOST_BITS = 100, 1 << 27
#: Pairs of a path and a title after it that a task looks at together, about.
PAIRS = 1_000_000
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_ALL = (1 << 64) - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _B
    return x ^ (x >> np.uint64(29))


def _levels(text: str, longest: int) -> list[np.ndarray]:
    """A hash of the 1, 2, 4, 8... letters from each place of a text, up to ``longest``."""
    out = [_mixed(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) * _A + _C)]
    while (size := 1 << len(out)) <= min(longest, len(text)):
        half = size >> 1
        out.append(_mixed(out[-1][:-half] * _A + out[-1][half:]))
    return out


def _begun(level: np.ndarray, kind: int, j: int, salt: np.ndarray | np.uint64) -> np.ndarray:
    """Keys of what begins with the 2^j letters hashed, in the book that ``salt`` is of."""
    return _mixed((level ^ salt) + np.uint64(int(_C) * (kind * 64 + j + 1) & _ALL))


def _keys(level: np.ndarray, at: np.ndarray, length: np.ndarray | int, kind: int, j: int, salt: np.ndarray | np.uint64) -> np.ndarray:
    """Keys of the words of ``length`` at ``at``, 2^j letters or more and less than twice as many: two hashes cover each."""
    both = _mixed(level[at] * _B + level[at + length - (1 << j)])
    return _mixed((both ^ salt) + _A * (np.atleast_1d(length).astype(np.uint64) * np.uint64(8) + np.uint64(kind + 1)))


def _both(path: np.ndarray, title: np.ndarray) -> np.ndarray:
    """Keys of a path with a title, by the keys of either."""
    return _mixed(path * _B + title)


def _bits(keys: np.ndarray, n: int) -> list[np.ndarray]:
    """The two bits of each key."""
    return [keys & np.uint64(n - 1), (keys >> np.uint64(32)) & np.uint64(n - 1)]


def _held(keys: np.ndarray, made: np.ndarray) -> np.ndarray:
    """Which of the keys, by their numbers, pass the filter."""
    at = np.arange(len(keys))
    for shift in (0, 32):
        b = (keys[at] >> np.uint64(shift)) & np.uint64((len(made) << 6) - 1)
        at = at[(made[b >> np.uint64(6)] >> (b & np.uint64(63))) & np.uint64(1) != 0]
    return at


def _surely(keys: np.ndarray, made: np.ndarray) -> np.ndarray:
    """As :func:`_held`, of keys that have four bits."""
    at = _held(keys, made)
    return at[_held(_mixed(keys[at]), made)]


def pattern_filter(asked: DataFrame) -> tuple[np.ndarray, dict[int, list[int]]]:
    """A filter of all that is searched for in each book, each path with its title too, and the lengths of each kind. ``asked``: book, path, title, body."""
    kinds = {PATHS: ("path", "path <> '' and title <> ''"), TITLES: ("title", "path <> '' and title <> ''"), BARE: ("title", "path = '' and title <> ''"), BODIES: ("body", "length(body) >= 40")}
    facts = asked.agg(F.count("*").alias("n"), *[F.array_sort(F.collect_set(F.when(F.expr(x), F.length(c)))).alias(str(k)) for k, (c, x) in kinds.items()]).first()  # distinct lengths
    lengths = {k: facts[str(k)] for k in kinds}
    n = min(MOST_BITS, 1 << max(16, (facts["n"] * BITS).bit_length()))

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            salts, (paths, titles, bodies) = batch.column(0).to_numpy().view(np.uint64), (c.to_pylist() for c in batch.columns[1:])
            found = [np.zeros(0, np.uint64)]

            def keys(kind: int, rows: list[int], words: list[str], salts=salts, found=found) -> np.ndarray:
                own, salt = [words[i] for i in rows], salts[rows]
                size = np.array([len(w) for w in own], np.int64)
                made = np.zeros(len(own), np.uint64)
                if own:
                    first, levels, classes = np.cumsum(size) - size, _levels("".join(own), int(size.max())), np.frexp(size)[1] - 1
                    for j in np.unique(classes).tolist():
                        mine = classes == j
                        made[mine] = _keys(levels[j], first[mine], size[mine], kind, j, salt[mine])
                        found += _bits(_begun(levels[j][first[mine]], kind, j, salt[mine]), n)
                    found += [*_bits(made, n), *(_bits(_mixed(made), n) if kind == BODIES else [])]
                return made

            headed = [i for i, t in enumerate(titles) if t and paths[i]]
            both = _both(keys(PATHS, headed, paths), keys(TITLES, headed, titles))
            found += [*_bits(both, n), *_bits(_mixed(both), n)]  # as _surely asks
            keys(BARE, [i for i, t in enumerate(titles) if t and not paths[i]], titles)
            keys(BODIES, [i for i, t in enumerate(bodies) if len(t) >= 40], bodies)
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)).astype(np.int64))], names=["bit"])

    bits = asked.select(F.xxhash64("book").alias("salt"), "path", "title", "body").mapInArrow(told, "bit long")
    rows = bits.groupBy(F.shiftright("bit", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("own")).toArrow()  # MOST_BITS / 64 rows at most
    made = np.zeros(n >> 6, np.uint64)
    made[rows.column("at").to_numpy()] = rows.column("own").to_numpy().view(np.uint64)
    return made, lengths


def met(text: str, salt: np.uint64, made: np.ndarray, classes: dict[int, dict[int, list[int]]], longest: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By kind, the places, lengths and keys of all that passes the filter, by place; some of it may not be searched for."""
    levels = _levels(text, longest)
    out = {}
    for kind, own in classes.items():
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))]
        for j, lengths in own.items():
            if j >= len(levels):
                continue
            begun = _held(_begun(levels[j], kind, j, salt), made)
            for length in lengths:
                at = begun[begun + length <= len(text)]
                keys = _keys(levels[j], at, length, kind, j, salt)
                held = _surely(keys, made) if kind == BODIES else _held(keys, made)  # bodies have many lengths
                found.append((at[held], np.full(len(held), length), keys[held]))
        place, size, key = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((size, place))
        out[kind] = place[order], size[order], key[order]
    return out


def paired(paths: tuple[np.ndarray, np.ndarray, np.ndarray], titles: tuple[np.ndarray, np.ndarray, np.ndarray], made: np.ndarray, gap: int) -> Iterator[tuple[int, int, int, int]]:
    """(place, length) of each path with those of each title that begins within ``gap`` of its end, by place, where both together pass the filter."""
    (head, length, path), (place, size, title) = paths, titles
    low = np.searchsorted(place, head)
    counts = np.searchsorted(place, head + length + gap, "right") - low
    total, i = np.cumsum(counts), 0
    while i < len(head):
        stop = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + PAIRS, "right")))
        n = counts[i:stop]
        row = np.repeat(np.arange(i, stop), n)
        t = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + low[row]
        both = _both(path[row], title[t])
        held = _surely(both, made)
        row, t = row[held], t[held]
        yield from zip(head[row].tolist(), length[row].tolist(), place[t].tolist(), size[t].tolist(), strict=True)
        i = stop


def _told(*words: str) -> bytes:
    """128 bits of some words."""
    return hashlib.sha256("".join(f"{len(w)} {w}" for w in words).encode()).digest()[:16]


def _tells(*words: str) -> Column:
    """As :func:`_told`, of columns."""
    return F.unhex(F.left(F.sha2(F.concat(*[x for w in words for x in (F.length(w).cast("string"), F.lit(" "), F.col(w))]), 256), F.lit(32)))


def anchors(docs: DataFrame, books: DataFrame, gap: int = GAP) -> DataFrame:
    """(book, id, head, body_start, how) of each document (book, id, path, title, body) in its book's text (book, text).

    ``books`` may also be pages, see :func:`slices`. Texts are cut into slices
    that overlap by the longest heading. Each slice is passed over once: hashes
    of the letters from each place are held against a filter of the book's
    paths, titles and beginnings. Of a path and a title after it both pass, but
    also the two together, so what is written are headings, not all that may
    stand near each other. They are joined with the documents by 128 bits of
    their texts. A document without a path is looked for at every place of the slice.
    """
    own = docs.select("book", "id", *[F.coalesce(c, F.lit("")).alias(c) for c in ("path", "title")], F.left(F.coalesce("body", F.lit("")), F.lit(BODY)).alias("body")).where("title <> '' or length(body) >= 40")
    small = T.StructType([T.StructField(f.name, f.dataType) for f in own.schema])

    def small_letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array([lowered(x) for x in batch.column(i).to_pylist()], pa.string()) for i in (2, 3, 4))], names=small.names)

    asked = written(own.mapInArrow(small_letters, small), "asked")
    made, lengths = pattern_filter(asked)
    classes = {k: {j: [x for x in v if x.bit_length() - 1 == j] for j in sorted({x.bit_length() - 1 for x in v})} for k, v in lengths.items()}
    longest = max((max(v, default=0) for v in lengths.values()), default=0)
    width, over = SLICE, max([BODY, *(max(lengths[a], default=0) + max(lengths[b], default=0) + gap for a, b in ((PATHS, TITLES), (BARE, BARE)))])
    shared = docs.sparkSession.sparkContext.broadcast(made)
    schema = T.StructType([T.StructField("book", docs.schema["book"].dataType), T.StructField("how", T.StringType()), T.StructField("key", T.BinaryType()), *(T.StructField(n, T.LongType()) for n in ("head", "last", "body_start"))])
    arrow = to_arrow_schema(schema)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for book, begin, raw, salt in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = lowered(raw)
                at = met(text, np.uint64(salt & _ALL), shared.value, classes, longest)
                rows, mine, last = [], slice(0, int(np.searchsorted(at[PATHS][0], width))), None
                for head, length, t, size in paired(tuple(x[mine] for x in at[PATHS]), at[TITLES], shared.value, gap):
                    if last != (head, length):
                        last, first = (head, length), set()
                    if (w := text[t : t + size]) not in first:
                        first.add(w)
                        rows.append((book, "heading", _told(text[head : head + length], w), begin + head, begin + head, begin + t + size))
                before: dict[str, int] = {}
                for t, size in zip(*(x.tolist() for x in at[BARE][:2]), strict=True):
                    w = text[t : t + size]
                    low, high = max(before.get(w, 0), t - gap), min(t, width - 1)
                    before[w] = t + 1
                    if low <= high:
                        rows.append((book, "bare", _told(w), begin + low, begin + high, begin + t + size))
                begun: dict[str, int] = {}
                for h, size in zip(*(x.tolist() for x in at[BODIES][:2]), strict=True):
                    if h < width:
                        begun.setdefault(text[h : h + size], begin + h)
                rows += [(book, "body", _told(w), h, h, h) for w, h in begun.items()]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

    salted = slices(books, width, over).withColumn("salt", F.xxhash64(F.col("book").cast(docs.schema["book"].dataType)))
    hits = written(salted.mapInArrow(find, schema), "hits").withColumnRenamed("book", "_b").withColumnRenamed("key", "_key")
    same = F.col("book").eqNullSafe(F.col("_b")) & (F.col("key") == F.col("_key"))
    headings, headed = [], []
    for how, kind, words, of in (("heading", PATHS, ("path", "title"), "path <> '' and title <> ''"), ("bare", BARE, ("title",), "path = '' and title <> ''")):
        if lengths[kind]:
            own, found = asked.where(of).select("book", "id", _tells(*words).alias("key")), hits.where(F.col("how") == how)
            at = F.col("head") if how == "heading" else F.explode(F.sequence("head", "last"))
            headings.append(own.join(found, same).select("book", "id", at.alias("head"), "body_start", F.lit("heading").alias("how")))
            headed.append(own.join(found.select("_b", "_key").distinct(), same, "left_semi").select("book", "id"))
    # documents with headings are told by their keys: headings are not written, copies have as many as the square of their number
    rest = asked.where("length(body) >= 40").select("book", "id", _tells("body").alias("key"))
    rest = written(functools.reduce(lambda left, x: left.join(x, ["book", "id"], "left_anti"), headed, rest), "rest")
    first = rest.join(hits.where("how = 'body'"), same).groupBy("book", "id").agg(F.min("head").alias("head"))
    bodies = first.select("book", "id", "head", F.col("head").alias("body_start"), F.lit("body").alias("how"))
    return functools.reduce(DataFrame.unionByName, [*headings, bodies])


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def outside(heads: pd.Series, starts: pd.Series) -> pd.Series:
    """Of sorted events, the places (from 1) of those whose head is not inside the last kept one."""

    def kept(head, start) -> list[int]:
        out, end = [], None
        for i, (h, s) in enumerate(zip(head, start, strict=True), 1):
            if end is None or h >= end:
                out.append(i)
                end = s
        return out

    return pd.Series([kept(h, s) for h, s in zip(heads, starts, strict=True)])


#: Events of a book that are thinned as one array; larger books by pointer doubling.
LARGE = 100_000


def boundaries(events: DataFrame, book: str = "book", large: int = LARGE) -> DataFrame:
    """Events of each book thinned and with the head of the next kept one (null: the end)."""
    order = ["head", "body_start", "how", "id"]
    big = events.groupBy(book).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > large).select(F.col(book).alias("_b"))
    if big.isEmpty():
        kept = _thinned(events, book)
    else:
        spread = successors.thinned(events.join(big, F.col(book).eqNullSafe(F.col("_b")), "left_semi").select(book, *order), book, order, "head", "body_start")
        kept = _thinned(events.join(big, F.col(book).eqNullSafe(F.col("_b")), "left_anti"), book).unionByName(spread.select(book, *order))
        placed = ranks.numbered(kept, order, [book], "_at")
        after = placed.select(F.col(book).alias("_b"), (F.col("_at") - 1).alias("_before"), F.col("head").alias("next_head"))
        return placed.join(after, F.col(book).eqNullSafe(F.col("_b")) & (F.col("_at") == F.col("_before")), "left").select(book, *order, "next_head")
    return kept.withColumn("next_head", F.lead("head").over(Window.partitionBy(book).orderBy(*order)))


def _thinned(events: DataFrame, book: str) -> DataFrame:
    lists = events.groupBy(book).agg(F.array_sort(F.collect_list(F.struct("head", "body_start", "how", "id"))).alias("e"))  # one small struct for each heading of a book
    places = outside(F.transform("e", lambda x: x["head"].cast("long")), F.transform("e", lambda x: x["body_start"].cast("long")))
    return lists.select(book, "e", F.explode(places).alias("i")).select(book, F.element_at("e", F.col("i")).alias("x")).select(book, "x.*")


def pieces(kept: DataFrame, books: DataFrame, book: str = "book") -> DataFrame:
    """The text of each kept event up to the next: (book, id, head, piece); books by their whole texts."""
    end = F.coalesce("next_head", F.length("text").cast("long"))
    joined = kept.join(books.withColumnRenamed(book, "_b"), F.col(book) == F.col("_b"))
    return joined.select(book, "id", "head", F.trim(F.substring("text", (F.col("body_start") + 1).cast("int"), (end - F.col("body_start")).cast("int"))).alias("piece"))


def page_pieces(kept: DataFrame, pages: DataFrame) -> DataFrame:
    """As :func:`pieces`, those that hold text, from the pages of :func:`placed`: each event meets only the slices that its text lies in."""
    width = SLICE
    stops = pages.groupBy(F.col("book").alias("_s")).agg(F.max(F.col("start") + F.length("text")).alias("_end"))
    spans = kept.join(stops, F.col("book") == F.col("_s")).withColumn("_to", F.least(F.coalesce("next_head", "_end"), "_end")).where(F.col("_to") > F.col("body_start"))
    cells = F.sequence(F.floor(F.col("body_start") / width).cast("long"), F.floor((F.col("_to") - 1) / width).cast("long"))
    asked = spans.select("book", "id", "head", "body_start", "_to", F.explode(cells).alias("_cell")).withColumn("_low", F.greatest(F.col("body_start"), F.col("_cell") * width))
    texts = slices(pages, width).select(F.col("book").alias("_b"), F.floor(F.col("begin") / width).alias("_c"), "text")
    part = F.substring("text", (F.col("_low") - F.col("_cell") * width + 1).cast("int"), (F.least(F.col("_to"), (F.col("_cell") + 1) * width) - F.col("_low")).cast("int"))
    found = asked.join(texts, (F.col("book") == F.col("_b")) & (F.col("_cell") == F.col("_c"))).select("book", "id", "head", F.struct("_low", part.alias("_part")).alias("_x"))
    # of kept events that hold text, none begins where another does
    lists = found.groupBy("book", "id", "head").agg(F.array_sort(F.collect_list("_x")).alias("_l"))
    return lists.select("book", "id", "head", F.trim(F.array_join(F.transform("_l", lambda x: x["_part"]), "")).alias("piece")).where("piece <> ''")


def claimed(figures: DataFrame, spans: DataFrame) -> DataFrame:
    """Each figure goes to the first section in order whose pages hold it: (figure, section).

    ``figures``: (book, figure, page, n); ``spans``: (book, section, ord, first, last).
    A span lies in at most three buckets of its own size's power of two, and a
    figure asks in one bucket of each size that there is, so the join is by
    equality and spans of any length are a few rows.
    """
    sized = spans.where("last >= first").withColumn("_lvl", F.floor(F.log2(F.col("last") - F.col("first") + 1)).cast("int"))
    levels = [r["_lvl"] for r in sized.select("_lvl").distinct().collect()]  # as many as a length has bits
    held = sized.select(F.col("book").alias("_b"), "section", "ord", "first", "last", "_lvl", F.explode(F.expr("sequence(shiftright(cast(first as long), _lvl), shiftright(cast(last as long), _lvl))")).alias("_bucket"))
    asked = figures.select("book", "figure", "page", "n", F.explode(F.array(*[F.lit(x) for x in sorted(levels)]).cast("array<int>")).alias("_l")).withColumn("_at", F.expr("shiftright(cast(page as long), _l)"))
    hits = asked.join(held, (F.col("book") == F.col("_b")) & (F.col("_l") == F.col("_lvl")) & (F.col("_at") == F.col("_bucket")) & F.col("page").between(F.col("first"), F.col("last")))
    return hits.groupBy("figure").agg(F.min_by("section", F.struct("ord", "page", "n")).alias("section"))


def prefix_semi(crumbs: DataFrame, known: DataFrame, crumb: str, path: str) -> DataFrame:
    """``crumbs`` that begin a known path or that a known path begins; neither side is empty text.

    The shortest text of either side gives the length of a common prefix, so
    the join is by equality, and only its hits are compared.
    """
    crumbs = crumbs.where(F.length(crumb) > 0)
    known = known.where(F.length(path) > 0)
    shortest = crumbs.agg(F.min(F.length(crumb)).alias("a")).crossJoin(known.agg(F.min(F.length(path)).alias("b"))).select(F.greatest(F.lit(1), F.least("a", "b")).alias("w")).first()["w"] or 1
    a = crumbs.withColumn("_key", F.left(F.col(crumb), F.lit(shortest)))
    b = known.select(F.col(path).alias("_path")).distinct().withColumn("_k", F.left(F.col("_path"), F.lit(shortest)))
    return a.join(b, (F.col("_key") == F.col("_k")) & (F.col(crumb).startswith(F.col("_path")) | F.col("_path").startswith(F.col(crumb))), "left_semi").drop("_key")


def clean_lines(text: Column, header: Column, toc: str = r"\.{5,}\s*\d+\s*$", number: str = r"^\s*\d{1,4}\s*$") -> tuple[Column, Column]:
    """Lines of a page without its leading headers and page numbers and without contents lines; and how many of these were dropped."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")
    top = lambda x: (F.lower(F.trim(x)) == F.lower(header)) | x.rlike(number)
    first = F.array_position(F.transform(lines, lambda x: top(x)), False)
    body = F.when(first > 0, F.slice(lines, first.cast("int"), F.size(lines))).otherwise(F.array().cast("array<string>"))
    keep = F.filter(body, lambda x: ~x.rlike(toc))
    return keep, F.size(body) - F.size(keep)


def block_sample(pages: DataFrame, page: str, total: Column, blocks: int = 4, width: int = 16, low: float = 0.08, high: float = 0.92) -> DataFrame:
    """Pages of ``blocks`` contiguous runs of at most ``width``, centred at even steps from ``low`` to ``high`` of the document."""
    span = F.least(F.lit(width), F.greatest(F.lit(1), F.floor(total / blocks)))
    inside = F.lit(False)
    for i in range(blocks):
        middle = F.floor(total * (low + (high - low) * i / max(1, blocks - 1)))
        first = F.least(F.greatest(F.lit(1), middle - F.floor(span / 2)), F.greatest(F.lit(1), total - span + 1))
        inside = inside | F.col(page).between(first, F.least(total, first + span - 1))
    return pages.where(inside)
