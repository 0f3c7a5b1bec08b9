"""Comparing a book's documents with a second publication of the same text, end to end."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from foliospark.functions import text as tx
from foliospark.operators import align, coverage
from foliospark.operators.lineage import written

# Fixed value: figure markers count as blanks where texts are compared.
FIGURE_MARK = r"\[\[FIG(?:-MISSING)?:[^\]]*\]\]"


def joined(pieces: DataFrame, key: list[str]) -> DataFrame:
    """(key..., head, text, occurrences, page, page_end): pieces (head, piece, page_begin, page_stop) of each document in order."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("head", "piece"))), lambda x: x["piece"]), "\n\n")
    return pieces.groupBy(*key).agg(F.min("head").alias("head"), text.alias("text"), F.count("*").alias("occurrences"), F.min("page_begin").alias("page"), F.max("page_stop").alias("page_end"))


def aligned(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """Documents as the second publication has them: (book, id, head, text, anchored_by, occurrences, page, page_end).

    ``docs``: (book, id, path, title, markdown). Pieces of a document that is
    met more than once are joined in order.
    """
    book = align.placed(pages)
    starts = book.select("book", "page", "start")
    body = tx.canonical(F.regexp_replace("markdown", FIGURE_MARK, " "))
    asked = docs.select("book", "id", tx.canonical(F.coalesce("path", F.lit(""))).alias("path"), tx.canonical(F.coalesce("title", F.lit(""))).alias("title"), F.coalesce(body, F.lit("")).alias("body"))
    kept = written(align.boundaries(align.anchors(asked, book)), "kept")
    cut = written(align.page_pieces(kept, book), "pieces")
    # places only go through the search for pages, texts stay; a piece is known by its book and head
    points = cut.select("book", "head", F.explode(F.array(F.col("head"), F.col("head") + F.length("piece"))).alias("at"))
    spans = align.page_of(points, starts, "book", "at", "page").groupBy("book", "head").agg(F.min_by("page", "at").alias("page_begin"), F.max_by("page", "at").alias("page_stop"))
    spans = cut.join(spans, ["book", "head"])
    how = kept.groupBy("book", "id").agg(F.min("how").alias("anchored_by"))
    return joined(spans, ["book", "id"]).join(how, ["book", "id"])


#: Words of texts that a task looks at together, about.
BLOCK = 1_000_000
_D = np.uint64(0xD6E8FEB86659FD93)


def _blocks(batches: Iterator[pa.RecordBatch], words: list[int]) -> Iterator[pa.RecordBatch]:
    """Rows in blocks of about ``BLOCK`` words in the columns ``words``, whatever a batch holds."""
    for batch in batches:
        sizes = sum(pc.fill_null(pc.list_value_length(batch.column(i)), 0).to_numpy(zero_copy_only=False).astype(np.int64) for i in words)
        cuts = [0, *np.flatnonzero(np.diff(np.cumsum(sizes) // BLOCK)) + 1, batch.num_rows]
        yield from (batch.slice(int(i), int(j - i)) for i, j in pairwise(cuts) if j > i)


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """How many words each row has, and all of them."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return sizes, column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)


def _grams(sizes: np.ndarray, words: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """Row, position and 128 bits of each n-gram; fewer words are one short n-gram."""
    counts = np.where(sizes > 0, np.maximum(sizes - (n - 1), 1), 0)
    row = np.repeat(np.arange(len(sizes)), counts)
    pos = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    at, short, out = np.repeat(np.cumsum(sizes) - sizes, counts) + pos, np.flatnonzero(sizes[row] < n), []
    for m in (align._A, _D):
        # n words are covered by two runs of 2^j; those of rows with fewer are told one by one
        run, size = align._mixed(words + m), 1
        while size * 2 <= n:
            run, size = align._mixed(run[:-size] * m + run[size:]) if len(run) > size else run[:0], size * 2
        keys = np.zeros(len(row), np.uint64)
        if len(short) < len(row):
            whole = np.flatnonzero(sizes[row] >= n) if len(short) else slice(None)
            keys[whole] = align._mixed(run[at[whole]] * align._B + run[at[whole] + (n - size)]) if size < n else run[at[whole]]
        if len(short):
            own = sizes[row[short]]
            x = own.astype(np.uint64)
            for k in range(int(own.max())):
                x = np.where(k < own, align._mixed(x * m + words[np.minimum(at[short] + k, len(words) - 1)]), x)
            keys[short] = align._mixed(x + align._C)
        out.append(keys)
    return row, pos, *out


def _counts(row: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, word and how often it stands there, once for each; rows in order."""
    order = np.argsort(_keys(row, words), kind="stable")  # equal keys of different rows stay apart
    row, words = row[order], words[order]
    first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (words[1:] != words[:-1])][: len(row)])
    return row[first], words[first], np.diff(np.r_[first, len(row)])


def _keys(row: np.ndarray, words: np.ndarray) -> np.ndarray:
    return align._mixed(words + row.astype(np.uint64) * align._A)


def _places(row: np.ndarray, a: np.ndarray, of_row: np.ndarray, of_a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each (row, a) stands among others (some), and whether it does; where two keys are equal by chance it may be told as none."""
    key, of = _keys(row, a), _keys(of_row, of_a)
    order = np.argsort(of)
    at = order[np.minimum(np.searchsorted(of[order], key), len(of) - 1)]
    return at, (of_row[at] == row) & (of_a[at] == a)


def _codes(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    made = column.dictionary_encode()
    return made.dictionary, made.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _batch(schema: T.StructType, *columns: pa.Array | np.ndarray) -> pa.RecordBatch:
    """Columns as the schema has them; hashes as signed numbers."""
    signed = (x.view(np.int64) if isinstance(x, np.ndarray) and x.dtype == np.uint64 else x for x in columns)
    arrow = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(signed, arrow, strict=True)], schema=arrow)


def _typed(df: DataFrame, names: str) -> T.StructType:
    return T.StructType([df.schema[x] if x in df.columns else T.StructField(x, T.IntegerType() if x == "pos" else T.LongType()) for x in names.split()])


def gram_rows(texts: DataFrame, n: int = coverage.N) -> DataFrame:
    """(book, a, b): the n-grams of texts (book, h: hashes of words), of some rows at a time once."""
    schema = _typed(texts, "book a b")

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches, [1]):
            books, codes = _codes(batch.column(0))
            row, _, a, b = _grams(*_flat(batch.column(1)), n)
            book = codes[row]
            order = np.argsort(_keys(book, a))
            book, a, b = book[order], a[order], b[order]
            new = np.r_[True, (book[1:] != book[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])][: len(book)]
            yield _batch(schema, books.take(pa.array(book[new])), a[new], b[new])

    return texts.select("book", "h").where(F.col("book").isNotNull() & (F.size("h") > 0)).mapInArrow(told, schema)


def word_rows(texts: DataFrame) -> DataFrame:
    """(book, word, n): how often words stand in texts (book, h), of some rows at a time once."""
    schema = _typed(texts, "book word n")

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches, [1]):
            books, codes = _codes(batch.column(0))
            sizes, words = _flat(batch.column(1))
            book, word, c = _counts(np.repeat(codes, sizes), words)
            yield _batch(schema, books.take(pa.array(book)), word, c)

    return texts.select("book", "h").where(F.col("book").isNotNull() & (F.size("h") > 0)).mapInArrow(told, schema)


def asked_grams(pairs: DataFrame, n: int = coverage.N) -> DataFrame:
    """(book, key, pos, a, b): the n-grams of texts (book, key, h) that their mates (m) lack."""
    schema = _typed(pairs, "book key pos a b")

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches, [2, 3]):
            row, pos, a, b = _grams(*_flat(batch.column(2)), n)
            of_row, _, of_a, of_b = _grams(*_flat(batch.column(3)), n)
            if len(of_row):
                at, known = _places(row, a, of_row, of_a)
                left = ~(known & (of_b[at] == b))
                row, pos, a, b = row[left], pos[left], a[left], b[left]
            yield _batch(schema, batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), pos, a, b)

    return pairs.select("book", "key", "h", "m").mapInArrow(told, schema)


def asked_words(pairs: DataFrame) -> DataFrame:
    """(book, key, word, c): the words of texts (book, key, h) that stand less often in their mates (m)."""
    schema = _typed(pairs, "book key word c")

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches, [2, 3]):
            (sizes, words), (of_sizes, of_words) = _flat(batch.column(2)), _flat(batch.column(3))
            row, word, c = _counts(np.repeat(np.arange(len(sizes)), sizes), words)
            of_row, of_word, of_c = _counts(np.repeat(np.arange(len(of_sizes)), of_sizes), of_words)
            if len(of_row):
                at, known = _places(row, word, of_row, of_word)
                left = ~known | (of_c[at] < c)
                row, word, c = row[left], word[left], c[left]
            yield _batch(schema, batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), word, c)

    return pairs.select("book", "key", "h", "m").mapInArrow(told, schema)


def paired(texts: DataFrame, mates: DataFrame, n: int = coverage.N) -> DataFrame:
    """(book, key, h, m): texts (book, key, h) with the words that their mates (book, key, lead, h), of the same key on the other side, have.

    A mate is part of the other side's whole, so what it has is found there: a
    text that equals its mate needs no search and is left out, but for one of
    fewer than ``n`` words, whose only n-gram is not one of a longer whole.
    """
    same = mates.where(F.col("book").isNotNull()).dropDuplicates(["book", "key"]).select("book", "key", "lead", F.col("h").alias("_h"))
    rows = texts.select("book", "key", "h").where(F.size("h") > 0).join(same, ["book", "key"], "left")
    rows = rows.where(~F.col("h").eqNullSafe(F.col("_h")) | (F.size("h") < n) & (F.size("lead") > 0))
    return rows.select("book", "key", "h", F.concat("lead", "_h").alias("m"))


def compared(docs: DataFrame, other: DataFrame, node_titles: DataFrame | None = None, n: int = coverage.N) -> DataFrame:
    """Both sides of each aligned document against the whole of the other side of its book, with a verdict.

    ``docs``: (book, id, path, title, markdown); ``other``: :func:`aligned`.
    Web references are path, title and text of all documents and the titles of
    all nodes; the documents' own n-grams are those of their text only.
    ``extra_in_pdf`` and ``extra_in_web`` hold the first passages that the other
    side lacks.
    """
    key = lambda df: df.withColumn("key", F.concat_ws("/", "book", F.col("id").cast("string")))
    mark = F.regexp_replace("markdown", FIGURE_MARK, " ")
    web = key(docs.withColumn("text", mark))
    pdf = key(other)
    hashed = lambda text: F.transform(tx.words(F.lower(text)), lambda w: F.xxhash64(w))
    none = F.array().cast("array<bigint>")
    # words are told from texts once; a blank parts titles from texts, so no word lies in both
    ours = written(web.select("book", "key", hashed(F.concat_ws(" ", "path", "title")).alias("lead"), F.coalesce(hashed(F.col("text")), none).alias("h")), "words")
    theirs = written(pdf.select("book", "key", none.alias("lead"), F.coalesce(hashed(F.col("text")), none).alias("h")), "words")
    every = ours.select("book", F.concat("lead", "h").alias("h"))
    if node_titles is not None:
        every = every.unionByName(node_titles.where("title <> ''").select("book", hashed(F.col("title")).alias("h")))

    def side(own: DataFrame, words: DataFrame, mates: DataFrame, whole: DataFrame, name: str) -> DataFrame:
        """``own`` texts by their ``words`` against the ``whole`` of the other side, of which ``mates`` has the texts of the same keys."""
        total = words.groupBy("key").agg(F.sum(F.when(F.size("h") > 0, F.greatest(F.size("h") - (n - 1), F.lit(1))).otherwise(0)).alias(f"{name}_words"), F.sum(F.size("h")).alias(f"_n_{name}"))
        pairs = paired(words, mates, n)
        gone = asked_grams(pairs, n).join(gram_rows(whole, n), ["a", "b", "book"], "left_anti").select("book", "key", "pos")
        found = gone.groupBy("key").agg(F.count("*").alias(f"only_in_{name}"))
        bags = word_rows(whole).groupBy("word", "book").agg(F.sum("n").alias("n"))
        lost = F.col("c") - F.least("c", F.coalesce("n", F.lit(0)))
        lost = asked_words(pairs).join(bags, ["word", "book"], "left").groupBy("key").agg(F.sum(lost).alias(f"_lost_{name}"))
        shown = coverage.passages(own, gone, ["book", "key"])
        shown = shown.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("run", "passage"))), lambda x: x["passage"]).alias(f"extra_in_{name}"))  # a few
        out = own.select("key").join(total, "key", "left").join(found, "key", "left").join(lost, "key", "left").join(shown, "key", "left").withColumn(f"extra_in_{name}", F.coalesce(f"extra_in_{name}", F.array().cast("array<string>"))).na.fill(0, [f"{name}_words", f"only_in_{name}", f"_n_{name}", f"_lost_{name}"])
        out = out.withColumn(f"lexical_{name}", coverage.ratio(F.col(f"_n_{name}") - F.col(f"_lost_{name}"), F.col(f"_n_{name}"))).drop(f"_n_{name}", f"_lost_{name}")
        return out.withColumn(f"coverage_{name}", coverage.ratio(F.col(f"{name}_words") - F.col(f"only_in_{name}"), F.col(f"{name}_words")))

    both = pdf.select("book", "id", "key", "page", "page_end", "anchored_by").join(side(pdf, theirs, ours, every, "pdf"), "key").join(side(web, ours, theirs, theirs, "web"), "key")
    doubtful = tx.suspect(F.col("pdf_words"), F.col("web_words"))
    return both.withColumn("alignment_suspect", doubtful).withColumn("verdict", tx.verdict(F.col("coverage_pdf"), F.col("lexical_pdf"), doubtful)).drop("key")


def report(docs: DataFrame, found: DataFrame) -> DataFrame:
    """One row a book: documents, aligned, unanchored, n-gram positions of both sides and the extra ones of extra documents, verdict counts."""
    totals = docs.groupBy("book").agg(F.count("*").alias("documents"))
    verdicts = [F.count_if(F.col("verdict") == v).alias(v) for v in ("match", "unaligned", "reformatted", "extra_in_pdf")]
    rows = found.groupBy(F.col("book").alias("_b")).agg(F.count("*").alias("aligned"), F.sum("pdf_words").alias("pdf_words"), F.sum("web_words").alias("web_words"), F.sum(F.when(F.col("verdict") == "extra_in_pdf", F.col("only_in_pdf")).otherwise(0)).alias("extra_words_in_pdf"), *verdicts)
    joined = totals.join(rows, F.col("book") == F.col("_b"), "left").drop("_b").na.fill(0)
    return joined.withColumn("unanchored", F.col("documents") - F.col("aligned"))
