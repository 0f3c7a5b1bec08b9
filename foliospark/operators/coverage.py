"""What of one body of text is found in another: n-gram and word-bag coverage, with a verdict.

N-grams meet by 128-bit keys, so that eight copies of a text are neither held
nor shuffled; words themselves are only looked at where passages are shown.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.functions import text as tx

N = 8
#: Passages of missing text: characters between places of one passage, and how many are shown.
GAP, SHOWN = 200, 5


def gram_key(shingle: Column) -> Column:
    """128 bits of an n-gram."""
    return F.struct(F.xxhash64(shingle).alias("a"), F.xxhash64(F.lit(N), shingle).alias("b"))


def grams(text: Column, n: int) -> Column:
    """Keys of all n-grams of the lower-cased text in order; each word is hashed once, its n-grams from the words' hashes."""
    runs = lambda h: F.transform(F.when(F.size(h) > 0, F.sequence(F.lit(1), F.greatest(F.size(h) - (n - 1), F.lit(1)))).otherwise(F.array().cast("array<int>")), lambda i: F.slice(h, i, n))
    return F.transform(tx.let(F.transform(tx.words(F.lower(text)), lambda w: F.xxhash64(w)), runs), gram_key)


def shingle_rows(docs: DataFrame, key: list[str], text: str = "text", n: int = N) -> DataFrame:
    """(key..., pos, gram) for each n-gram position of the lower-cased text."""
    return docs.select(*key, F.posexplode(grams(F.col(text), n)).alias("pos", "gram"))


def shingle_texts(docs: DataFrame, text: str = "text", n: int = N) -> DataFrame:
    """The distinct n-grams of a body of text as words."""
    return docs.select(F.explode(tx.shingles(tx.words(F.lower(text)), n)).alias("shingle")).distinct()


def reference(docs: DataFrame, text: str = "text", n: int = N, by: list[str] | None = None) -> DataFrame:
    """The distinct n-grams of a body of text by their keys; of each body, where ``by`` names some."""
    return docs.select(*(by or []), F.explode(grams(F.col(text), n)).alias("gram")).distinct()


def missing(rows: DataFrame, known: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows of :func:`shingle_rows` whose n-gram the reference lacks."""
    return rows.join(known, [*(by or []), "gram"], "left_anti")


def _spans(lead: Column, parts: Column, positions: Column, n: int, gap: int, most: int | None, found: bool) -> Column:
    """First and last place of each run, from the place of the first word, the lengths of words with what is after them and the positions missing, or ``found``, in order.

    One fold over the words; what it keeps grows with the runs only.
    """
    kind = "array<struct<first:bigint,last:bigint>>"
    none = F.lit(None).cast("long")
    state = F.struct(F.lit(0).alias("i"), lead.cast("long").alias("at"), F.lit(0).alias("k"), none.alias("first"), none.alias("last"), F.array().cast(kind).alias("runs"))

    def closed(acc: Column, when: Column) -> Column:
        room = when & acc["last"].isNotNull() & (F.size(acc["runs"]) < most if most is not None else F.lit(True))
        return F.when(room, F.concat(acc["runs"], F.array(F.struct(acc["first"].alias("first"), acc["last"].alias("last"))))).otherwise(acc["runs"])

    def step(acc: Column, size: Column) -> Column:
        named = F.coalesce(F.get(positions, acc["k"]) == acc["i"], F.lit(False))
        gone = ~named & (acc["i"] < F.greatest(F.size(parts) - (n - 1), F.lit(1))) if found else named
        opens = gone & F.coalesce(acc["at"] - acc["last"] >= gap, F.lit(True))
        return F.struct(
            (acc["i"] + 1).alias("i"), (acc["at"] + size).alias("at"), F.when(named, acc["k"] + 1).otherwise(acc["k"]).alias("k"),
            F.when(opens, acc["at"]).otherwise(acc["first"]).alias("first"), F.when(gone, acc["at"]).otherwise(acc["last"]).alias("last"), closed(acc, opens).alias("runs"),
        )

    return F.aggregate(parts, state, step, lambda acc: closed(acc, F.lit(True)))


def _shown(docs: DataFrame, key: list[str], text: str, n: int, gap: int, most: int | None, found: bool) -> DataFrame:
    """(key..., run, first, passage) of documents with ``_pos``, each from its own row: neither words nor places are shuffled."""
    own = F.when(F.length(F.lower(text)) == F.length(text), F.col(text)).otherwise(F.lower(text))
    rest = "[^" + tx.WORD[1:-2] + "]*"
    low = docs.select(*key, own.alias("_text"), "_pos").withColumn("_low", F.lower("_text"))
    lead = F.length(F.regexp_extract("_low", "^" + rest, 0))
    sizes = tx.let(F.transform(F.regexp_extract_all("_low", F.lit(tx.WORD + rest), F.lit(0)), F.length), lambda p: _spans(lead, p, F.col("_pos"), n, gap, most, found))
    each = low.select(*key, "_text", F.posexplode(sizes).alias("_i", "_x"))
    cut = F.substr("_text", (F.col("_x.first") + 1).cast("int"), (F.col("_x.last") - F.col("_x.first") + gap).cast("int"))
    return each.select(*key, (F.col("_i") + 1).cast("long").alias("run"), F.col("_x.first").alias("first"), tx.strip(cut).alias("passage"))


def passages(docs: DataFrame, gone: DataFrame, key: list[str], text: str = "text", gap: int = GAP, most: int | None = SHOWN) -> DataFrame:
    """(key..., run, first, passage): the text about missing n-grams (key..., pos), the first ``most`` runs of each document.

    Places less than ``gap`` characters apart are one run, whose passage goes on
    for ``gap`` characters after its last place. Places are of the lower-cased
    text; where lower-casing changes a text's length, its passages are lower-cased too.
    """
    lists = gone.groupBy(*key).agg(F.array_sort(F.array_distinct(F.collect_list("pos"))).alias("_pos"))  # one document's positions
    return _shown(docs.join(lists, key), key, text, N, gap, most, False)


def lacking(docs: DataFrame, known: DataFrame, key: list[str], text: str = "text", n: int = N, gap: int = GAP, most: int | None = SHOWN) -> DataFrame:
    """:func:`passages` of all n-grams that the reference lacks; only the positions that it has are shuffled."""
    lists = shingle_rows(docs, key, text, n).join(known, "gram", "left_semi").groupBy(*key).agg(F.array_sort(F.array_distinct(F.collect_list("pos"))).alias("_pos"))  # one document's positions
    held = docs.select(*key, text).dropna(subset=key)
    return _shown(held.join(lists, key, "left"), key, text, n, gap, most, True)


def ngram_coverage(docs: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text", n: int = N) -> DataFrame:
    """(key, total, n_only, coverage): n-gram positions, those not in the reference, and 1 - n_only / total; 1.0 where there are none.

    Positions are joined by their keys: where the reference is small enough to
    be broadcast nothing but counts is shuffled, else sixteen bytes a position.
    """
    rows = shingle_rows(docs, [key], text, n).select(key, "gram")
    marked = rows.join(known.withColumn("found", F.lit(1)), "gram", "left")
    counts = marked.groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("total"), F.count_if(F.col("found").isNull()).alias("n_only"))
    joined = docs.select(key).join(counts, F.col(key) == F.col("_k"), "left")
    total, only = F.coalesce("total", F.lit(0)), F.coalesce("n_only", F.lit(0))
    return joined.select(key, total.alias("total"), only.alias("n_only"), ratio(total - only, total).alias("coverage"))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, and 1.0 of nothing."""
    return F.when(whole == 0, 1.0).otherwise(part / whole)


def bag(docs: DataFrame, text: str = "text") -> DataFrame:
    """The multiset of words: (word, n)."""
    return docs.select(F.explode(tx.words(F.lower(text))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def lexical_coverage(docs: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, words, lexical): the share of a document's words, counted as a multiset, that the bag holds; 1.0 of none.

    The bag is whole for each document; words are not used up.
    """
    own = docs.select(key, F.explode(tx.words(F.lower(text))).alias("word")).groupBy(key, "word").agg(F.count("*").alias("c"))
    both = own.join(known, "word", "left").groupBy(F.col(key).alias("_k")).agg(F.sum("c").alias("words"), F.sum(F.least("c", F.coalesce("n", F.lit(0)))).alias("shared"))
    joined = docs.select(key).join(both, F.col(key) == F.col("_k"), "left")
    total = F.coalesce("words", F.lit(0))
    return joined.select(key, total.alias("words"), ratio(F.coalesce("shared", F.lit(0)), total).alias("lexical"))


def judged(docs: DataFrame, other: DataFrame, key: str = "doc_id", text: str = "text", n: int = N) -> DataFrame:
    """Coverage of each document by ``other`` with its verdict."""
    grams = ngram_coverage(docs, reference(other, text, n), key, text, n)
    words = lexical_coverage(docs, bag(other, text), key, text).withColumnRenamed(key, "_w")
    joined = grams.join(words, F.col(key) == F.col("_w")).drop("_w")
    doubtful = tx.suspect(F.col("total"), F.col("total") - F.col("n_only"))
    return joined.withColumn("suspect", doubtful).withColumn("verdict", tx.verdict(F.col("coverage"), F.col("lexical"), doubtful))


def runs(positions: DataFrame, key: str, pos: str, gap: int = 200) -> DataFrame:
    """Positions less than ``gap`` apart make a run: (key, run, first, last, n)."""
    order = Window.partitionBy(key).orderBy(pos)
    opens = F.when(F.col(pos) - F.lag(pos).over(order) >= gap, 1).otherwise(0)
    numbered = positions.withColumn("_o", opens).withColumn("run", F.sum("_o").over(order.rowsBetween(Window.unboundedPreceding, 0)) + 1)
    return numbered.groupBy(key, "run").agg(F.min(pos).alias("first"), F.max(pos).alias("last"), F.count("*").alias("n"))
