"""Periodic runs of words, by Kolpakov and Kucherov's method.

A run is a stretch of words with smallest period q and a length of
``max(6, 4 * q)`` or more that no neighbouring word extends with that period.

1. LZ factorisation, from a suffix automaton: each factor is the longest
   stretch that begins earlier too, or a new word.
2. Main's algorithm: a run whose last word is in a factor and that begins
   before it reaches less than the factor before it and one period to the left
   (else that factor would have been longer). So the runs that touch a border
   of factors are found from common extensions of both sides, within a window.
3. Runs strictly inside a factor are copied from its earlier occurrence.

Words enter the factorisation only where they can be in a run: each group of
four consecutive words of a run stands in it twice, so a document is first cut
where a group stands only once in it. Equal groups have equal fingerprints, so
no run is lost; other texts with equal fingerprints cost time only.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm import common
from foliospark.llm.common import U64

#: A run has this many periods, and this many words, at least.
EXPONENT, LEAST = 4, 6
GROUP = 4


def factors(word: Sequence[int]) -> list[tuple[int, int, int]]:
    """(start, length, start of the earlier occurrence) of each factor; -1 for a new word."""
    follow: list[dict[int, int]] = [{}]
    link, length, first_end = [-1], [0], [-1]
    last = 0
    for i, c in enumerate(word):
        new = len(follow)
        follow.append({})
        link.append(0)
        length.append(length[last] + 1)
        first_end.append(i)
        p = last
        while p >= 0 and c not in follow[p]:
            follow[p][c] = new
            p = link[p]
        if p >= 0:
            q = follow[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(follow)
                follow.append(dict(follow[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                first_end.append(first_end[q])
                while p >= 0 and follow[p].get(c) == q:
                    follow[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    out, i, n = [], 0, len(word)
    while i < n:
        state, j = 0, i
        while j < n:
            to = follow[state][word[j]]
            if first_end[to] >= j:
                break
            state, j = to, j + 1
        out.append((i, j - i, first_end[state] - (j - i) + 1) if j > i else (i, 1, -1))
        i = max(j, i + 1)
    return out


def extensions(word: Sequence[int]) -> list[int]:
    """For each place, how many words from there on equal the beginning."""
    n = len(word)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and word[k] == word[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def _touching(word: Sequence[int], border: int, before: int, after: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, period) of runs that touch ``border``, between factors of ``before`` and ``after`` words, and end in the latter."""
    most = (before + after - 1) // (EXPONENT - 1)
    if most < 1:
        return
    low, high = max(0, border - before - most), border + after
    left, right = list(word[low:border]), list(word[border:high])
    both, n, a, b = left + right, len(word), border - low, after
    ahead = extensions(right)
    behind = extensions(left[::-1])
    ahead_of_left = extensions([*right, -1, *both])[b + 1 :]  # at each place of both, what it has in common with right
    behind_right = extensions([*left[::-1], -1, *both[::-1]])[a + 1 :]
    for q in range(1, most + 1):
        found = []
        if q <= a:  # the period lies left of the border
            found.append((border - q - (behind[q] if q < a else 0), border + min(ahead_of_left[a - q], b)))
        if q <= b:  # or right of it
            found.append((border - behind_right[b - q], border + q + (ahead[q] if q < b else 0)))
        for start, end in found:
            if end - start < max(LEAST, EXPONENT * q) or end < border:
                continue
            if (start and word[start - 1] == word[start - 1 + q]) or (end < n and word[end] == word[end - q]):
                continue  # goes on beyond the window: it is found at another border
            yield start, end, q


def runs(word: Sequence[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of ``word``, by start, then period."""
    found: dict[tuple[int, int], int] = {}
    begun: dict[int, list[int]] = defaultdict(list)  # ends by start

    def add(start: int, end: int, period: int) -> None:
        if (start, end) not in found:
            begun[start].append(end)
            found[start, end] = period
        elif period < found[start, end]:
            found[start, end] = period

    before = 0
    for start, length, earlier in factors(word):
        for run in _touching(word, start, before, length):
            add(*run)
        if earlier >= 0 and length > LEAST:
            shift = start - earlier
            for place in range(earlier + 1, earlier + length - LEAST):
                for end in list(begun.get(place, ())):
                    if end < earlier + length:
                        add(place + shift, end + shift, found[place, end])
        before = length
    for run in _touching(word, len(word), before, 0):
        add(*run)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def _stretches(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last word (exclusive) of the stretches in which runs can be; they cross no border of documents."""
    n = len(codes) - GROUP + 1
    if n < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    key = common.mix(doc[:n].astype(U64) + U64(0x9E3779B97F4A7C15))
    for i in range(GROUP):
        key = common.mix(key + codes[i : i + n].astype(U64))
    order = np.argsort(key, kind="stable")
    same = np.concatenate([[False], key[order][1:] == key[order][:-1], [False]])
    twice = np.zeros(n, bool)
    twice[order] = same[1:] | same[:-1]
    twice &= doc[:n] == doc[GROUP - 1 :]
    begins = twice.copy()
    begins[1:] &= ~twice[:-1] | (doc[1:n] != doc[: n - 1])
    ends = twice.copy()
    ends[:-1] &= ~twice[1:] | (doc[1:n] != doc[: n - 1])
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + GROUP
    long = last - first >= LEAST
    return first[long], last[long]


def words(texts: pa.Array) -> pa.ListArray:
    """Words of each text: runs of characters other than space and \\x09-\\x0D. Null texts have none."""
    listed = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    offsets = listed.offsets.to_numpy().astype(np.int64)
    flat = listed.values.slice(offsets[0], offsets[-1] - offsets[0])
    offsets = offsets - offsets[0]
    kept = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate([[0], np.cumsum(kept.to_numpy(zero_copy_only=False))])
    return pa.ListArray.from_arrays(pa.array(before[offsets], pa.int32()), flat.filter(kept))


_RUNS = "array<struct<start:long,length:long,period:long>>"


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
    for batch in common.slices(batches, "text"):
        listed = words(common.column(batch, "text"))
        offsets = listed.offsets.to_numpy().astype(np.int64)
        codes = listed.values.dictionary_encode().indices.to_numpy().astype(np.int64)
        told: list[list[dict[str, int]]] = [[] for _ in range(len(listed))]
        dropped = np.zeros(len(codes) + 1, np.int64)
        for first, last in zip(*(x.tolist() for x in _stretches(codes, offsets)), strict=True):
            doc = int(np.searchsorted(offsets, first, side="right")) - 1
            for start, length, period in runs(codes[first:last].tolist()):
                told[doc].append({"start": first - int(offsets[doc]) + start, "length": length, "period": period})
                dropped[first + start + period] += 1
                dropped[first + start + length] -= 1
        left = np.cumsum(dropped[:-1]) == 0
        before = np.concatenate([[0], np.cumsum(left)])
        rest = pa.ListArray.from_arrays(pa.array(before[offsets], pa.int32()), listed.values.filter(pa.array(left)))
        yield pa.RecordBatch.from_arrays(
            [common.column(batch, "doc_id"), pa.array(np.diff(offsets)), pa.array(told, kind), pc.binary_join(rest, " ")],
            names=["doc_id", "n_words", "runs", "collapsed"],
        )


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for each row of ``docs``.

    ``runs``: structs (start, length, period) in words, by start, then period;
    ``collapsed``: the words that no run holds after its first period, joined
    by one space. Null and empty texts have no words, no runs and an empty
    collapsed text. All rows stay, repeated ones too; texts of any length are
    taken whole, in time that grows with their length. Only ``doc_id`` and
    ``text`` are read.
    """
    common.lean(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_found, f"doc_id long, n_words long, runs {_RUNS}, collapsed string")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, in which a tenth of the documents (by h = crc32 of the doc_id's digits) go on periodically from a word on.

    With g = floor(h / 10): where h % 10 = 0 each word i >= a becomes word
    a + (i - a) % p, a = g % n, p = 1 + floor((n - a) / (3 + g % 8)), words
    joined by one space. Other texts, null ones and those without a doc_id stay.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    listed = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, listed).alias("w")).withColumn("n", F.size("w"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n"))).withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    shown = F.transform("w", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("w", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(shown, " ")).otherwise(F.col("text")).alias("text"))


def digests(docs: DataFrame) -> DataFrame:
    """For each row: n_runs, the run of the greatest exponent, and digests of all runs and of the collapsed text.

    Of several runs of the greatest length / period the one of the smallest
    start, then period, is told; without runs its four columns are null. Rows
    as of :func:`periodic_runs`.
    """
    found = periodic_runs(docs)

    def better(best: Column, x: Column) -> Column:
        return F.when(best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"]), x).otherwise(best)

    top = F.aggregate("runs", F.lit(None).cast("struct<start:long,length:long,period:long>"), better)
    told = F.array_join(F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n"))), "")
    out = found.withColumn("top", top)
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"), F.col("top.length").alias("length"), F.col("top.period").alias("period"),
        F.floor(1000 * F.col("top.length") / F.col("top.period")).cast("long").alias("exponent_milli"), F.sha2(told, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
