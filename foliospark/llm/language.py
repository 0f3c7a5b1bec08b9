"""Language identification as inference over mixtures of languages.

Each language is a distribution over hashed letter trigrams. For a document,
expectation-maximisation estimates in what proportions the languages made its
trigrams; the set of languages is the one whose penalised likelihood (that of
the m strongest languages, less a charge for each) is best, and the prediction
is the language with the largest share in that set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm import common

#: So many documents of each language are learned from (about; those of lowest hash), on whole texts.
SAMPLE = 4_000
BITS = 16
STEPS = 10
PENALTY = 2.0

_FOLD: list[np.ndarray] = []


def _fold() -> np.ndarray:
    """For each code point its small letter, or 32 if it is no letter."""
    if not _FOLD:
        table = np.full(0x110000, 32, np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _FOLD.append(table)
    return _FOLD[0]


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, count) of distinct trigrams, and which rows have a letter.

    Letters are folded to small ones, everything between them is one space.
    """
    texts = pc.fill_null(texts, "").to_pylist()
    n = len(texts)
    size = np.array([len(t) + 2 for t in texts], np.int64)
    code = _fold()[np.frombuffer("".join(f" {t} " for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)]
    row = np.repeat(np.arange(n), size)
    letter = code != 32
    has = np.bincount(row, letter, n) > 0
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first blank after a letter
    keep[np.cumsum(size) - size] = True  # and the first of a text
    code, row = code[keep].astype(np.uint64), row[keep]
    if len(code) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32), has
    hashed = common.mix((code[:-2] << np.uint64(42)) ^ (code[1:-1] << np.uint64(21)) ^ code[2:]) >> np.uint64(64 - BITS)
    same = row[2:] == row[:-2]
    key, count = np.unique((row[2:][same].astype(np.uint64) << np.uint64(BITS)) | hashed[same], return_counts=True)
    return (key >> np.uint64(BITS)).astype(np.int64), (key & np.uint64(2**BITS - 1)).astype(np.int64), count.astype(np.float32), has


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in common.slices(batches, "text"):
        row, bucket, count, _ = trigrams(common.column(batch, "text"))
        lang = np.array(common.column(batch, "lang").to_pylist(), object)
        for name in set(lang.tolist()):
            own = (lang == name)[row]
            total[name] = total.get(name, 0) + np.bincount(bucket[own], count[own], 2**BITS)
    for name, counts in total.items():
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(some), pa.string()), pa.array(some), pa.array(counts[some])], names=["lang", "bucket", "n"])


class Model:
    def __init__(self, names: list[str], p: np.ndarray):
        self.names, self.p = names, p  # p: buckets x languages

    def _shares(self, row: np.ndarray, count: np.ndarray, p: np.ndarray, total: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """EM for all rows at once: (shares, log likelihood). ``row`` is sorted; ``allowed`` marks the languages of each row."""
        share = allowed / allowed.sum(axis=1, keepdims=True)
        begin = np.flatnonzero(np.diff(row, prepend=-1))
        present = row[begin]
        for _ in range(STEPS):
            part = p * share[row].astype(np.float32)
            part *= (count / part.sum(axis=1))[:, None]
            new = np.zeros_like(share)
            new[present] = np.add.reduceat(part, begin, axis=0, dtype=np.float64) / total[present, None]
            done = np.abs(new - share).max(initial=0) < 1e-3
            share = new
            if done:
                break
        loglik = np.zeros(len(share))
        loglik[present] = np.add.reduceat(count * np.log(np.maximum((p * share[row].astype(np.float32)).sum(axis=1), 1e-30)), begin, dtype=np.float64)
        return share, loglik

    def mixtures(self, texts: pa.Array) -> list[list[tuple[str, float]]]:
        """The selected languages of each text with their shares, largest first; none where nothing tells."""
        row, bucket, count, has = trigrams(texts)
        n, k = len(texts), len(self.names)
        if not k:
            return [[]] * n
        chosen, selected = np.zeros((n, k)), np.zeros((n, k), bool)
        if len(row):
            p = self.p[bucket]
            total = np.maximum(np.bincount(row, count, n), 1e-9)
            share, _ = self._shares(row, count, p, total, np.ones((n, k)))
            order = np.argsort(-share, axis=1, kind="stable")
            value = np.full(n, -np.inf)
            open_rows = np.ones(n, bool)
            for m in range(1, k + 1):
                if m > 1:  # a language with hardly a share can't pay its charge
                    open_rows &= share[np.arange(n), order[:, m - 1]] >= 0.02
                if not open_rows.any():
                    break
                at = open_rows[row]
                allowed = np.zeros((n, k))
                np.put_along_axis(allowed, order[:, :m], 1.0, axis=1)
                of, loglik = self._shares(row[at], count[at], p[at], total, allowed)
                now = loglik - PENALTY * (m - 1) * np.log(total + 1)
                better = open_rows & (now > value)
                value[better] = now[better]
                chosen[better], selected[better] = of[better], allowed[better] > 0
        chosen, order = np.clip(chosen, 0.0, 1.0), np.argsort(-chosen, axis=1, kind="stable")
        return [[(self.names[j], own[j]) for j in by if some[j]] if h else [] for own, some, by, h in zip(chosen.tolist(), selected.tolist(), order.tolist(), has.tolist(), strict=True)]


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Trigram distributions for each ``lang`` of ``docs`` (doc_id, text, lang)."""
    known = docs.where("lang is not null and text is not null and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros((2**BITS, 0), np.float32))
    names = sorted(sizes)
    share = F.create_map(*[x for name in names for x in (F.lit(name), F.lit(min(1.0, sample / sizes[name])))])
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))
    rows = chosen.select("text", "lang").mapInArrow(_counts, "lang string, bucket long, n double").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((2**BITS, len(names)))
    np.add.at(counts, (rows["bucket"].to_numpy(np.int64), np.searchsorted(names, rows["lang"].to_numpy(str)) if len(rows) else np.zeros(0, np.int64)), rows["n"].to_numpy(float))
    return Model(names, ((counts + 0.1) / (counts.sum(axis=0) + 0.1 * 2**BITS)).astype(np.float32))


_LANGUAGES = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))


def _mixtures(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text", 1 << 20):
            found = shared.value.mixtures(common.column(batch, "text"))
            languages = [[{"lang": lang, "share": share} for lang, share in some] for some in found]
            yield pa.RecordBatch.from_arrays([common.column(batch, "doc_id"), pa.array(languages, _LANGUAGES)], names=["doc_id", "languages"])

    return run


def mixtures(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, languages) for each row of ``docs``.

    ``languages``: the selected set as (lang, share) in falling order of
    shares, which add up to 1.

    Rows whose crc32(doc_id as text) mod 3 is 1 are held out of learning.

    Null texts and texts without a letter have no languages, nor has any text
    where nothing could be learned. A null doc_id is not held out and not
    learned from. All rows stay, repeated ones too. Only ``doc_id``, ``text``
    and ``lang`` are read.
    """
    common.lean(docs.sparkSession)
    remainder = F.crc32(F.col("doc_id").cast("string")) % 3
    model = fit(docs.where(remainder != 1), sample)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_mixtures(shared), "doc_id long, languages array<struct<lang string, share double>>")
    return out.select("doc_id", F.coalesce(remainder == 1, F.lit(False)).alias("held_out"), "languages")


def predict(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of :func:`mixtures`: the language of the largest share, and that share.

    Texts without languages are ``und`` with score 0.
    """
    top = F.get("languages", F.lit(0))
    return mixtures(docs, sample).select("doc_id", "held_out", F.coalesce(top["lang"], F.lit("und")).alias("lang_pred"), F.coalesce(top["share"], F.lit(0.0)).alias("score"))
