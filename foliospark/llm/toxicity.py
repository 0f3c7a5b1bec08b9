"""Toxicity scores: boosted trees over dense text features, calibrated by isotonic regression.

The features of a text are densities of a learned lexicon (whole words and word
beginnings, after digits and signs that stand for letters are read as such),
nearness of lexicon words to second-person words, and rates of capitals,
punctuation and obfuscated words. Lexicon and trees are learned on a bounded
sample of labelled rows (``SAMPLE``); lexicons are cross-fitted, so a row's
features never come from a lexicon that saw its label, and the calibration is
learned on predictions for rows that the trees did not see. Scoring is one
pass without a shuffle.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm import common
from foliospark.llm.trees import Trees, isotonic

#: At most so many labelled rows are learned from: those with the lowest hash of doc_id.
SAMPLE = 12_000
FOLDS = 4
#: A lexicon's terms: in so many toxic rows at least, with log odds and a log-likelihood ratio above these.
ROWS, ODDS, SURPRISE = 3, 1.5, 15
NEAR = 5
THRESHOLD = 0.7
# Second-person words in English, German, French and Spanish.
SECOND_PERSON = frozenset("you your yours yourself yourselves u ur du dich dir dein deine deinen deinem deiner ihr euch euer sie tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros tus".split())
# Signs that are written for letters.
LOOKALIKE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})


def letters(word: str) -> tuple[str, bool]:
    """The word in small letters, signs within it read as letters; whether it was obfuscated."""
    a, b = 0, len(word)
    while a < b and not word[a].isalnum() and word[a] not in "@$":
        a += 1
    while b > a and not word[b - 1].isalnum():
        b -= 1
    core = word[a:b].lower()
    if core.isalpha():
        return core, False
    if not any(c.isalpha() for c in core):
        return "", False
    read = "".join(c for c in core.translate(LOOKALIKE) if c.isalpha())
    inner = "".join(c for c in core if c not in "-'’")
    return read, not inner.isalpha()


def terms(text: str) -> set[str]:
    """Distinct lexicon candidates of a text: words, and beginnings marked by their length."""
    out = set()
    for w in set(text.split()):
        core = letters(w)[0]
        if len(core) >= 2:
            out.add(core)
            out.update(f"{n}{core[:n]}" for n in (4, 5, 6) if len(core) > n)
    return out


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in common.slices(batches, "text", 1 << 20):
        for text, fold, toxic in zip(common.column(batch, "text").to_pylist(), common.column(batch, "fold").to_pylist(), common.column(batch, "toxic").to_pylist(), strict=True):
            found = list(terms(text or ""))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([fold] * len(found), pa.int32()), pa.array([toxic] * len(found), pa.int32())], names=["term", "fold", "toxic"])


N_FEATURES = 15


def features(texts: pa.Array, lexicon: dict[str, float]) -> np.ndarray:
    """Rows of ``N_FEATURES`` numbers; zeros for null and empty texts."""
    texts = pc.fill_null(texts, "")
    listed = pc.ascii_split_whitespace(texts)
    offsets = listed.offsets.to_numpy().astype(np.int64)
    flat = listed.values.slice(offsets[0], offsets[-1] - offsets[0])
    offsets = offsets - offsets[0]
    n = len(texts)
    out = np.zeros((n, N_FEATURES))
    if not len(flat):
        return out
    coded = flat.dictionary_encode()
    facts = []  # of each distinct word
    for w in coded.dictionary.to_pylist():
        core, odd = letters(w)
        starts = max((lexicon.get(f"{k}{core[:k]}", 0.0) for k in (4, 5, 6) if len(core) > k), default=0.0)
        capitals = sum(map(str.isupper, w))
        facts.append((bool(w), lexicon.get(core, 0.0), starts, core in SECOND_PERSON, odd, capitals, sum(map(str.isalpha, w)), sum(not c.isalnum() for c in w), w.count("!") + w.count("?"), capitals > 1 and w.isupper(), len(w)))
    fact = np.array(facts, np.float64)[coded.indices.to_numpy()]
    row = np.repeat(np.arange(n), np.diff(offsets))
    total = np.stack([np.bincount(row, fact[:, c], n) for c in range(fact.shape[1])], axis=1)
    words, size, alphas = np.maximum(total[:, 0], 1), np.maximum(total[:, 10], 1), np.maximum(total[:, 6], 1)
    hit, start = fact[:, 1] > 0, fact[:, 2] > 0
    hits, starts = np.bincount(row, hit, n), np.bincount(row, start & ~hit, n)
    highest = np.zeros((n, 2))
    np.maximum.at(highest[:, 0], row, fact[:, 1])
    np.maximum.at(highest[:, 1], row, fact[:, 2])
    place, person = np.arange(len(row)), np.flatnonzero(fact[:, 3])
    near = np.zeros(len(row), bool)
    if len(person):
        after = np.searchsorted(person, place)
        for other in (person[np.maximum(after - 1, 0)], person[np.minimum(after, len(person) - 1)]):
            near |= (np.abs(other - place) <= NEAR) & (row[other] == row)
    out[:, 0] = np.log1p(total[:, 0])
    out[:, 1], out[:, 2], out[:, 3], out[:, 4] = 100 * hits / words, np.log1p(hits), highest[:, 0], np.log1p(total[:, 1])
    out[:, 5], out[:, 6], out[:, 7], out[:, 8] = 100 * starts / words, np.log1p(starts), highest[:, 1], np.log1p(total[:, 2])
    out[:, 9] = np.log1p(np.bincount(row, near & (hit | start), n))
    out[:, 10], out[:, 11], out[:, 12] = total[:, 5] / alphas, total[:, 7] / size, total[:, 8] / size
    out[:, 13], out[:, 14] = total[:, 9] / words, total[:, 4] / words
    return out


def _features(shared):
    """Features of sampled rows; ``shared`` has a lexicon for each fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            fold = common.column(batch, "fold").to_numpy()
            made = np.zeros((batch.num_rows, N_FEATURES))
            for f in np.unique(fold).tolist():
                rows = np.flatnonzero(fold == f)
                made[rows] = features(common.column(batch, "text").take(pa.array(rows)), shared.value[f])
            yield pa.RecordBatch.from_arrays([common.column(batch, "fold"), common.column(batch, "toxic"), pa.array(list(made), pa.list_(pa.float64()))], names=["fold", "toxic", "features"])

    return run


def _telling(counts: list[tuple[str, np.ndarray, np.ndarray]], toxic: np.ndarray, clean: np.ndarray, without: int | None) -> dict[str, float]:
    """Terms that tell toxic rows, weighed by their log odds; ``without``: a fold whose counts are left out."""
    use = np.arange(FOLDS) != (-1 if without is None else without)
    nt, nc = toxic[use].sum(), clean[use].sum()
    if not nt or not nc or not counts:
        return {}
    t, c = np.array([x[1][use].sum() for x in counts], float), np.array([x[2][use].sum() for x in counts], float)
    odds = np.log((t + 0.5) / (nt + 1)) - np.log((c + 0.5) / (nc + 1))
    share, of = nt / (nt + nc), np.maximum(t + c, 1)
    surprise = 2 * (t * np.log(np.maximum(t, 1e-9) / of / share) + c * np.log(np.maximum(c, 1e-9) / of / (1 - share)))
    return {counts[i][0]: float(odds[i]) for i in np.flatnonzero((t >= ROWS) & (odds > ODDS) & (surprise > SURPRISE))}


def _told(toxic: np.ndarray, clean: np.ndarray, without: int | None) -> Column:
    """Whether a row of counts (n1_<fold>, n0_<fold>) passes the test of :func:`_telling`, or nearly so."""
    use = [f for f in range(FOLDS) if f != without]
    nt, nc = int(toxic[use].sum()), int(clean[use].sum())
    if not nt or not nc:
        return F.lit(False)
    t, c = (sum((F.col(f"n{k}_{f}") for f in use[1:]), F.col(f"n{k}_{use[0]}")).cast("double") for k in (1, 0))
    odds = F.log((t + 0.5) / (nt + 1)) - F.log((c + 0.5) / (nc + 1))
    share, of = nt / (nt + nc), F.greatest(t + c, F.lit(1.0))
    part = lambda n, s: n * F.log(F.greatest(n, F.lit(1e-9)) / of / s)
    return (t >= ROWS) & (odds > ODDS - 1e-6) & (2 * (part(t, share) + part(c, 1 - share)) > SURPRISE - 1e-6)


class Model:
    """What scoring needs: a lexicon, trees and a calibration (or a constant, where labels have one kind only)."""

    def __init__(self, lexicon: dict[str, float], trees: Trees | None, curve, constant: float):
        self.lexicon, self.trees, self.curve, self.constant = lexicon, trees, curve, constant

    def score(self, texts: pa.Array) -> np.ndarray:
        if self.trees is None:
            return np.full(len(texts), self.constant)
        raw = self.trees.predict(features(texts, self.lexicon))
        # a trace of the raw score keeps the order within the steps of the calibration
        return np.clip(0.999 * np.interp(raw, *self.curve) + 0.001 * raw, 0.0, 1.0)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from ``labels`` (doc_id, toxic) of ``docs``; give it only rows that may be learned from."""
    spark = docs.sparkSession
    known = labels.select(F.col("doc_id").cast("long").alias("lid"), F.col("toxic").cast("int").alias("toxic")).where("lid is not null and toxic in (0, 1)").groupBy("lid").agg(F.max("toxic").alias("toxic"))
    known = common.table(known.orderBy(F.xxhash64("lid"), "lid").limit(sample), "labelled")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), F.col("doc_id") == F.col("lid"))  # at most `sample` rows are broadcast
    fold = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(FOLDS)).cast("int")  # copies share a fold
    rows = common.table(texts.select("doc_id", "text", "toxic", fold.alias("fold")).dropDuplicates(["text", "toxic"]), "sample")
    sizes = {(r["fold"], r["toxic"]): r["n"] for r in rows.groupBy("fold", "toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = (np.array([sizes.get((f, k), 0) for f in range(FOLDS)]) for k in (1, 0))
    if not toxic.sum() or not clean.sum():
        return Model({}, None, None, float(toxic.sum() > 0))
    of = lambda f, k: F.sum(F.when((F.col("fold") == f) & (F.col("toxic") == k), 1).otherwise(0))
    found = rows.select("text", "fold", "toxic").mapInArrow(_terms, "term string, fold int, toxic int")
    found = found.groupBy("term").agg(*[of(f, k).alias(f"n{k}_{f}") for k in (0, 1) for f in range(FOLDS)])
    # the terms that any fold's lexicon or the whole one takes: at most those of the sample's toxic documents
    told = functools.reduce(Column.__or__, [_told(toxic, clean, without) for without in (None, *range(FOLDS))])
    top = found.where(told).select("term", *[f"n{k}_{f}" for k in (0, 1) for f in range(FOLDS)]).collect()
    counts = [(r["term"], np.array([r[f"n1_{f}"] for f in range(FOLDS)]), np.array([r[f"n0_{f}"] for f in range(FOLDS)])) for r in top]
    lexicons = {f: _telling(counts, toxic, clean, f) for f in range(FOLDS)}
    made = rows.select("text", "fold", "toxic").mapInArrow(_features(spark.sparkContext.broadcast(lexicons)), "fold int, toxic int, features array<double>").toPandas()
    x, y, fold_of = np.array(made["features"].tolist()).reshape(-1, N_FEATURES), made["toxic"].to_numpy(float), made["fold"].to_numpy()
    unseen = np.zeros(len(y))
    for f in range(FOLDS):
        own = fold_of == f
        if own.any():
            unseen[own] = Trees().fit(x[~own], y[~own]).predict(x[own]) if (~own).any() else y.mean()
    return Model(_telling(counts, toxic, clean, None), Trees().fit(x, y), isotonic(unseen, y), float(y.mean()))


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.slices(batches, "text"):
            keep = [n for n in batch.schema.names if n != "text"]
            made = shared.value.score(common.column(batch, "text"))
            yield pa.RecordBatch.from_arrays([*[common.column(batch, n) for n in keep], pa.array(made)], names=[*keep, "score"])

    return run


def scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``.

    Rows whose crc32(doc_id as text) mod 3 is 1 are held out: their labels are
    not learned from. ``predicted`` is 1 where the score is at least 0.7.

    Null and empty texts have features of zero and get a score like any other
    text. All rows stay, repeated ones too; a null doc_id counts as not held
    out. With no labelled rows, or one kind of label only, every score is that
    kind (0 without labels). Labels other than 0 and 1 and labels of unknown
    documents are left out; of several labels of a document the highest counts.
    Only ``doc_id``, ``text`` and ``toxic`` are read.
    """
    spark = docs.sparkSession
    common.lean(spark)
    remainder = lambda c: F.crc32(F.col(c).cast("string")) % 3
    model = fit(docs, labels.where(remainder("doc_id") != 1), sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = rows.mapInArrow(_score(spark.sparkContext.broadcast(model)), "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(remainder("doc_id") == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` without the documents that :func:`scores` predicts as toxic."""
    return common.restrict(docs, scores(docs, labels, sample).where("predicted = 1"), "doc_id", "doc_id", "left_anti")
