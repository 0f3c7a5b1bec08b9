"""The n-gram trie: sequences against numpy, scores against counts in dictionaries, and its edge cases."""

import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliospark.llm import eliasfano, ngrams, queries
from foliospark.llm.eliasfano import Monotone
from tests.llm.test_llm import ODD, docs, none, odd  # noqa: F401

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("n,below", [(0, 10), (1, 1), (1, 2**64), (5, 5), (100, 1000), (1000, 50), (1000, 10**6), (3000, 2**64), (300, 2**63)])
def test_sequences(n, below, tmp_path):
    rng = random.Random(n)
    values = np.array(sorted(rng.randrange(below) for _ in range(n)), np.uint64)
    uri = f"file://{tmp_path}/a/b"
    eliasfano.save(uri, eliasfano.named("x", eliasfano.encode(values)) | {"other": np.arange(3, dtype=np.int32)})
    arrays = eliasfano.mapped(uri)
    assert arrays["other"].tolist() == [0, 1, 2]
    own = Monotone(eliasfano.split(arrays, "x"))
    assert own.take(np.arange(n)).tolist() == values.tolist()
    asked = np.array([*values.tolist(), *(min(v + 1, 2**64 - 1) for v in values.tolist()), 0, below - 1, 2**64 - 1, *(rng.randrange(2**64) for _ in range(50))], np.uint64)
    at, same = own.successor(asked)
    assert at.tolist() == np.searchsorted(values, asked).tolist()
    assert same.tolist() == np.isin(asked, values).tolist()


def test_sequences_are_compact():
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 40, 100_000, dtype=np.uint64))
    assert sum(x.nbytes for x in eliasfano.encode(values).values()) < 3.5 * len(values)


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(LOWER)), "\n"]


class Slow:
    """The same model over dictionaries, without quantisation."""

    def __init__(self, texts, order):
        self.order, self.counts, self.follow = order, Counter(), defaultdict(Counter)
        for text in texts:
            word = tokens(text)
            self.counts.update(word)
            for i, w in enumerate(word):
                for n in range(1, order):
                    context = (" ", *word)[max(0, i + 1 - n) : i + 1]
                    if len(context) == n:
                        self.follow[context][w] += 1
        self.total, self.distinct = sum(self.counts.values()), len(self.counts)

    def p(self, context, w):
        if not context:
            return (self.counts[w] + 1) / (self.total + self.distinct + 1)
        after, lower = self.follow.get(context), self.p(context[1:], w)
        if not after:
            return lower
        size = sum(after.values())
        return max(after[w] - ngrams.DISCOUNT, 0) / size + ngrams.DISCOUNT * len(after) / size * lower

    def row(self, text):
        word = tokens(text)
        base = sum(math.log10(self.p((), w)) for w in word)
        told = (" ", *word)
        score = 0.0
        for i, w in enumerate(word):
            n = max((n for n in range(self.order) if n <= i + 1 and (n == 0 or told[i + 1 - n : i + 1] in self.follow)), default=0)
            score += math.log10(self.p(told[i + 1 - n : i + 1], w))
        return len(word), sum(self.counts[w] > 0 for w in word), self.total, base, score


def check(df, order, near=0.02):
    rows = df.collect()
    slow = Slow([r.text for r in rows if r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 7 != 2], order)
    got = sorted(map(tuple, ngrams.scores(df, order).collect()), key=lambda r: (repr(r[:5]), r[6]))
    expected = sorted(((r.doc_id, r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 7 == 2, *slow.row(r.text)) for r in rows), key=lambda r: (repr(r[:5]), r[6]))
    for a, b in zip(got, expected, strict=True):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], abs=1e-9 * b[2])
        assert a[6] == pytest.approx(b[6], abs=near * b[2] + 1e-6), (a, b)
    return got


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores_equal_counts_in_dictionaries(spark, order, monkeypatch):
    monkeypatch.setattr(ngrams, "BLOCK", 2000)
    monkeypatch.setattr(ngrams, "FINE", 500)
    rng = random.Random(order)
    texts = [" ".join(("The" if rng.random() < 0.4 else f"w{int(rng.paretovariate(0.7)) % 300}") for _ in range(rng.randrange(60))) for _ in range(200)]
    got = check(docs(spark, [*texts, *texts[:30], "", None]), order)
    assert sum(r[1] for r in got) > 10


def test_probabilities_after_a_context_add_up_to_one(spark):
    rng = random.Random(9)
    texts = [" ".join(f"w{rng.randrange(12)}" for _ in range(20)) for _ in range(40)]
    model = ngrams.train(docs(spark, texts), 2)
    words = [f"w{i}" for i in range(12)]
    asked = docs(spark, [f"{a} {b}" for a in words for b in (*words, "unknown")] + words)
    got = {r.doc_id: r.score for r in ngrams.score(asked, model).collect()}
    slow = Slow(texts, 2)
    for i, a in enumerate(words):
        whole = 10 ** slow.row(a)[4] / slow.p((a,), "\n")  # of a beginning with a
        pairs = [10 ** got[13 * i + j] / slow.p((w,) if w != "unknown" else (), "\n") / whole for j, w in enumerate((*words, "unknown"))]
        assert sum(pairs) + slow.p((a,), "\n") == pytest.approx(1, abs=0.05)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_the_query_equals_the_slow_model_and_tells_held_out_texts_better_than_single_words(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    got = check(df, ngrams.ORDER)
    assert sorted(map(tuple, queries.op13_lm_scoring(spark, SF).select("doc_id", "n_tokens", "n_known").collect())) == sorted((r[0], r[2], r[3]) for r in got)
    out = [r for r in got if r[1]]
    assert len(out) > 10 and sum(r[6] for r in out) > sum(r[5] for r in out)


def test_odd_rows(odd, none):  # noqa: F811
    assert len(check(odd.unionByName(odd), 2)) == 2 * len(ODD) + 2
    assert ngrams.scores(none).collect() == []


def test_nothing_to_learn_from(spark):
    alone = docs(spark, ["a b"]).withColumn("doc_id", F.lit(next(i for i in range(99) if zlib.crc32(str(i).encode()) % 7 == 2)).cast("long"))
    (row,) = ngrams.scores(alone).collect()
    assert tuple(row)[1:] == (True, 3, 0, 0, 0.0, 0.0)


def test_a_word_of_a_third_of_all_tokens_is_spread(spark, monkeypatch):
    monkeypatch.setattr(ngrams, "FINE", 200)
    rng = random.Random(4)
    df = docs(spark, [" ".join(f"hot x{rng.randrange(500)} y{rng.randrange(9)}" for _ in range(30)) for _ in range(100)])
    check(df, 2)
    model = ngrams.train(df, 2)
    hot = model.numbers(np.array([ngrams.xxhash.xxh64_intdigest("hot")], np.uint64))[0]
    assert sum(p is not None and p.first <= hot <= p.last for p in model.levels[1].pieces) > 1
