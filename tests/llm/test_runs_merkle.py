"""Periodic runs against a search of every period, the Merkle manifest against a fold in Python."""

import hashlib
import os
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from foliospark.llm import merkle, queries
from foliospark.llm import runs as periodic
from tests.llm.test_llm import DOCS, ODD, docs, none, odd  # noqa: F401

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def split(text):
    return re.findall(r"[^\x20\x09-\x0d]+", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --------------------------------------------------------------------- runs
def every_run(word):
    """(start, length, period), each period tried over the whole text."""
    out, n = [], len(word)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and word[i] == word[i + q]:
                i += 1
            end = i + q
            if i > start and end - start >= max(6, 4 * q) and not any(word[start : end - p] == word[start + p : end] for p in range(1, q)):
                out.append((start, end - start, q))
            i += 1
    return sorted(out)


def planted(doc_id, word):
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is None or h % 10 or not word:
        return word
    g, n = h // 10, len(word)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else word[a + (i - a) % p] for i, w in enumerate(word)]


def slow_row(doc_id, text):
    word = planted(doc_id, split(text))
    found = every_run(word)
    kept = [w for i, w in enumerate(word) if not any(s + q <= i < s + n for s, n, q in found)]
    top = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else (None, None, None)
    milli = None if top[0] is None else 1000 * top[1] // top[2]
    return (doc_id, len(found), *top, milli, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(kept)))


def test_runs_of_random_words_equal_a_search_of_every_period():
    rng = random.Random(3)
    for _ in range(4000):
        k, n, word = rng.choice([1, 2, 2, 3, 5]), rng.randrange(80), []
        while len(word) < n:
            word += [rng.randrange(k) for _ in range(rng.randrange(1, 6))] * rng.randrange(1, 9)
            if word and rng.random() < 0.3:
                a = rng.randrange(len(word))
                word += word[a : a + rng.randrange(1, 40)]
        assert periodic.runs(word) == every_run(word), word


def test_factors_are_the_longest_that_begin_earlier():
    rng = random.Random(5)
    for _ in range(500):
        word = [rng.randrange(3) for _ in range(rng.randrange(40))]
        at = 0
        for start, length, earlier in periodic.factors(word):
            assert start == at
            at += length
            if earlier >= 0:
                assert earlier < start and word[earlier : earlier + length] == word[start : start + length]
                assert at == len(word) or not any(word[i : i + length + 1] == word[start : at + 1] for i in range(start))
            else:
                assert length == 1 and word[start] not in word[:start]
        assert at == len(word)


def test_runs_of_documents(spark):
    rng = random.Random(7)
    blocks = [" ".join(rng.choice("abc") for _ in range(rng.randrange(1, 6))) + " " for _ in range(20)]
    texts = ["".join(rng.choice(blocks) * rng.randrange(1, 8) for _ in range(rng.randrange(8))) for _ in range(150)]
    df = docs(spark, texts + ["a\tb\x0bA b " * 4, "é " * 6, "one line\n" * 5])
    got = sorted(map(tuple, queries.runs.digests(periodic.with_planted_runs(df)).collect()))
    assert got == sorted(slow_row(r.doc_id, r.text) for r in df.collect())
    assert sum(1 for r in got if r[1] > 1) > 20


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_the_query_equals_the_slow_version_on_whole_texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    short = {r.doc_id for r in rows if len(split(r.text)) <= 600}
    got = {r.doc_id: tuple(r) for r in queries.op11_periodic_runs(spark, SF).collect()}
    assert len(got) == len(rows) and len(short) > 100
    assert [got[r.doc_id] for r in rows if r.doc_id in short] == [slow_row(r.doc_id, r.text) for r in rows if r.doc_id in short]


def test_runs_of_odd_rows(odd, none):  # noqa: F811
    got = periodic.digests(periodic.with_planted_runs(odd)).collect()
    assert len(got) == len(ODD) + 1
    empty = [tuple(r) for r in got if r.doc_id in (0, 1, 2)]
    assert [r[1:] for r in empty] == [(0, None, None, None, None, sha(""), sha(""))] * 3
    long = [r for r in got if r.doc_id in (5, 6)]
    assert all((r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (1, 0, 30000, 1, 30000000) and r.collapsed_sha256 == sha("lorem") for r in long)
    assert periodic.digests(periodic.with_planted_runs(none)).collect() == []


# ------------------------------------------------------------------- merkle
def slow_manifest(rows):
    """Rows of the audit, folded in Python. ``rows``: (doc_id, source, lang, n_chars, text)."""

    def leaf(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def up(nodes, paths):
        """The root of ``nodes`` (digest, ids of leaves); siblings are added to the paths."""
        while len(nodes) > 1:
            level = []
            for at in range(0, len(nodes), 16):
                run = nodes[at : at + 16]
                for i, (_, ids) in enumerate(run):
                    for x in ids:
                        paths[x].append(("".join(d for d, _ in run[:i]), "".join(d for d, _ in run[i + 1 :])))
                level.append((sha("".join(d for d, _ in run)), [x for _, ids in run for x in ids]))
            nodes = level
        return nodes[0]

    leaves = [leaf(r) for r in rows]
    paths, groups, subroot = [[] for _ in rows], [], {}
    for source in sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode())):
        of = sorted((i for i, r in enumerate(rows) if r[1] == source), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, leaves[i]))
        groups.append(up([(leaves[i], [i]) for i in of], paths))
        subroot |= dict.fromkeys(of, groups[-1][0])
    root = up(groups, paths)[0] if rows else None
    out = []
    for i, (doc_id, source, lang, n_chars, text) in enumerate(rows):
        node = leaves[i]
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0:
            node = leaf((doc_id, source, lang, n_chars, text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)))
        for left, right in paths[i]:
            node = sha(left + node + right)
        out.append((doc_id, leaves[i], subroot[i], root, sha("".join(a + b for a, b in paths[i])), node, node == root))
    return out


def audited(df):
    return sorted(map(tuple, merkle.audit(df).collect()), key=repr)


def expected(df):
    return sorted(slow_manifest([tuple(r) for r in df.select(*merkle.FIELDS).collect()]), key=repr)


@pytest.mark.parametrize("n,sources", [(1, 1), (5, 1), (17, 2), (300, 3), (60, 40)])
def test_manifest_equals_a_fold(spark, n, sources):
    rng = random.Random(n)
    names = [None, "ü", "", "Z", *(f"s{i}" for i in range(sources))]
    df = spark.createDataFrame([(i * 7 % 1000, rng.choice(["Ab É", "", None, "x" * rng.randrange(50)]), rng.choice(["en", None]), names[rng.randrange(sources)] if i % 3 else "hot", rng.choice([None, i])) for i in range(n)], DOCS)
    got = audited(df)
    assert got == expected(df)


def test_a_changed_text_does_not_verify(spark):
    df = docs(spark, ["Some Text"] * 64)
    got = merkle.audit(df).collect()
    assert {r.doc_id for r in got if not r.verified} == {i for i in range(64) if zlib.crc32(str(i).encode()) % 5 == 0}


def test_manifest_of_odd_rows(odd, none):  # noqa: F811
    repeated = odd.unionByName(odd)
    assert audited(repeated) == expected(repeated)
    assert merkle.audit(none).collect() == []


def test_hot_group_is_spread(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    assert audited(df) == expected(df)
