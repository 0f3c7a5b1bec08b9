"""The pipeline on a small corpus, stage by stage."""

import hashlib
import random

import numpy as np

import __spark_entry__ as entry
import corpus_pipeline
from foliospark.llm import decontaminate, pieces
from foliospark.llm.queries import tokenizer
from tests.llm.test_llm import brute_components, brute_leaks, brute_repeats, chatter, docs, families, split, toxic_corpus


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{n}" for n in range(1, 14)}
    assert [n for n, _ in corpus_pipeline.STAGES][0] == "toxicity" and 4 <= len(corpus_pipeline.STAGES) <= 5


def test_stages(spark, tmp_path):
    rng = random.Random(11)
    d, labels = toxic_corpus(spark, 500)
    item, passage = chatter(rng, 30, 5000), chatter(rng, 70, 5000)
    base = chatter(rng, 300, 5000)
    extra = [base, base + " end", "head " + passage + " " + chatter(rng, 90, 5000), passage + " " + chatter(rng, 90, 5000), chatter(rng, 40, 5000) + " " + item, chatter(rng, 50, 5000), None, ""]
    whole = d.unionByName(docs(spark, extra, 10_000))
    whole.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    sf = str(tmp_path)

    now, seen = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, sf)
        assert now.columns == whole.columns, name
        now.write.parquet(f"{sf}/{len(seen)}")
        now = spark.read.parquet(f"{sf}/{len(seen)}")
        seen.append({r["doc_id"]: r["text"] for r in now.collect()})
    bad = {r["doc_id"] for r in labels.collect() if r["toxic"]}
    assert len(bad & set(seen[0])) <= 0.1 * len(bad) and len(set(range(500)) - bad - set(seen[0])) <= 10
    assert set(range(10_000, 10_008)) <= set(seen[0])
    assert 10_000 in seen[1] and 10_001 not in seen[1]
    assert passage in seen[2][10_002] and passage not in seen[2][10_003] and set(seen[2]) == set(seen[1])
    assert set(seen[2]) - set(seen[3]) == {10_004}
    ran = corpus_pipeline.run(spark, sf)
    assert ran.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and {r["doc_id"] for r in ran.collect()} == set(seen[3])


ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans int, _id int, score int, own_id int, class int"


def test_stages_on_odd_rows(spark, tmp_path):
    """Null ids, texts and labels, repeated rows, an id before several texts, columns named like ours; and no rows at all."""
    rng = random.Random(12)
    d, labels = toxic_corpus(spark, 300)
    passage, more, rest = chatter(rng, 60, 5000), chatter(rng, 90, 5000), chatter(rng, 90, 5000)
    odd = [(None, "no id"), (None, None), (1000, None), (1000, "other text of 1000"), (1001, f"{passage} {more}"), (1001, f"{passage} {more}"), (1002, f"head {passage} {rest}"), (1002, "quite another text"), (1003, ""), (1004, "x" * 50_000)]
    rows_ = [(i, t, "en", "s", len(t or ""), 1, 2, 3, 4, 5) for i, t in odd] + [(r["doc_id"], r["text"], "en", "s", r["n_chars"], 1, 2, 3, 4, 5) for r in d.collect()]
    whole = spark.createDataFrame(rows_, ODD_SCHEMA)
    whole.write.parquet(str(tmp_path / "documents.parquet"))
    labels.unionByName(spark.createDataFrame([(None, 1), (2, None), (9999, 1)], labels.schema)).write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "an item that no document holds at all"), (None, "x"), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    sf = str(tmp_path)
    now = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, sf)
        assert out.columns == whole.columns, name
        out.write.parquet(f"{sf}/{name}")
        now = spark.read.parquet(f"{sf}/{name}")
    left = sorted(((r["doc_id"], r["text"]) for r in now.where("doc_id is null or doc_id between 1000 and 1003").collect()), key=repr)
    want = [(None, None), (None, "no id"), (1000, None), (1000, "other text of 1000"), (1001, f"{passage} {more}"), (1001, f"{passage} {more}"), (1002, f"head {rest}"), (1002, "quite another text"), (1003, "")]
    assert left == sorted(want, key=repr)
    assert corpus_pipeline.STAGES[-1][1](spark, now, sf).count() == now.count()
    empty = whole.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0


def test_stages_equal_slow_versions(spark, tmp_path):
    """Each stage after the first against brute force over what the stage before it left."""
    rng = random.Random(14)
    d, labels = toxic_corpus(spark, 150)
    passages, items = [chatter(rng, rng.randrange(48, 70), 5000) for _ in range(4)], [(k, chatter(rng, rng.randrange(5, 30), 5000)) for k in range(5)]
    texts = families(rng, 15)
    for _ in range(40):
        parts = [rng.choice([*passages, chatter(rng, 40, 5000), rng.choice(items)[1], " ".join(rng.choice(items)[1].split()[::-1])]) for _ in range(rng.randrange(1, 4))]
        texts.append(" ".join([*parts, chatter(rng, rng.randrange(30), 5000)]))
    d.unionByName(docs(spark, [*texts, "", None], 10_000)).write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    sf, seen = str(tmp_path), []
    now = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, sf).write.parquet(f"{sf}/{name}")
        now = spark.read.parquet(f"{sf}/{name}")
        seen.append(now.orderBy("doc_id").collect())
    before = [(r["doc_id"], r["text"]) for r in seen[0]]
    assert len(before) > 150

    kept = [before[i] for i, _, _, own in brute_components([t for _, t in before], 5, 80) if own]
    assert [(r["doc_id"], r["text"]) for r in seen[1]] == kept and len(kept) < len(before)

    gone = brute_repeats([t for _, t in kept], 50)
    want = [[w for p, w in enumerate(split(t)) if p not in gone.get((i, False), set())] for i, (_, t) in enumerate(kept)]
    cut = [(r["doc_id"], r["text"]) for r in seen[2]]
    assert [(i, split(t)) for i, t in cut] == [(i, w) for (i, _), w in zip(kept, want, strict=True)] and cut != kept

    leaking = {row[0] for row in brute_leaks([(i, t or "") for i, t in cut], items, 80, decontaminate.SEED)}
    clean = [(i, t) for i, t in cut if i not in leaking]
    assert leaking and [(r["doc_id"], r["text"]) for r in seen[3]] == clean

    library = pieces.load(tokenizer("piece_bpe_32k.model")).library
    ids = {i: library.encode(t or "", add_bos=True, add_eos=True) for i, t in clean}
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"]) for r in seen[4]} == {i: (len(x), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest()) for i, x in ids.items()}
