"""Documents tracked as a stream: classes, removals by timers, late rows, restarts and replayed batches."""

import shutil

from pyspark.sql import functions as F

from foliospark.operators import changes
from foliospark.sources import versions
from foliospark.streaming import tracking
from tests.conftest import rows

SCHEMA = "doc_id long, source_sha256 string, content_sha256 string, notes array<string>, at timestamp"


class Feed:
    """A folder of snapshots and the stream over it."""

    def __init__(self, spark, tmp_path):
        self.spark, self.source, self.report, self.checkpoint = spark, *(str(tmp_path / x) for x in ("in", "report", "check"))
        self.days = set()

    def add(self, day, *docs):
        data = [(i, s, c, n, None) for i, s, c, n in docs]
        df = self.spark.createDataFrame(data, SCHEMA).withColumn("at", F.to_timestamp(F.lit(f"2024-01-{day:02d} 00:00:00")))
        df.coalesce(1).write.mode("append").parquet(self.source)

    def run(self, per_batch=1):
        stream = self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", per_batch).parquet(self.source)
        found = tracking.changes(stream, "36 hours", baseline="2024-01-01 12:00:00")
        query = tracking.report(found, self.report, self.checkpoint)
        query.awaitTermination()
        return rows(versions.read(self.spark, self.report).select("doc_id", "category", F.array_join("new_notes", "|"))) if versions.exists(self.spark, self.report) else []


def test_changes_over_several_batches_and_restarts(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add(1, (1, "a", "a", []), (2, "b", "b", ["n"]), (3, "c", "c", []), (4, "d", "d", []), (5, "e", "e", None))
    assert feed.run() == []
    feed.add(2, (1, "a", "a", []), (2, "x", "x", ["n", "m", "k"]), (3, "c", "y", []), (6, "f", "f", []))
    expected = [(2, "normative", "k|m"), (3, "pipeline", ""), (6, "new", "")]
    assert feed.run() == expected
    feed.add(3, (1, "z", "a", []), (2, "y", "y", ["m"]), (3, "c", "y", []), (4, "d", "d", []))
    expected = sorted([*expected, (1, "cosmetic", ""), (2, "editorial", ""), (4, "new", ""), (4, "removed", ""), (5, "removed", "")])  # 4 comes again after its time
    assert feed.run() == expected
    feed.add(9, (1, "z", "a", []))
    assert [r[1] for r in feed.run() if r[0] == 6] == ["new", "removed"]


def test_versions_of_a_document_in_one_batch_are_taken_in_their_order(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add(3, (1, "c", "b", []))
    feed.add(1, (1, "a", "a", []))
    feed.add(2, (1, "a", "b", []))
    assert feed.run(per_batch=10) == [(1, "cosmetic", ""), (1, "pipeline", "")]


def test_a_replayed_batch_is_reported_once(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add(1, (1, "a", "a", []))
    feed.run()
    feed.add(2, (1, "b", "b", []))
    shutil.copytree(feed.checkpoint, tmp_path / "before")
    assert feed.run() == [(1, "editorial", "")]
    shutil.rmtree(feed.checkpoint)
    shutil.copytree(tmp_path / "before", feed.checkpoint)  # the report was written, the checkpoint was not
    assert feed.run() == [(1, "editorial", "")]


def test_same_classes_as_a_comparison_of_snapshots(spark, tmp_path):
    import random

    rng = random.Random(2)
    pick = lambda i: (i, rng.choice("ab"), rng.choice("ab"), rng.sample(["m", "n"], rng.randrange(3)))
    before = [pick(i) for i in range(60) if rng.random() < 0.8]
    after = [pick(i) for i in range(60) if rng.random() < 0.8]
    feed = Feed(spark, tmp_path)
    for day, docs in ((1, before), (2, after)):
        feed.add(day, *docs[:20])
        feed.add(day, *docs[20:])
    feed.add(3)
    spark.createDataFrame([(None, None, None, None)], "doc_id long, source_sha256 string, content_sha256 string, notes array<string>").withColumn("at", F.to_timestamp(F.lit("2024-01-03 00:00:00"))).write.mode("append").parquet(feed.source)
    schema = SCHEMA.rpartition(", ")[0]
    compared = changes.compare(spark.createDataFrame(before, schema), spark.createDataFrame(after, schema)).where("category is not null")
    assert feed.run() == rows(compared.select("doc_id", "category", F.array_join("new_notes", "|")))


def test_category_is_that_of_columns(spark):
    from itertools import product

    data = [(s, t, c, d, f) for s, t, c, d, f in product("ab", "ab", "ab", "ab", ([], ["n"]))]
    df = spark.createDataFrame(data, "s string, t string, c string, d string, f array<string>")
    for r in df.withColumn("kind", changes.classify(*map(F.col, "stcdf"))).collect():
        old = tracking.Row(source_sha256=r.s, content_sha256=r.c)
        assert tracking.category(old, r.t, r.d, list(r.f)) == r.kind
