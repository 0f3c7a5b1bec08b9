"""What changes from snapshot to snapshot, as a stream with a state for each document.

A document's state (digests, notes, and when it counts as gone) lies in the state
store, partitioned by document; a batch touches only the documents that it
brings. A timer of each document fires once the stream's time has passed it by
without the document having been seen again: then it is removed.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from foliospark.sources import versions

#: What a document is held as.
STATE = "source_sha256 string, content_sha256 string, notes array<string>, until long"
CHANGES = "doc_id {key}, category string, new_notes array<string>, at timestamp"


def category(old: Row, source: str | None, content: str | None, fresh: list[str]) -> str | None:
    """The kind of a change as ``operators.changes.classify`` tells it, from values."""
    other_source, other_content = old.source_sha256 != source, old.content_sha256 != content
    if other_source and other_content:
        return "normative" if fresh else "editorial"
    if other_content:
        return "pipeline"
    return "cosmetic" if other_source else None


class Tracker(StatefulProcessor):
    """Changes of one document after another. ``grace``: milliseconds after which a document that is not seen again is gone."""

    def __init__(self, grace: int, baseline: int):
        self.grace, self.baseline = grace, baseline

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        old = Row(*[x.split()[0] for x in STATE.split(", ")])(*self.seen.get()) if self.seen.exists() else None
        until = old.until if old else None
        for row in sorted(rows, key=lambda r: (r.ms, r.source_sha256 or "", r.content_sha256 or "")):
            if old and row.ms > old.until:  # gone before this row, in whichever batch the timer would have fired
                yield self._removed(key, old.until)
                old = None
            notes = list(row.notes or [])
            fresh = sorted(set(notes) - set(old.notes or [])) if old else []
            kind = category(old, row.source_sha256, row.content_sha256, fresh) if old else "new" if row.ms > self.baseline else None
            if kind:
                yield Row(doc_id=key[0], category=kind, new_notes=fresh, at=row["at"])
            old = Row("source_sha256", "content_sha256", "notes", "until")(row.source_sha256, row.content_sha256, notes, row.ms + self.grace)
        if until is not None and until != old.until:
            self.handle.deleteTimer(until)
        self.handle.registerTimer(old.until)
        self.seen.update(tuple(old))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.seen.clear()
        yield self._removed(key, expiredTimerInfo.getExpiryTimeInMs())

    def _removed(self, key, ms: int) -> Row:
        return Row(doc_id=key[0], category="removed", new_notes=[], at=datetime.fromtimestamp(ms / 1000, UTC))

    def close(self) -> None:
        pass


@contextmanager
def _rocks(spark: SparkSession):
    """Stateful processors need this state store; a query takes the setting when it starts."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def changes(stream: DataFrame, grace: str, baseline: str = "1970-01-01 00:00:00") -> DataFrame:
    """Changes (doc_id, category, new_notes, at) of a stream of documents (doc_id, source_sha256, content_sha256, notes, at).

    Rows of a document are taken in the order of ``at``, the time of its
    snapshot, whichever batch brings them; a row older than the stream's time
    is late and left out. A document that is met first after ``baseline`` is
    new, before it is only taken down. One that is not seen for ``grace`` (such
    as ``36 hours``) of the stream's time is removed, and new if it comes
    again. A row without a document moves the time alone; one without a time is
    left out.
    """
    ms = lambda c: F.unix_millis(c)
    spark = stream.sparkSession
    one = spark.range(1).select(ms(F.to_timestamp_ltz(F.lit("1970-01-01 00:00:00"))).alias("a"), ms(F.to_timestamp_ltz(F.lit("1970-01-01 00:00:00")) + F.expr(f"interval {grace}")).alias("b"), ms(F.to_timestamp_ltz(F.lit(baseline))).alias("c")).first()
    key = stream.schema["doc_id"].dataType.simpleString()
    timed = stream.where("at is not null").withWatermark("at", "0 seconds").withColumn("ms", ms(F.col("at")))
    told = timed.where("doc_id is not null or at is null")  # names the time, else the rows would go before they have moved it
    return told.groupBy("doc_id").transformWithState(Tracker(one["b"] - one["a"], one["c"]), CHANGES.format(key=key), "Append", "EventTime")


def report(found: DataFrame, path: str, checkpoint: str, name: str = "changes"):
    """Append changes to the table of versions at ``path``, each batch once, however often it is replayed; the running query."""

    def keep(batch: DataFrame, epoch: int) -> None:
        last = versions.version(batch.sparkSession, path)
        if last and last.feeds.get(name, -1) >= epoch:
            batch.write.format("noop").mode("overwrite").save()  # a replayed batch must still move the state
        else:
            versions.write(batch, path, append=True, feed=name, batch=epoch)

    with _rocks(found.sparkSession):
        return found.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
