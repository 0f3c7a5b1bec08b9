"""The batch operators' streaming forms: windows over events, changed documents against a state, an appended run log."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliospark.operators import changes, lineage
from foliospark.sources import files, versions


def event_stream(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A file or a folder of events as a stream."""
    schema = schema or spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if not files.is_file(spark, path):
        return reader.parquet(path)
    folder, _, name = path.rpartition("/")  # Spark streams folders: of this one, the file of that name
    return reader.option("pathGlobFilter", name).parquet(folder)


def tumbling(stream: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Count and sum of each event type in each window; events later than ``late`` are left out once their window is closed."""
    at = stream.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    return at.groupBy(F.window("at", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(stream: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Sessions of each user that end after ``gap`` without an event."""
    at = stream.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    return at.groupBy(F.session_window("at", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def drain(stream: DataFrame, mode: str = "complete") -> DataFrame:
    """Run a stream over all that is there and return its result table, which executors write to the shared folder.

    In complete mode a batch's result replaces that of the batch before it.
    """
    spark = stream.sparkSession
    at = f"{lineage.shared_dir(spark)}/drained-{uuid.uuid4().hex}"

    def keep(batch: DataFrame, epoch: int) -> None:
        if mode == "complete":
            files.staged(batch, f"{at}/result")
        else:
            batch.write.mode("overwrite").parquet(f"{at}/result/batch-{epoch}")

    query = stream.writeStream.outputMode(mode).foreachBatch(keep).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    if not files.exists(spark, f"{at}/result"):  # a stream without any batch
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).option("recursiveFileLookup", True).parquet(f"{at}/result")


def track(stream: DataFrame, state: str, report: str, checkpoint: str, order: str | None = None):
    """Classify each batch of documents (doc_id, source_sha256, content_sha256, notes) against the last state.

    The first batch is the baseline. Of several rows of a document in a batch
    the one of the greatest ``order`` counts, or, without one, of the greatest
    digests. State and report are tables of versions, and each says which
    batches it holds: a batch that is replayed is neither lost nor reported
    twice. The whole state is written for each batch; ``tracking.changes`` keeps
    it by document. Returns the running query.
    """

    def step(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        last = versions.version(spark, state)
        if last and last.feeds["track"] >= epoch:
            return
        held = [c for c in batch.columns if c != "doc_id"]
        rank = [*([order] if order else []), "source_sha256", "content_sha256"]
        latest = batch.groupBy("doc_id").agg(F.max_by(F.struct(*held), F.struct(*rank)).alias("x")).select("doc_id", "x.*").select(*batch.columns)
        if last:
            old = versions.read(spark, state)
            known = changes.compare(old, latest).where("category is not null and category <> 'removed'")
            versions.write(known.withColumn("epoch", F.lit(epoch)), report, append=True, feed="track", batch=epoch)
            latest = old.join(latest.select("doc_id"), "doc_id", "left_anti").unionByName(latest)
        versions.write(latest, state, feed="track", batch=epoch)

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """An appended log of JSON lines as a stream."""
    return spark.readStream.schema(schema).json(path)
