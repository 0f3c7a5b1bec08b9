"""Queries of documents and pages as streams, with a state from batch to batch."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from foliospark.operators import lineage
from foliospark.plans.changed import COMPARED_SQL, snapshots
from foliospark.registry import query
from foliospark.sources import versions
from foliospark.streaming import tracking


@query("stream_change_tracking", f"WITH {COMPARED_SQL} SELECT doc_id, category, new_notes FROM compared WHERE category IS NOT NULL")
def stream_change_tracking(spark, sf):
    """Two snapshots, a day apart, in two batches each, and a day after them: the changes that the stream reports."""
    at = f"{lineage.shared_dir(spark)}/tracked-{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    prev, curr = (df.select("doc_id", "source_sha256", "content_sha256", "notes") for df in snapshots(spark, sf))
    beat = prev.limit(0).unionByName(spark.range(1).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("source_sha256"), F.lit(None).cast("string").alias("content_sha256"), F.lit(None).cast("array<string>").alias("notes")))
    halves = [(day, df.where(F.col("doc_id") % 2 == k)) for day, df in ((1, prev), (2, curr)) for k in (0, 1)]
    for day, df in [*halves, (3, beat)]:
        df.withColumn("at", F.to_timestamp(F.lit(f"2024-01-0{day} 00:00:00"))).repartition(n).write.mode("append").parquet(f"{at}/in")
    schema = spark.read.parquet(f"{at}/in").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", n).parquet(f"{at}/in")
    found = tracking.changes(stream, "36 hours", baseline="2024-01-01 12:00:00")
    tracking.report(found, f"{at}/report", f"{at}/check").awaitTermination()
    return versions.read(spark, f"{at}/report").select("doc_id", "category", F.array_join("new_notes", "|").alias("new_notes"))
