"""``python -m foliospark.cli [STAGE ...] [-b BOOK ...]``: stages over books, in the order of the configuration.

Without names: crawl, parse, changes, export, pdf, compare, bundle. ``refresh``
is instead of ``crawl``: it asks the site for what has changed.

All names are checked before anything runs. A stage's time is recorded even if
it fails. ``--force`` turns violated invariants into warnings.
"""

from __future__ import annotations

import argparse
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from foliospark.sources import config
from foliospark.stages import DEFAULT, STAGES, Context


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="foliospark", description=__doc__)
    parser.add_argument("stages", nargs="*", metavar="STAGE", help=", ".join(STAGES))
    parser.add_argument("-b", "--book", action="append", default=[], metavar="SLUG")
    parser.add_argument("--config", default="config.toml")
    parser.add_argument("--out", default="data")
    parser.add_argument("--force", action="store_true")
    args = parser.parse_args(argv)
    names = args.stages or list(DEFAULT)
    if unknown := [s for s in names if s not in STAGES]:
        parser.error(f"unknown stage: {', '.join(unknown)}; known: {', '.join(STAGES)}")
    settings = config.load(args.config)
    known = [b["slug"] for b in settings.get("books", [])]
    if unknown := [b for b in args.book if b not in known]:
        parser.error(f"unknown book: {', '.join(unknown)}; known: {', '.join(known)}")
    spark = spark or SparkSession.builder.appName("foliospark").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    ctx = Context(spark, config.books(spark, settings, args.book or None), settings.get("crawl", {}).get("base_url", ""), args.out, args.force, settings)
    for name in names:
        began, ok = time.monotonic(), False
        try:
            STAGES[name](ctx)
            ok = True
        finally:
            row = spark.createDataFrame([(name, ctx.slugs(), time.monotonic() - began, ok)], "stage string, books array<string>, seconds double, ok boolean")
            row.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").json(ctx.path("timings"))
    return 0


if __name__ == "__main__":
    sys.exit(main())
