"""A crawl that asks a site what has changed, level by level, against a cache of all crawls before.

The cache is a table of versions. Each level of a crawl appends its rows, a
page's body only where it came anew: a page that has not changed names the crawl
that has its body, and brings its children from there. No level rewrites or
reads again the bodies of another. A crawl that dies leaves its levels in the
cache, so the next one begins with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from foliospark.operators.lineage import written
from foliospark.sources import versions, web

#: A row for each page that a crawl met. ``kind``: new, changed, same, cached (not asked for), failed or removed.
ROWS = (
    "run long, depth int, page_id string, kind string, etag string, last_modified string, html string, sha256 string, children array<string>, body_run long, error string"
)
RUNS = "run long, root string, pages long, asked long, new long, changed long, same long, failed long, removed long"
_LINK = '(?s)<a href="/?([^"#]*)">'
Ask = Callable[[DataFrame, int], DataFrame]
Menu = Callable[[Column], Column]


def menu(html: Column) -> Column:
    """Ids of the pages that a page's menu links to, in its order."""
    return F.array_distinct(F.regexp_extract_all(F.regexp_extract(html, "(?s)<nav>(.*?)</nav>", 1), F.lit(_LINK), F.lit(1)))


def _rows(spark: SparkSession, path: str) -> DataFrame:
    at = f"{path}/pages"
    return versions.read(spark, at) if versions.exists(spark, at) else spark.createDataFrame([], ROWS)


def _fitted(rows: DataFrame) -> DataFrame:
    return rows.select(*(F.col(f.name).cast(f.dataType) for f in StructType.fromDDL(ROWS)))


def runs(spark: SparkSession, path: str) -> DataFrame:
    """A row for each crawl that came to its end; empty before the first."""
    at = f"{path}/runs"
    return versions.read(spark, at) if versions.exists(spark, at) else spark.createDataFrame([], RUNS)


def known(spark: SparkSession, path: str) -> DataFrame:
    """What the cache says of each page: the crawl that has its body, the body's digest, validators and children. Bodies are not read."""
    last = F.max_by(F.struct("body_run", "sha256", "children", "etag", "last_modified"), "run")
    return _rows(spark, path).groupBy("page_id").agg(last.alias("x")).select("page_id", "x.*").where("body_run is not null")


def _told(answers: DataFrame, menu: Menu) -> DataFrame:
    """Rows of the cache from answers (as of :func:`web.fetched`) that carry what was known (old_*)."""
    html = F.make_valid_utf8(F.col("content").cast("string"))
    gone = F.col("error").rlike(r"^HTTP (404|410)\b")
    rows = answers.withColumn("html", F.when(F.col("status") != 304, html)).withColumn("sha256", F.sha2("content", 256))
    again = (F.col("status") == 304) | F.col("sha256").eqNullSafe(F.col("old_sha256"))
    kind = F.when(gone, "removed").when(F.col("error").isNotNull(), "failed").when(again, "same").when(F.col("old_run").isNotNull(), "changed").otherwise("new")
    rows = rows.withColumn("kind", kind)
    fresh, kept = F.col("kind").isin("new", "changed"), F.col("kind").isin("same", "failed")
    either = lambda new, old: F.when(fresh, new).when(kept, F.col(old))
    mark = lambda c: F.when(F.col("kind") == "failed", F.col(f"old_{c}")).otherwise(F.coalesce(F.nullif(F.col(c), F.lit("")), F.when(kept, F.col(f"old_{c}"))))
    return rows.select(
        "page_id", "kind", mark("etag").alias("etag"), mark("last_modified").alias("last_modified"), F.when(fresh, F.col("html")).alias("html"), either(F.col("sha256"), "old_sha256").alias("sha256"),
        F.coalesce(either(menu(F.col("html")), "old_children"), F.array().cast("array<string>")).alias("children"), either(F.col("run"), "old_run").alias("body_run"), "error",
    )


def crawl(spark: SparkSession, base: str, root: str, path: str, revalidate: bool = True, at_a_time: int = 3, ask: Ask = web.fetched, page: str = "{}", menu: Menu = menu) -> int:
    """Crawl the site below ``root`` once more and return the crawl's number; its pages are in the cache at ``path``.

    A page is at ``base`` and its id within ``page``; its children are the ids
    that ``menu`` finds in it.
    Each page of a level is asked for once, with the validators of the cache;
    without ``revalidate`` only pages that the cache has not are asked for. A
    page that has not changed keeps its body and its children; one that can't
    be had just now does so too, with its error; one that is gone (404, 410)
    has neither. ``ask`` takes (url, etag, last_modified and what is carried)
    and answers as :func:`web.fetched` does.
    """
    at = f"{path}/pages"
    before, _, after = page.partition("{}")
    run = 1 + (_rows(spark, path).agg(F.max("run")).first()[0] if versions.exists(spark, at) else 0)  # one number
    cache = written(known(spark, path), "known").select("page_id", *(F.col(c).alias(f"old_{c.removeprefix('body_')}") for c in ("body_run", "sha256", "children", "etag", "last_modified")))
    front = spark.range(1).select(F.lit(root).alias("page_id"))
    own: list[str] = []  # this crawl's parts of the table
    while True:
        here = front.join(cache, "page_id", "left").withColumn("run", F.lit(run).cast("long"))
        due = here if revalidate else here.where("old_run is null")
        asked = due.select(F.concat(F.lit(base + before), "page_id", F.lit(after)).alias("url"), F.col("old_etag").alias("etag"), F.col("old_last_modified").alias("last_modified"), *here.columns)
        level = _told(ask(asked, at_a_time), menu)
        if not revalidate:
            old = [F.col(f"old_{c}").alias(c) for c in ("etag", "last_modified")]
            level = level.unionByName(here.where("old_run is not null").select(
                "page_id", F.lit("cached").alias("kind"), *old, F.lit(None).cast("string").alias("html"), F.col("old_sha256").alias("sha256"), F.col("old_children").alias("children"), F.col("old_run").alias("body_run"), F.lit(None).cast("string").alias("error"),
            ))
        level = level.select(F.lit(run).cast("long").alias("run"), F.lit(len(own) + 1).alias("depth"), "*")
        own.append(versions.write(_fitted(level), at, append=True).parts[-1])
        seen = versions.parts(spark, at, own).select("page_id")
        found = versions.parts(spark, at, own[-1:]).select(F.explode("children").alias("page_id")).distinct()
        front = written(found.join(seen, "page_id", "left_anti"), "front")
        if front.isEmpty():
            break
    kinds = ["new", "changed", "same", "failed", "removed"]
    count = versions.parts(spark, at, own).agg(F.count("*").alias("pages"), F.count_if(F.col("kind") != "cached").alias("asked"), *(F.count_if(F.col("kind") == k).alias(k) for k in kinds))
    versions.write(count.select(F.lit(run).cast("long").alias("run"), F.lit(root).alias("root"), "pages", "asked", *kinds), f"{path}/runs", append=True)
    return run


def met(spark: SparkSession, path: str, run: int | None = None) -> DataFrame:
    """The rows of a crawl, the last that came to its end where none is named; bodies only where they came anew."""
    run = run or runs(spark, path).agg(F.max("run")).first()[0]
    return _rows(spark, path).where(F.col("run") == F.lit(run))


def pages(spark: SparkSession, path: str, run: int | None = None) -> DataFrame:
    """(page_id, depth, kind, html, etag, last_modified, error) of a crawl as of :func:`met`, each page with its body from whichever crawl has it."""
    rows = met(spark, path, run).drop("html")
    bodies = _rows(spark, path).where("html is not null").select(F.col("page_id").alias("of_page"), F.col("run").alias("of_run"), "html")
    found = rows.join(bodies, (F.col("page_id") == F.col("of_page")) & (F.col("body_run") == F.col("of_run")), "left")
    return found.select("page_id", "depth", "kind", "html", "etag", "last_modified", "error")


def compact(spark: SparkSession, path: str) -> None:
    """A version of the last crawl only, with all its bodies, in one part. Versions before it stay until they are vacuumed."""
    last = runs(spark, path).agg(F.max("run")).first()[0]
    rows = met(spark, path, last).drop("html")
    bodies = _rows(spark, path).where("html is not null").select(F.col("page_id").alias("of_page"), F.col("run").alias("of_run"), "html")
    whole = rows.join(bodies, (F.col("page_id") == F.col("of_page")) & (F.col("body_run") == F.col("of_run")), "left")
    whole = whole.withColumn("body_run", F.when(F.col("body_run").isNotNull(), F.col("run")))
    versions.write(_fitted(whole), f"{path}/pages", rearranged=True)


def recorded(site: DataFrame) -> Ask:
    """Answers from a recorded site (url, etag, html, error) as a server would give them: for crawls without a network."""

    def ask(urls: DataFrame, at_a_time: int) -> DataFrame:
        have = site.select(F.col("url").alias("r_url"), F.col("etag").alias("r_etag"), F.col("html").alias("r_html"), F.col("error").alias("r_error"))
        rows = urls.join(have, F.col("url") == F.col("r_url"), "left")
        missing = F.when(F.col("r_url").isNull(), F.concat(F.lit("HTTP 404 at "), "url")).otherwise(F.col("r_error"))
        same = F.col("etag") == F.col("r_etag")
        carried = [c for c in urls.columns if c not in ("url", "etag", "last_modified")]
        status = F.when(missing.isNull(), F.when(same, 304).otherwise(200))
        return rows.select("url", status.alias("status"), F.when(missing.isNull(), F.col("r_etag")).alias("etag"), F.lit("").alias("last_modified"), F.when(missing.isNull() & ~F.coalesce(same, F.lit(False)), F.col("r_html").cast("binary")).alias("content"), missing.alias("error"), *carried)

    return ask
