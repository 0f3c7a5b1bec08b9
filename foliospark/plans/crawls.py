"""Queries of crawls over a recorded site: what a second crawl finds, level by level."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from foliospark.operators import lineage
from foliospark.registry import query
from foliospark.sources import crawl
from foliospark.sources.tables import read


def _site(spark, sf, second: bool):
    """The test pages, each with a menu of the eight pages that follow from its number; between the crawls some change, come, go or fail."""
    p = read(spark, sf, "pages")
    i = F.col("page_id")
    kids = F.concat(*[x for k in range(1, 9) for x in (F.lit('<a href="/'), (i * 8 + k).cast("string"), F.lit('">t</a>'))])
    changed = F.when(i % 7 == 1, "!").otherwise("") if second else F.lit("")
    made = F.concat(F.lit("<nav>"), kids, F.lit("</nav><article>"), "html", F.lit("</article>"), changed)
    rows = p.select(F.concat(F.lit("site/"), i.cast("string")).alias("url"), F.when(i % 3 > 0, F.md5(made)).alias("etag"), made.alias("html"), F.when((i % 13 == 9) if second else F.lit(False), "HTTP 403").alias("error"), i)
    return rows.where((i % 11 != 5) if second else (i % 17 != 3)).drop("page_id")


@query(
    "revalidated_crawl",
    """WITH RECURSIVE eight(k) AS (SELECT range::BIGINT FROM range(1, 9)),
    a AS (SELECT 0::BIGINT AS id UNION ALL SELECT a.id * 8 + k FROM a JOIN pages p ON p.page_id = a.id AND a.id % 17 <> 3, eight),
    known AS (SELECT id FROM a JOIN pages p ON p.page_id = a.id WHERE id % 17 <> 3),
    b AS (SELECT 0::BIGINT AS id, 1 AS depth UNION ALL
        SELECT b.id * 8 + k, depth + 1 FROM b JOIN pages p ON p.page_id = b.id AND b.id % 11 <> 5 AND (b.id % 13 <> 9 OR b.id IN (SELECT id FROM known)), eight),
    told AS (SELECT b.id, depth, k.id IS NOT NULL AS old, p.html, '<nav>' || (SELECT string_agg('<a href="/' || (b.id * 8 + k) || '">t</a>', '' ORDER BY k) FROM eight) || '</nav><article>' || html || '</article>' AS body,
        CASE WHEN p.html IS NULL OR b.id % 11 = 5 THEN 'removed' WHEN b.id % 13 = 9 THEN 'failed' WHEN k.id IS NULL THEN 'new' WHEN b.id % 7 = 1 THEN 'changed' ELSE 'same' END AS kind
        FROM b LEFT JOIN pages p ON p.page_id = b.id LEFT JOIN known k ON k.id = b.id)
    SELECT id::VARCHAR AS page_id, depth, kind, CASE WHEN kind IN ('new', 'changed') THEN 2 WHEN kind = 'same' OR (kind = 'failed' AND old) THEN 1 END::BIGINT AS body_run,
        CASE WHEN kind IN ('new', 'changed') THEN sha256(body || CASE WHEN id % 7 = 1 THEN '!' ELSE '' END) WHEN kind = 'same' OR (kind = 'failed' AND old) THEN sha256(body) END AS sha256 FROM told""",
)
def revalidated_crawl(spark, sf):
    """The second of two crawls of a recorded site against one cache."""
    path = f"{lineage.shared_dir(spark)}/crawl-{uuid.uuid4().hex}"
    for second in (False, True):
        crawl.crawl(spark, "site/", "0", path, ask=crawl.recorded(_site(spark, sf, second)))
    whole = crawl.pages(spark, path).select(F.col("page_id").alias("of"), F.sha2("html", 256).alias("sha256"))
    return crawl.met(spark, path).select("page_id", "depth", "kind", "body_run").join(whole, F.col("page_id") == F.col("of")).drop("of")
