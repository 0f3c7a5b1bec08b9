"""Changed pages as a stream: a batch for what crawls have added, nothing lost or repeated by restarts."""

import shutil

import pytest

from foliospark.sources import crawl, versions
from foliospark.streaming import pagefeed
from tests.conftest import rows


class Crawled:
    """A recorded site, its cache, and the stream over that."""

    def __init__(self, spark, tmp_path):
        self.spark, self.cache, self.check, self.out = spark, *(str(tmp_path / x) for x in ("cache", "check", "out"))

    def crawl(self, **pages):
        data = [(f"x/{n}", "<nav>" + "".join(f'<a href="/{c}">t</a>' for c in kids) + f"</nav>{text}") for n, (kids, text) in pages.items()]
        site = self.spark.createDataFrame([(u, str(hash(h)), h, None) for u, h in data], "url string, etag string, html string, error string")
        crawl.crawl(self.spark, "x/", "r", self.cache, ask=crawl.recorded(site))

    def run(self, keep=None, reader="r"):
        def step(batch, epoch):
            if keep:
                keep(batch, epoch)
            versions.write(batch.select("page_id", "kind", "run"), self.out, append=True, feed="pages", batch=epoch)

        query = pagefeed.changed(self.spark, self.cache, reader).writeStream.foreachBatch(step).option("checkpointLocation", self.check).trigger(availableNow=True).start()
        query.awaitTermination()
        return rows(versions.read(self.spark, self.out)) if versions.exists(self.spark, self.out) else []


FIRST = {"r": ("ab", "one"), "a": ("c", "two"), "b": ("", "three"), "c": ("", "four")}
ALL = [("a", "new", 1), ("b", "new", 1), ("c", "new", 1), ("r", "new", 1)]


def test_each_page_comes_once_over_restarts(spark, tmp_path):
    site = Crawled(spark, tmp_path)
    assert site.run() == []
    site.crawl(**FIRST)
    assert site.run() == ALL
    assert site.run() == ALL  # nothing new
    site.crawl(**FIRST | {"a": ("", "other")})
    site.crawl(**FIRST | {"a": ("cd", "other"), "d": ("", "five")} | {"b": ("", "three!")})
    found = sorted([*ALL, ("a", "changed", 2), ("a", "changed", 3), ("b", "changed", 3), ("d", "new", 3)])
    assert site.run() == found
    crawl.compact(spark, site.cache)  # moves rows, adds none
    assert site.run() == found
    site.crawl(**FIRST)
    assert site.run() == sorted([*found, ("a", "changed", 4), ("b", "changed", 4)])


def test_a_batch_that_dies_comes_again_whole(spark, tmp_path):
    site = Crawled(spark, tmp_path)
    site.crawl(**FIRST)

    def die(batch, epoch):
        raise RuntimeError("dies")

    with pytest.raises(Exception, match="dies"):
        site.run(die)
    site.crawl(**FIRST | {"b": ("", "three!")})
    assert site.run() == ALL  # the batch that was planned
    assert site.run() == sorted([*ALL, ("b", "changed", 2)])


def test_a_checkpoint_from_before_the_batch(spark, tmp_path):
    site = Crawled(spark, tmp_path)
    site.crawl(**FIRST)
    site.run()
    site.crawl(**FIRST | {"b": ("", "three!")})
    shutil.copytree(site.check, tmp_path / "before")
    found = site.run()
    shutil.rmtree(site.check)
    shutil.copytree(tmp_path / "before", site.check)
    assert site.run() == found == sorted([*ALL, ("b", "changed", 2)])


def test_versions_that_a_reader_needs_stay(spark, tmp_path):
    site = Crawled(spark, tmp_path)
    site.crawl(**FIRST)
    site.run()
    site.crawl(**FIRST | {"b": ("", "three!")})
    crawl.compact(spark, site.cache)
    pagefeed.forget(spark, site.cache)
    assert ("b", "changed", 2) in site.run()
    site.run()
    assert pagefeed.forget(spark, site.cache)
    assert versions.read(spark, f"{site.cache}/pages").count() == 4
    site.crawl(**FIRST)
    assert ("b", "changed", 3) in site.run()


def test_lost_versions_are_told(spark, tmp_path):
    site = Crawled(spark, tmp_path)
    site.crawl(**FIRST)
    site.run(reader="")
    site.crawl(**FIRST | {"b": ("", "three!")})
    crawl.compact(spark, site.cache)
    versions.vacuum(spark, f"{site.cache}/pages")
    with pytest.raises(Exception, match="are gone"):
        site.run(reader="")


def test_a_new_reader_begins_with_what_is_there(spark, tmp_path):
    site = Crawled(spark, tmp_path)
    site.crawl(**FIRST)
    crawl.compact(spark, site.cache)
    versions.vacuum(spark, f"{site.cache}/pages")
    assert site.run() == ALL
