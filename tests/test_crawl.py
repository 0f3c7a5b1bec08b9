"""Crawls against a cache: what changed, what did not, what is gone, what fails; each page asked for once."""

import functools
import http.server
import threading

import pytest
from pyspark.sql import functions as F

from foliospark.sources import crawl, versions, web
from tests.conftest import rows


class Site:
    """A site on this machine whose pages can be changed between crawls."""

    def __init__(self):
        self.pages, self.broken, self.asked = {}, set(), []
        site = self

        class Handler(http.server.BaseHTTPRequestHandler):
            def do_GET(self):
                name = self.path[1:]
                site.asked.append((name, self.headers.get("If-None-Match"), self.headers.get("If-Modified-Since")))
                html, date = site.pages.get(name, (None, None))
                tag = None if date else f'"{hash(html)}"'
                same = html is not None and ((tag and self.headers.get("If-None-Match") == tag) or (date and self.headers.get("If-Modified-Since") == date))
                self.send_response(403 if name in site.broken else 404 if html is None else 304 if same else 200)
                body = b"" if html is None or same or name in site.broken else html.encode()
                if html is not None:
                    self.send_header("Last-Modified", date) if date else self.send_header("ETag", tag)
                self.send_header("Content-Length", str(len(body)))
                self.end_headers()
                self.wfile.write(body)

            def log_message(self, *args):
                pass

        self.server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.base = f"http://127.0.0.1:{self.server.server_port}/"

    def page(self, name, *children, text="", date=None):
        self.pages[name] = "<nav>" + "".join(f'<a href="/{c}">{c}</a>' for c in children) + f"</nav><article>{text}</article>", date

    def told(self):
        out, self.asked = sorted(self.asked, key=str), []
        return out


@pytest.fixture
def site():
    made = Site()
    made.page("r", "a", "b", "f", text="root")
    made.page("a", "c", "r", text="one")
    made.page("b", "c", "d", text="two", date="Mon, 01 Jan 2024 00:00:00 GMT")
    made.page("c", text="three")
    made.page("d", "e", text="four")
    made.page("e", text="five")
    made.page("f", "g", text="six")
    made.page("g", text="seven")
    yield made
    made.server.shutdown()


def kinds(spark, path, run=None):
    return {r["page_id"]: (r["kind"], r["depth"]) for r in crawl.met(spark, path, run).collect()}


def test_a_second_crawl_asks_what_has_changed(spark, site, tmp_path):
    path, ask = str(tmp_path / "cache"), functools.partial(web.fetched, pause=0)
    assert crawl.crawl(spark, site.base, "r", path, ask=ask) == 1
    assert kinds(spark, path) == {"r": ("new", 1), "a": ("new", 2), "b": ("new", 2), "f": ("new", 2), "c": ("new", 3), "d": ("new", 3), "g": ("new", 3), "e": ("new", 4)}
    assert [a[0] for a in site.told()] == sorted("rabfcdge")

    site.page("a", "c", "h", text="one, changed")  # a new child
    site.page("h", text="eight")
    del site.pages["d"]  # its child e is met no more
    site.broken.add("f")  # its child stays
    before = versions.version(spark, f"{path}/pages").parts
    assert crawl.crawl(spark, site.base, "r", path, ask=ask) == 2
    assert kinds(spark, path) == {"r": ("same", 1), "a": ("changed", 2), "b": ("same", 2), "f": ("failed", 2), "c": ("same", 3), "d": ("removed", 3), "g": ("same", 3), "h": ("new", 3)}
    asked = site.told()
    assert [a[0] for a in asked] == sorted("rabfcdgh")  # each once
    assert all(tag or date for name, tag, date in asked if name != "h") and [a for a in asked if a[0] == "b"] == [("b", None, "Mon, 01 Jan 2024 00:00:00 GMT")]
    assert versions.version(spark, f"{path}/pages").parts[: len(before)] == before  # no level is written again
    bodies = crawl.met(spark, path, 2).where("html is not null").select("page_id")
    assert rows(bodies) == [("a",), ("h",)]

    got = {r["page_id"]: r for r in crawl.pages(spark, path).collect()}
    text = lambda name: got[name]["html"] and got[name]["html"].partition("<article>")[2].removesuffix("</article>")
    assert {n: text(n) for n in got} == {"r": "root", "a": "one, changed", "b": "two", "c": "three", "d": None, "f": "six", "g": "seven", "h": "eight"}
    assert "403" in got["f"]["error"] and "404" in got["d"]["error"]
    assert {r["page_id"]: r["html"] for r in crawl.pages(spark, path, 1).collect()}["a"].endswith("one</article>")  # the crawl before is still there

    site.broken.clear()
    site.page("d", text="four again")
    crawl.crawl(spark, site.base, "r", path, ask=ask)
    assert {k: v[0] for k, v in kinds(spark, path).items()} == {"r": "same", "a": "same", "b": "same", "f": "same", "c": "same", "d": "new", "g": "same", "h": "same"}
    assert rows(crawl.runs(spark, path).drop("root")) == [(1, 8, 8, 8, 0, 0, 0, 0), (2, 8, 8, 1, 1, 4, 1, 1), (3, 8, 8, 1, 0, 7, 0, 0)]
    crawl.compact(spark, path)
    assert {r["page_id"] for r in crawl.pages(spark, path).where("html is not null").collect()} == set("rabcdfgh")
    site.told()
    crawl.crawl(spark, site.base, "r", path, ask=ask)
    assert {k: v[0] for k, v in kinds(spark, path).items()} == dict.fromkeys("rabcdfgh", "same")


def test_without_revalidation_only_missing_pages_are_asked_for(spark, site, tmp_path):
    path, ask = str(tmp_path / "cache"), functools.partial(web.fetched, pause=0)
    crawl.crawl(spark, site.base, "r", path, ask=ask)
    site.told()
    site.page("a", "h", text="not seen")
    assert crawl.crawl(spark, site.base, "r", path, revalidate=False, ask=ask) == 2
    assert site.told() == [] and {k for k, _ in kinds(spark, path).values()} == {"cached"}
    assert crawl.pages(spark, path).where("html is null").count() == 0


def test_a_crawl_that_died_is_gone_on_with(spark, site, tmp_path):
    path = str(tmp_path / "cache")
    levels = 0

    def ask(urls, n):
        nonlocal levels
        levels += 1
        if levels == 3:
            raise KeyboardInterrupt
        return web.fetched(urls, n, 0)

    with pytest.raises(KeyboardInterrupt):
        crawl.crawl(spark, site.base, "r", path, ask=ask)
    assert crawl.runs(spark, path).count() == 0
    site.told()
    crawl.crawl(spark, site.base, "r", path, revalidate=False, ask=functools.partial(web.fetched, pause=0))
    assert [a[0] for a in site.told()] == sorted("cdge")
    assert {k: v[0] for k, v in kinds(spark, path).items()} == dict.fromkeys("rabf", "cached") | dict.fromkeys("cdge", "new")


def test_a_server_without_validators(spark, tmp_path):
    path = str(tmp_path / "cache")
    site = lambda a: crawl.recorded(spark.createDataFrame([("x/r", None, f'<nav><a href="/a">a</a></nav>{a}', None), ("x/a", None, "leaf", None)], "url string, etag string, html string, error string"))
    crawl.crawl(spark, "x/", "r", path, ask=site(1))
    crawl.crawl(spark, "x/", "r", path, ask=site(2))
    assert {k: v[0] for k, v in kinds(spark, path).items()} == {"r": "changed", "a": "same"}
    assert crawl.met(spark, path).where(F.col("page_id") == "a").first()["body_run"] == 1


def test_broken_answers_are_asked_for_again():
    import gzip

    from tests.test_sources import Answer, client

    cut = gzip.compress(b"whole text" * 50)[:-12]
    c, _ = client(Answer(200, b"no gzip", Content_Encoding="gzip"), Answer(200, cut, Content_Encoding="gzip"), Answer(200, b"x", Content_Length="many"), Answer(200, b"ok"))
    assert c.fetch("https://h/a")[2] == b"ok" and c.counters["requests"] == 4
