import gzip
import http.client
import json
import shutil

import pytest
from pyspark.sql import functions as F

from foliospark import cli
from foliospark.sources import config, files, pdf, versions, web
from foliospark.streaming import feeds
from tests.conftest import rows


class Answer:
    def __init__(self, status, body=b"", **headers):
        self.status, self.body, self.headers = status, body, {k.replace("_", "-"): v for k, v in headers.items()}

    def read(self):
        return self.body

    def getheaders(self):
        return list(self.headers.items())


class Site:
    """Answers in turn, and what was asked."""

    def __init__(self, *answers):
        self.answers, self.asked, self.opened = list(answers), [], 0

    def connect(self, scheme, host):
        self.opened += 1
        return self

    def request(self, method, path, headers):
        self.asked.append((method, path, headers))

    def getresponse(self):
        answer = self.answers.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return answer

    def close(self):
        pass


def client(*answers):
    site = Site(*answers)
    return web.Client(connect=site.connect, pause=0), site


def test_fetch_follows_and_unpacks():
    c, site = client(Answer(302, Location="/b?x=1"), Answer(200, gzip.compress(b"hi"), Content_Encoding="gzip", ETag='"a-gzip"'))
    assert c.fetch("https://h/a") == (200, {"content-encoding": "gzip", "etag": '"a"'}, b"hi")
    assert [a[1] for a in site.asked] == ["/a", "/b?x=1"] and site.opened == 1


def test_fetch_tries_again():
    c, site = client(Answer(502), http.client.RemoteDisconnected(), Answer(200, b"cut", Content_Length="9"), Answer(200, b"ok", Content_Length="2"))
    assert c.fetch("https://h/a")[2] == b"ok"
    assert site.opened == 4 and c.counters["requests"] == 3


def test_fetch_gives_up():
    with pytest.raises(web.HttpError, match="404"):
        client(Answer(404))[0].fetch("https://h/a")
    with pytest.raises(web.HttpError, match="redirects"):
        client(*[Answer(301, Location="/a")] * 9)[0].fetch("https://h/a")
    with pytest.raises(web.HttpError, match="502"):
        client(*[Answer(502)] * 11)[0].fetch("https://h/a")


def test_unchanged_page_has_no_body():
    c, site = client(Answer(304))
    assert c.fetch("https://h/a", web.validators('"e"', "date"))[::2] == (304, None)
    assert site.asked[0][2]["If-None-Match"] == '"e"' and "If-Modified-Since" not in site.asked[0][2]


def test_page_source_reports_failures(spark):
    web.register(spark)
    got = spark.read.format("pages").option("urls", "").load()
    assert got.count() == 0


def test_crawl(spark):
    nav = lambda *ids: "<title>T</title><nav>" + "".join(f'<a href="/{i}">t{i}</a>' for i in ids) + "</nav>"
    pages = spark.createDataFrame([("r", nav("b", "a")), ("a", nav("r") + "<article>x</article>"), ("b", nav("c"))], "page_id string, html string")
    got = {r["id"]: (r["parent"], r["depth"], r["is_leaf"], r["has_body"]) for r in web.crawl(pages, "r").collect()}
    assert got == {"r": (None, 1, False, False), "b": ("r", 2, False, False), "a": ("r", 2, False, True), "c": ("b", 3, True, False)}


def test_json_lines_are_read_tolerantly(spark, tmp_path):
    path = tmp_path / "runs.jsonl"
    path.write_text('{"at": 1}\n\nnot json\n{"at": 3}\n{"at": 2}\n')
    assert rows(files.json_lines(spark, str(path), "at long")) == [(1,), (2,), (3,)]
    assert rows(files.json_lines(spark, str(path), "at long", last=2, order="at")) == [(2,), (3,)]
    assert files.json_lines(spark, str(tmp_path / "none"), "at long").count() == 0


def test_staged_write_keeps_the_old_on_failure(spark, tmp_path):
    path = str(tmp_path / "t")
    files.staged(spark.range(3), path)
    with pytest.raises(Exception, match="(?i)boom"):
        files.staged(spark.range(3).select(F.raise_error(F.lit("boom")).alias("x")), path)
    assert spark.read.parquet(path).count() == 3
    files.staged(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_html_and_binaries(spark, tmp_path):
    (tmp_path / "7.html").write_bytes(b"<p>\xc3\xb1</p>")
    (tmp_path / "a.PNG").write_bytes(b"x")
    assert rows(files.html_pages(spark, str(tmp_path))) == [("7", "<p>ñ</p>")]
    got = {r["src"].rsplit("/", 1)[1]: r["file"] for r in files.binaries(spark, str(tmp_path)).collect()}
    assert got["a.PNG"].endswith(".png") and len(got["a.PNG"]) == 68
    assert files.folder_size(spark, str(tmp_path)) == (10, 2)


def test_markdown_sink(spark, tmp_path):
    texts = spark.createDataFrame([("01.md", "# a\n\nb"), ("a/02.md", "c\n")], "filename string, text string")
    assert rows(files.write_markdown(texts, str(tmp_path / "md"))) == [("01.md", 7), ("a/02.md", 2)]
    held = {str(p.relative_to(tmp_path / "md")): p.read_text() for p in (tmp_path / "md").rglob("*.md")}
    assert held == {"01.md": "# a\n\nb\n", "a/02.md": "c\n"} and [p.name for p in tmp_path.iterdir()] == ["md"]
    files.write_markdown(texts.where("filename = '01.md'"), str(tmp_path / "md"))
    assert [p.name for p in (tmp_path / "md").rglob("*.md")] == ["01.md"]


def test_many_named_files(spark, tmp_path):
    path = str(tmp_path / "md")
    texts = spark.range(3000).select(F.concat(F.lit("d"), F.col("id") % 7, F.lit("/"), "id", F.lit(".md")).alias("filename"), F.concat(F.lit("# "), "id").alias("text"))
    files.write_markdown(texts, path)
    held = list((tmp_path / "md").rglob("*"))
    assert sum(p.is_file() for p in held) == 3000 and (tmp_path / "md/d3/10.md").read_text() == "# 10\n" and [p.name for p in tmp_path.iterdir()] == ["md"]
    with pytest.raises(Exception, match="boom"):
        files.write_markdown(texts.withColumn("text", F.when(F.col("filename") == "d3/10.md", F.raise_error(F.lit("boom"))).otherwise("new")), path)
    for wrong in (["a.md", "a.md"], ["../a.md"], [""]):
        with pytest.raises(Exception, match="names|no name"):
            files.write_markdown(spark.createDataFrame([(n, "x") for n in wrong], "filename string, text string"), path)
    assert (tmp_path / "md/d3/10.md").read_text() == "# 10\n"
    files.write_markdown(texts.limit(0), path)
    assert [p.name for p in tmp_path.iterdir()] == ["md"] and not list((tmp_path / "md").iterdir())


def test_purge_is_dry_by_default(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "f").write_text("abc")
    targets = {"cache": [str(tmp_path / "c")]}
    assert files.purge(spark, targets, ["cache"]) == [("cache", 3, 1)] and (tmp_path / "c").exists()
    with pytest.raises(ValueError):
        files.purge(spark, targets, ["other"], really=True)
    files.purge(spark, targets, ["cache"], really=True)
    assert not (tmp_path / "c").exists()


def test_pdf_pages_keep_their_numbers(spark):
    df = spark.createDataFrame([("b", "one\f\fthree")], "book string, text string")
    assert rows(pdf.pages_of_text(df)) == [("b", 1, "one"), ("b", 2, ""), ("b", 3, "three")]


CONFIG = """
[crawl]
base_url = "https://h/"
[[books]]
slug = "book-i"
pvid = "1"
min_documents = 1
[[books]]
slug = "book-ii"
pvid = "2"
"""


def test_books(spark, tmp_path):
    (tmp_path / "config.toml").write_text(CONFIG)
    (tmp_path / "x" / "y").mkdir(parents=True)
    settings = config.load(config.find(str(tmp_path / "x" / "y")))
    assert [(r["slug"], r["roman"]) for r in config.books(spark, settings).orderBy("ord").collect()] == [("book-i", "Libro I"), ("book-ii", "Libro II")]
    with pytest.raises(ValueError, match="unknown book: z"):
        config.books(spark, settings, ["z"])


def test_stages(spark, tmp_path, capsys):
    (tmp_path / "config.toml").write_text(CONFIG)
    out = tmp_path / "data"
    page = '<h2 class="titulo">Uno</h2><p class="margen-abajo-xs small aid-1 cid-2">Libro I</p><div id="cuerpo_documento"><p>1. ' + "palabra " * 40 + "</p><!--end-box-->"
    pages = spark.createDataFrame([("book-i", 11, page), ("book-i", 12, page.replace("Uno", "Dos"))], "book string, page_id long, html string")
    pages.write.parquet(str(out / "pages"))
    args = ["-b", "book-i", "--config", str(tmp_path / "config.toml"), "--out", str(out)]
    assert cli.main([*args, "parse", "changes", "export"], spark) == 0
    docs = spark.read.parquet(str(out / "documents"))
    assert rows(docs.select("pvid", "citation")) == [("11", "Libro I, Uno"), ("12", "Libro I, Dos")]
    assert not (out / "changes").exists()
    pages.withColumn("html", F.replace("html", F.lit("palabra"), F.lit("vocablo"))).write.mode("overwrite").parquet(str(out / "pages"))
    assert cli.main([*args, "parse", "changes"], spark) == 0
    assert rows(spark.read.parquet(str(out / "changes")).select("doc_id", "category")) == [("11", "editorial"), ("12", "editorial")]
    with pytest.raises(SystemExit):
        cli.main([*args, "parse", "nope"], spark)
    assert spark.read.json(str(out / "timings")).where("ok").count() == 5


def test_streamed_snapshots(spark, tmp_path):
    source, state, report = (str(tmp_path / x) for x in ("in", "state", "report"))
    schema = "doc_id long, source_sha256 string, content_sha256 string, notes array<string>"
    spark.createDataFrame([(1, "a", "a", []), (2, "b", "b", [])], schema).write.parquet(source)
    run = lambda: feeds.track(spark.readStream.schema(schema).parquet(source), state, report, str(tmp_path / "ck")).awaitTermination()
    run()
    spark.createDataFrame([(2, "x", "b", []), (3, "c", "c", [])], schema).write.mode("append").parquet(source)
    run()
    assert rows(versions.read(spark, report).select("doc_id", "category")) == [(2, "cosmetic"), (3, "new")]
    assert versions.read(spark, state).count() == 3
    spark.createDataFrame([(3, "d", "d", []), (3, "c", "z", []), (2, "x", "b", [])], schema).coalesce(1).write.mode("append").parquet(source)
    shutil.copytree(tmp_path / "ck", tmp_path / "before")
    for _ in range(2):  # the second time as after a crash before the checkpoint was written
        run()
        shutil.rmtree(tmp_path / "ck")
        shutil.copytree(tmp_path / "before", tmp_path / "ck")
    assert rows(versions.read(spark, report).select("doc_id", "category")) == [(2, "cosmetic"), (3, "editorial"), (3, "new")]


def test_run_log_stream(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"book": "x", "n": 1}) + "\n")
    got = feeds.drain(feeds.run_log(spark, str(tmp_path), "book string, n long"), "append")
    assert rows(got) == [("x", 1)]




def test_pages_of_bytes_that_are_no_text(spark, tmp_path):
    (tmp_path / "7.html").write_bytes(b"<p>caf\xe9 \xff</p>")
    assert rows(files.html_pages(spark, str(tmp_path))) == [("7", "<p>caf\ufffd \ufffd</p>")]


def test_json_document(spark, tmp_path):
    (tmp_path / "d.json").write_text('[\n  {"id": "a",\n   "n": 1},\n  {"id": "b"}\n]')
    assert rows(files.json_document(spark, str(tmp_path / "d.json"), "id string, n long")) == [("a", 1), ("b", None)]
    assert files.json_document(spark, str(tmp_path / "none"), "id string").count() == 0
    again = str(tmp_path / "e.json")
    for _ in range(2):
        files.write_json_document(spark.createDataFrame([("b", None), ("a", 1), ("ñ", 2)], "id string, n long"), again, ["id"])
    assert (tmp_path / "e.json").read_text().startswith('[\n  {\n    "id": "a",\n    "n": 1\n  },') and rows(files.json_document(spark, again, "id string, n long")) == [("a", 1), ("b", None), ("ñ", 2)]
    assert not list(tmp_path.glob("*staging*"))
    with pytest.raises(ValueError):
        files.write_json_document(spark.range(3), again, ["id"], most=2)


def test_crawl_of_any_depth(spark):
    pages = spark.createDataFrame([(str(i), f'<nav><a href="/{i + 1}">t</a></nav>') for i in range(80)], "page_id string, html string")
    assert {int(r["id"]): r["depth"] for r in web.crawl(pages, "0").collect()} == {i: i + 1 for i in range(81)}


def test_state_of_conditional_requests(spark, tmp_path):
    path, schema = str(tmp_path / "state"), "book string, id string, status int, etag string, last_modified string"
    assert files.http_state(spark, path).count() == 0
    files.keep_http_state(spark.createDataFrame([("a", "1", 200, "x", ""), ("a", "2", 200, "y", ""), ("b", "1", 404, "", "")], schema), path)
    files.keep_http_state(spark.createDataFrame([("a", "1", 200, "z", "d"), ("a", "2", 304, "", ""), ("b", "1", 200, "w", "")], schema), path)
    assert rows(files.http_state(spark, path)) == [("a", "1", "z", "d"), ("a", "2", "y", ""), ("b", "1", "w", "")]


def test_agents_take_turns():
    c, site = client(*[Answer(200, b"x")] * 4)
    for _ in range(4):
        c.fetch("https://h/a")
    names = [headers["User-Agent"] for _, _, headers in site.asked]
    assert names[:3] == list(web.AGENTS) and names[3] == names[0]
    c, site = client(Answer(200, b"x"))
    c.agents = ()
    c.fetch("https://h/a")
    assert site.asked[0][2]["User-Agent"] == web.AGENTS[0]


@pytest.fixture
def site():
    """A site on this machine: pages with menus and images, one page that is not there, and how often each was asked for."""
    import http.server
    import threading

    pages = {
        "/r": b'<nav><a href="/a">A</a><a href="/b">B</a></nav><img src="i/1.PNG">', "/a": b'<nav><a href="/r">R</a><a href="/gone">G</a></nav><img src="i/2.png">caf\xe9', "/b": b'<nav><a href="/a">A</a></nav><article>x</article><img src="i/no.png">',
        "/i/1.PNG": b"one", "/i/2.png": b"one",
    }
    asked = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            asked.append(self.path)
            body = pages.get(self.path)
            tag = f'"{self.path}"'
            self.send_response(404 if body is None else 304 if self.headers.get("If-None-Match") == tag else 200)
            body = b"" if body is None or self.headers.get("If-None-Match") == tag else body
            self.send_header("ETag", tag)
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/", asked
    server.shutdown()


def test_crawl_of_a_site_with_its_images(spark, site):
    base, asked = site
    pages = web.crawl_site(spark, base, "r", 2)
    got = {r["page_id"]: (r["html"], r["error"]) for r in pages.collect()}
    assert set(got) == {"r", "a", "b", "gone"} and got["a"][0].endswith("caf\ufffd") and "404" in got["gone"][1]
    assert sorted(asked) == ["/a", "/b", "/gone", "/r"]
    tree = {r["id"]: (r["parent"], r["depth"]) for r in web.crawl(pages.where("html is not null"), "r").collect()}
    assert tree == {"r": (None, 1), "a": ("r", 2), "b": ("r", 2), "gone": ("a", 3)}
    images = web.new_images(pages, spark.createDataFrame([("i/0.png",)], "src string"), base, 2).collect()
    files_ = {r["src"]: r["file"] and r["file"][64:] for r in images}
    assert files_ == {"i/1.PNG": ".png", "i/2.png": ".png", "i/no.png": None} and len({r["sha256"] for r in images if r["sha256"]}) == 1
    again = web.fetched(spark.createDataFrame([(base + "a", '"/a"', None)], "url string, etag string, last_modified string")).first()
    assert (again["status"], again["content"], again["error"]) == (304, None, None)


def test_programs_for_pdf_files(tmp_path, monkeypatch):
    """What poppler's programs print becomes rows; these stand in for them."""
    import pandas as pd

    for name, script in {"pdfinfo": 'echo "Title: x"; echo "Pages:          3"', "pdftotext": 'printf "one\\ftwo\\f"', "pdfimages": 'printf a > "$4-002-000.png"; printf b > "$4-010-001.png"'}.items():
        (tmp_path / name).write_text(f"#!/bin/sh\n{script}\n")
        (tmp_path / name).chmod(0o755)
    monkeypatch.setenv("PATH", f"{tmp_path}:/usr/bin:/bin")
    assert pdf.available() and pdf.page_count(b"%PDF") == 3
    batch = pd.DataFrame({"path": ["f.pdf"], "content": [b"%PDF"]})
    (texts,) = pdf._texts(iter([batch]))
    assert texts.to_dict("records") == [{"path": "f.pdf", "pages": 3, "text": "one\ftwo\f"}]
    images = pd.concat(pdf._images(iter([batch])))
    assert [tuple(r) for r in images[["page", "n", "content"]].itertuples(index=False)] == [(2, 0, b"a"), (10, 1, b"b")]


def test_summary_of_a_stage(spark):
    from foliospark.operators import guard

    totals = spark.createDataFrame([("b", 2, 5), ("a", 1, 0)], "book string, documents long, units long")
    assert guard.summary("parse", totals, {"images are missing": 2, "pages are missing": 0}) == [
        "parse: a: 1 documents, 0 units", "parse: b: 2 documents, 5 units", "parse: total: 3 documents, 5 units", "warning: parse: 2 images are missing",
    ]
