"""The whole chain of stages on a small site: what is written, and what a second run finds."""

import http.server
import threading

import pytest

from foliospark import cli
from foliospark.sources import versions
from tests.conftest import rows

CONFIG = """
[crawl]
base_url = "{base}"
page = "w3-propertyvalue-{{}}.html"
menu = '(?s)id="menu">(.*?)</div>'
pause = 0
[[books]]
slug = "book-i"
pvid = "1"
pdf_file = "book-i.txt"
min_documents = 3
[[books]]
slug = "book-ii"
pvid = "50"
min_documents = 1
"""
WORDS = "la pensión se calcula según las reglas que fija este capítulo y se paga cada mes "


def page(title, crumbs=(), kids=(), body="", topics=()):
    menu = "".join(f'<a class="x" href="w3-propertyvalue-{i}.html" title="t">{t}</a>' for i, t in kids)
    path = ", ".join(crumbs)
    voices = '<p class="voces">Materias asociadas:' + "".join(f'<a href="#">{t}</a>' for t in topics) + "</p>" if topics else ""
    text = f'<div id="cuerpo_documento">{body}<!--end-box-->' if body else ""
    return f'<title>{title}</title><div id="menu">{menu}</div><p class="margen-abajo-xs small aid-1 cid-2">{path}</p><h2 class="titulo">{title}</h2>{voices}{text}'


def numbered(*texts):
    return "".join(f"<p>{i}. {t}</p>" for i, t in enumerate(texts, 1))


class Site:
    """A site whose files can be changed; validators are digests."""

    def __init__(self):
        self.files, self.asked = {}, []
        site = self

        class Handler(http.server.BaseHTTPRequestHandler):
            def answer(self, body_too):
                name = self.path[1:]
                site.asked.append(name)
                body = site.files.get(name)
                tag = f'"{hash(body)}"'
                same = body is not None and self.headers.get("If-None-Match") == tag
                self.send_response(404 if body is None else 304 if same else 200)
                data = b"" if body is None or same else body.encode()
                self.send_header("ETag", tag)
                self.send_header("Content-Length", str(len(data)))
                self.end_headers()
                if body_too:
                    self.wfile.write(data)

            def do_GET(self):
                self.answer(True)

            def do_HEAD(self):
                self.answer(False)

            def log_message(self, *args):
                pass

        self.server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.base = f"http://127.0.0.1:{self.server.server_port}/"

    def put(self, i, *args, **kw):
        self.files[f"w3-propertyvalue-{i}.html"] = page(*args, **kw)


@pytest.fixture
def site():
    made = Site()
    one = "Libro I. Todo"
    made.put(1, one, kids=[(9, "Título II. Otro"), (3, "Título I. Uno")])
    made.put(3, "Título I. Uno", (one,), [(4, "Capítulo I. Cálculo"), (5, "Capítulo II. Plazos")])
    made.put(4, "Capítulo I. Cálculo", (one, "Título I. Uno"), body=numbered(WORDS * 3, "Se suma el monto " + WORDS) + '<img src="i/a.png">', topics=["Vejez"])
    made.put(5, "Capítulo II. Plazos", (one, "Título I. Uno"), body=numbered("El plazo es de un mes " + WORDS, "El pago es mensual " + WORDS), topics=["Vejez", "Pagos"])
    made.put(9, "Título II. Otro", (one,), body=numbered("El título que sigue trata de otra cosa " + WORDS * 2) + "<h6>Nota de actualización: Este Título fue modificado por la Norma de Carácter General N° 12, de fecha 3 de marzo de 2015.</h6>")
    made.put(50, "Libro II. Nada", kids=[(51, "Título I. Solo")])
    made.put(51, "Título I. Solo", ("Libro II. Nada",), body=numbered("Un texto que está solo " + WORDS * 2), topics=["Vejez"])
    made.files["i/a.png"] = "picture"
    head = "Compendio - Libro I\n"
    body = [f"{one}, Título I. Uno Capítulo I. Cálculo 1. " + WORDS * 3 + "2. Se suma el monto " + WORDS, f"{one}, Título I. Uno Capítulo II. Plazos 1. El plazo es de un mes " + WORDS + "2. El pago es otro y no lo dice el portal en ninguna de sus páginas " + WORDS]
    made.files["book-i.txt"] = "\f".join(head + b for b in body)
    yield made
    made.server.shutdown()


def test_the_chain_of_stages(spark, site, tmp_path, capsys):
    (tmp_path / "config.toml").write_text(CONFIG.format(base=site.base))
    out = tmp_path / "data"
    args = ["--config", str(tmp_path / "config.toml"), "--out", str(out)]
    assert cli.main(args, spark) == 0

    text = {str(p.relative_to(out / "markdown")): p.read_text() for p in (out / "markdown").rglob("*.md")}
    assert sorted(text) == ["book-i/01-01-titulo-ii.md", "book-i/02-02-titulo-i.md", "book-ii/01-01-titulo-i.md"]  # by title, as the menu has them
    first = text["book-i/02-02-titulo-i.md"]
    assert first.startswith('---\nbook: book-i\nsection_pvid: 3\nlevel: title\norder: 2\npart: 1\nparts: 1\ntitle: "Título I. Uno"\npath: "Libro I. Todo, Título I. Uno"\ndocuments: ["4","5"]\nsource: web\n---\n\n# Título I. Uno\n\n## Capítulo I. Cálculo\n\n**Cita:** Libro I. Todo, Título I. Uno, Capítulo I. Cálculo\n\n*Materias: Vejez*\n\n1. la pensión')
    assert first.index("## Capítulo I. Cálculo\n") < first.index("## Capítulo II. Plazos\n") and f"![Figura]({site.base}i/a.png)" in first
    assert first.endswith(f"**Fuente oficial:** Libro I. Todo, Título I. Uno, Capítulo II. Plazos · {site.base}w3-propertyvalue-5.html\n")
    assert "# Título II. Otro\n\n**Cita:**" in text["book-i/01-01-titulo-ii.md"]

    judged = {r["id"]: r for r in spark.read.parquet(str(out / "coverage")).collect()}
    assert judged["4"]["verdict"] == "match" and judged["5"]["verdict"] != "match" and "no lo dice el portal" in judged["5"]["extra_in_pdf"][0]
    assert rows(spark.read.parquet(str(out / "coverage_report")).where("book = 'book-i'").select("documents", "aligned", "unanchored")) == [(3, 2, 1)]
    report = (out / "comparison" / "book-i.md").read_text()
    assert "no lo dice el portal" in report and (out / "publication_markdown" / "book-i.md").read_text().startswith("## Capítulo I. Cálculo")

    made = {str(p.relative_to(out / "bundle")) for p in (out / "bundle").rglob("*.md")}
    assert made == {"index.md", "book-i/index.md", "book-ii/index.md", *text}
    index = (out / "bundle" / "book-i" / "index.md").read_text()
    assert "| Vejez | Título I. Uno |" in index and "| 12 | 03-03-2015 |" in index.replace("/", "-")
    assert "Vejez" in (out / "bundle" / "index.md").read_text()
    assert not (out / "changes").exists() and spark.read.json(str(out / "timings")).where("ok").count() == 7

    # a second run: numbers change, one is added, a document goes and one comes
    site.put(5, "Capítulo II. Plazos", ("Libro I. Todo", "Título I. Uno"), body=numbered("Un número nuevo " + WORDS, "El plazo es de un mes " + WORDS, "El pago es anual " + WORDS), topics=["Pagos"])
    site.put(50, "Libro II. Nada", ("Libro II. Nada",), body=numbered("Ahora es el libro mismo " + WORDS * 2))
    site.asked.clear()
    capsys.readouterr()
    assert cli.main([*args, "refresh", "parse", "changes"], spark) == 0
    assert sorted(site.asked) == sorted(f"w3-propertyvalue-{i}.html" for i in (1, 3, 4, 5, 9, 50))
    assert rows(spark.read.parquet(str(out / "changes")).select("doc_id", "category")) == [("5", "editorial"), ("50", "new"), ("51", "removed")]
    events = rows(spark.read.parquet(str(out / "unit_events")).select("book", "type", "number", "from_number"))
    assert events == [("book-i", "added", "3", None), ("book-i", "modified", "1", None), ("book-i", "modified", "2", None)]
    (log,) = (out / "changelog").rglob("book-i.md")
    assert "## editorial (1)\n\n### Libro I. Todo, Título I. Uno, Capítulo II. Plazos\n" in log.read_text() and "- **N° 1 modified**\n\n```diff\n" in log.read_text()
    assert cli.main([*args, "changes"], spark) == 0
    assert spark.read.parquet(str(out / "changes")).count() == 0

    # one book alone leaves the other's rows
    site.put(4, "Capítulo I. Cálculo", ("Libro I. Todo", "Título I. Uno"), body=numbered(WORDS * 4))
    assert cli.main(["-b", "book-i", *args, "refresh", "parse", "changes", "export"], spark) == 0
    assert rows(spark.read.parquet(str(out / "changes")).select("doc_id", "category")) == [("4", "editorial")]
    assert rows(spark.read.parquet(str(out / "documents")).select("pvid")) == [("4",), ("5",), ("50",), ("9",)]
    assert len(list((out / "markdown").rglob("*.md"))) == 3
    assert versions.read(spark, str(out / "state")).count() == 4


def test_a_publication_of_another_book_is_not_taken(spark, site, tmp_path):
    (tmp_path / "config.toml").write_text(CONFIG.format(base=site.base))
    out = tmp_path / "data"
    args = ["-b", "book-i", "--config", str(tmp_path / "config.toml"), "--out", str(out)]
    assert cli.main([*args, "crawl", "parse"], spark) == 0
    site.files["book-i.txt"] = site.files["book-i.txt"].replace("Compendio - Libro I\n", "Compendio - Libro IV\n")
    with pytest.raises(ValueError, match="header says Libro IV"):
        cli.main([*args, "pdf"], spark)
    assert not (out / "publication").exists() and not list((out / "books").iterdir())
    assert not spark.read.json(str(out / "timings")).where("stage = 'pdf'").first()["ok"]
