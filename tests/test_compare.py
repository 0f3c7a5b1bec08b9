import random
import re
from collections import Counter

from pyspark.sql import functions as F

from foliospark.operators import compare, render
from foliospark.sources import bundle, download, monitor
from tests.conftest import rows
from tests.test_sources import Answer, client


def test_alignment_and_coverage(spark):
    one = "Uno trata de los plazos y de la forma en que se cuentan para todos los efectos de esta norma"
    two = "Dos trata de otra cosa por completo distinta que nadie ha escrito antes en ninguna parte del texto"
    docs = spark.createDataFrame([("b", 1, "Libro I", "Uno", one), ("b", 2, "Libro I, Letra B", "Dos", two), ("b", 3, "Libro I", "Nada", "sin huella en el otro lado de las cosas aqui")], "book string, id long, path string, title string, markdown string")
    pages = spark.createDataFrame([("b", 1, "Portada Libro I Uno " + one), ("b", 2, ""), ("b", 3, "Libro I, Letra B Dos " + two.replace("completo", "entero"))], "book string, page long, text string")
    other = compare.aligned(docs, pages)
    assert rows(other.select("id", "page", "page_end", "anchored_by", "occurrences")) == [(1, 1, 1, "heading", 1), (2, 3, 3, "heading", 1)]
    found = {r["id"]: r for r in compare.compared(docs, other).collect()}
    assert found[1]["verdict"] == "match" and found[1]["only_in_pdf"] == 0 and found[1]["coverage_web"] == 1.0
    assert found[2]["only_in_pdf"] == 7 and found[2]["verdict"] == "extra_in_pdf"
    total = compare.report(docs, compare.compared(docs, other)).first()
    assert (total["documents"], total["aligned"], total["unanchored"], total["match"], total["extra_words_in_pdf"]) == (3, 2, 1, 1, 7)


def test_alignment_in_slices_of_pages(spark, monkeypatch):
    """No row holds more of a book than a slice, whatever its length, and pieces come out whole."""
    from foliospark.operators import align

    monkeypatch.setattr(align, "SLICE", 97)
    bodies = {i: " ".join(f"p{i}x{k}" for k in range(i * 3 % 50)) for i in range(40)}
    docs = spark.createDataFrame([("ab"[i % 2], i, f"Libro {i % 2}, Letra {i}", f"Norma {i} fin", t) for i, t in bodies.items()], "book string, id long, path string, title string, markdown string")
    pages = docs.selectExpr("book", "id as page", "concat_ws(' ', path, title, markdown) as text")
    held = align.placed(pages)
    cut = align.slices(held, 97, 20)
    whole = {b: " ".join(r["text"] for r in sorted(held.where(f"book = '{b}'").collect(), key=lambda r: r["page"])) for b in "ab"}
    assert {(r["book"], r["begin"]): r["text"] for r in cut.collect()} == {(b, k): t[k : k + 117] for b, t in whole.items() for k in range(0, len(t), 97)}
    assert all(whole[r["book"]][r["start"] :].startswith(r["text"]) for r in held.collect())
    other = compare.aligned(docs, pages)
    assert rows(other.select("id", "text", "page", "page_end", "anchored_by")) == sorted(((i, t, i, i, "heading") for i, t in bodies.items() if t), key=repr)


def test_books_do_not_meet_every_document(spark, monkeypatch):
    """Each slice is passed over once, however many documents there are: nothing of them but a filter reaches the tasks."""
    from foliospark.operators import align

    monkeypatch.setattr(align, "PATTERNS", 10)
    monkeypatch.setattr(align, "pattern_blocks", None)
    docs = spark.createDataFrame([("b", i, f"Libro {i},", f"N {i}.", "") for i in range(50)], "book string, id long, path string, title string, body string")
    books = spark.createDataFrame([("b", " ".join(f"Libro {i}, N {i}." for i in range(50)))], "book string, text string")
    made, _ = align.pattern_filter(docs)
    assert made.nbytes == 1 << 13 and rows(align.anchors(docs, books).select("id")) == sorted(((i,) for i in range(50)), key=repr)


def test_report_is_the_same_for_any_slices(spark, monkeypatch):
    """Books are no single values: a report counts the same however their texts are cut, and takes no whole text."""
    from foliospark.operators import align

    docs = spark.createDataFrame([("ab"[i % 2], i, f"Libro {i % 2}, Letra {i}", f"Norma {i} fin", " ".join(f"p{i}x{k}" for k in range(i + 1))) for i in range(30)], "book string, id long, path string, title string, markdown string")
    pages = docs.where("id % 5 > 0").selectExpr("book", "id as page", "concat_ws(' ', path, title, if(id % 3 = 0, replace(markdown, 'x', 'y'), markdown)) as text")
    found = []
    for width in (61, 50_000):
        monkeypatch.setattr(align, "SLICE", width)
        found.append(rows(compare.report(docs, compare.compared(docs, compare.aligned(docs, pages)))))
    assert found[0] == found[1] and [(r[0], r[1], r[2], r[-1]) for r in found[0]] == [("a", 15, 12, 3), ("b", 15, 12, 3)] and not hasattr(compare, "joined_text")


def test_sections_are_numbered_over_ranges(spark):
    """No task numbers, and no window holds, all texts of a book."""
    docs = spark.createDataFrame([("ab"[i % 2], 99 - i, f"t{i}", i, i + i % 3, "unaligned" if i == 7 else "match", f"body {i}") for i in range(40)], "book string, id long, title string, page long, page_end long, verdict string, body string")
    got = render.publication_section(docs, ["book"], ["id"])
    assert "_n_part" in got._jdf.queryExecution().toString()
    heads = [(r["book"], r["section"], r["line"]) for r in got.where("ord = 0").collect()]
    assert sorted(heads) == sorted((b, k + 1, f"## t{i}") for j, b in enumerate("ab") for k, i in enumerate(range(38 + j, -1, -2)))
    assert got.where("book = 'b' and line like '> **unaligned**%'").count() == 1


def test_verified_download(tmp_path):
    path = tmp_path / "a" / "f.pdf"
    c, _ = client(Answer(200, ETag='"1"', Content_Length="2"), Answer(200, b"ok"))
    state, marks = download.fetch(c, "https://h/f", path, {}, lambda p: [])
    assert state == "stored" and path.read_bytes() == b"ok" and marks["etag"] == '"1"'
    c, _ = client(Answer(304))
    assert download.fetch(c, "https://h/f", path, marks, lambda p: ["never asked"])[0] == "unchanged"
    c, _ = client(Answer(200, Content_Length="2"))
    assert download.fetch(c, "https://h/f", path, {}, lambda p: ["never asked"])[0] == "unchanged"
    c, _ = client(Answer(200, ETag='"2"'), Answer(200, b"bad"))
    try:
        download.fetch(c, "https://h/f", path, marks, lambda p: ["header says Libro II"])
        raise AssertionError("must not be stored")
    except ValueError as e:
        assert "Libro II" in str(e)
    assert path.read_bytes() == b"ok" and [p.name for p in path.parent.iterdir()] == ["f.pdf"]


def test_monitor(spark):
    counters = monitor.Counters()
    watch = monitor.Monitor(counters, window=2)
    for _ in range(3):
        counters.add("requests", 2)
        watch.take()
    got = watch.rows(spark).orderBy("elapsed").collect()
    assert [r["counters"]["requests"] for r in got] == [4.0, 6.0] and got[0]["rss"] > 0
    counters.reset()
    assert counters.read() == {}


def test_bundle(spark, tmp_path):
    sections = spark.createDataFrame([("a", "01.md", "x"), ("b", "01.md", "y")], "book string, filename string, text string")
    lines = spark.createDataFrame([("a", 0, 1, "two"), ("a", 0, 0, "one"), ("b", 0, 0, "b")], "book string, section int, ord long, line string")
    root = lines.where("book = 'b'").drop("book")
    assert [r[0] for r in rows(bundle.bundle(sections, lines, root, str(tmp_path / "o"), 2))] == ["a/01.md", "a/index.md", "b/01.md", "b/index.md", "index.md"]
    assert "index.md" not in [r[0] for r in rows(bundle.bundle(sections.where("book = 'a'"), lines, root, str(tmp_path / "o"), 2))]


def test_root_index_needs_all_books(spark):
    books = spark.createDataFrame([("a", 1, 1, 1, 1000)], "book string, documents long, units long, notes long, words long")
    topics = spark.createDataFrame([("t", ["a"])], "topic string, in_books array<string>")
    recent = spark.createDataFrame([(7, "2020-01-02")], "number long, date string")
    assert render.root_index(books, topics, 2, recent).count() == 0
    assert "| a | 1 | 1 | 1 | 1.000 |" in [r["line"] for r in render.root_index(books, topics, 1, recent).collect()]


def _brute(docs, other, n=8):
    """Counts of both sides by key, word by word: n-gram positions, those that the other side's book lacks, words lacking."""
    tokens = lambda t: re.findall(r"\w+", t.lower())
    runs = lambda w: [tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))] if w else []
    out = {}
    for name, own, whole in (("pdf", [(b, i, t) for b, i, t in other], [(b, f"{p} {t} {m}") for b, _, p, t, m in docs]), ("web", [(b, i, m) for b, i, _, _, m in docs], [(b, t) for b, _, t in other])):
        known, bag = {(b, g) for b, t in whole for g in runs(tokens(t))}, Counter((b, w) for b, t in whole for w in tokens(t))
        for b, i, t in own:
            w = tokens(t)
            shared = sum(min(c, bag[b, x]) for x, c in Counter(w).items()) / len(w) if w else 1.0
            out[b, i, name] = (len(runs(w)), sum((b, g) not in known for g in runs(w)), round(shared, 9))
    return out


def test_counts_of_both_sides_equal_brute_force(spark, monkeypatch):
    """Texts that equal their mates, short ones, changed ones, copies in other documents, words that stand more often, empty ones; in any blocks."""
    draw = random.Random(3)
    some = lambda k: " ".join(draw.choice("ab cd ef gh ñu ij kl mn op qr".split()) for _ in range(k))
    docs, other = [], []
    for i in range(120):
        b, text = "xyz"[i % 3], some(draw.choice((0, 1, 3, 7, 8, 9, 30)))
        docs.append((b, i, "" if i % 5 == 0 else f"L {i}", "" if i % 5 == 0 else f"T {i}", text))
        kind = draw.choice("same same change other more drop".split())
        if kind != "drop":
            other.append((b, i, {"same": text, "change": text.replace("ab", "zz"), "other": some(20), "more": f"{text} {text} ab"}[kind]))
    d = spark.createDataFrame(docs, "book string, id long, path string, title string, markdown string")
    o = spark.createDataFrame([(*x, "heading", 1, 1) for x in other], "book string, id long, text string, anchored_by string, page long, page_end long")
    want = _brute(docs, other)
    for block in (1_000_000, 25):
        monkeypatch.setattr(compare, "BLOCK", block)
        for n in (8, 3):
            want = _brute(docs, other, n)
            got = {(r["book"], r["id"], s): (r[f"{s}_words"], r[f"only_in_{s}"], round(r[f"lexical_{s}"], 9)) for r in compare.compared(d, o, n=n).collect() for s in ("pdf", "web")}
            assert got == {k: v for k, v in want.items() if k[:2] in {x[:2] for x in other}}


def test_words_are_told_once_and_equal_texts_are_not_searched(spark):
    """The report splits no text again, and no n-gram of a text that stands unchanged on the other side is shuffled."""
    docs = spark.createDataFrame([("b", i, f"L {i}", f"T {i}", " ".join(f"w{i}x{k}" for k in range(20))) for i in range(30)], "book string, id long, path string, title string, markdown string")
    other = docs.selectExpr("book", "id", "if(id = 7, concat(markdown, ' end'), markdown) as text", "'heading' as anchored_by", "id as page", "id as page_end")
    got = compare.report(docs, compare.compared(docs, other))
    assert "regexp_extract_all" not in got._jdf.queryExecution().optimizedPlan().toString()
    h = F.transform(F.split("text", " "), lambda w: F.xxhash64(w))
    web, pdf = (x.select("book", F.col("id").cast("string").alias("key"), F.array().cast("array<bigint>").alias("lead"), h.alias("h")) for x in (docs.withColumnRenamed("markdown", "text"), other))
    pairs = compare.paired(pdf, web)
    assert pairs.count() == 1 and rows(compare.asked_grams(pairs).select("key", "pos")) == [("7", 13)] and compare.asked_words(pairs).count() == 1


def test_page_texts_are_made_once(spark):
    """Ranges are told from what is written: samples do not make the texts a second time, nor does the search for empty ones."""
    from foliospark.operators import align

    made = spark.sparkContext.accumulator(0)

    def text(i: int) -> str:
        made.add(1)
        return f"page {i}" if i % 4 else ""

    pages = spark.range(40).select(F.lit("b").alias("book"), F.col("id").alias("page"), F.udf(text)("id").alias("text"))
    assert align.placed(pages).count() == 30 and made.value == 40
