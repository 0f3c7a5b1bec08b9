import random
import re
import time

import pytest
from pyspark.sql import functions as F

from foliospark.operators import align, analytics, changes, coverage, guard, index, sections, tree, units
from tests.conftest import rows


def packed(spark, sizes, cap=15000, tail=2000):
    df = spark.createDataFrame([(sizes,)], "s array<long>")
    return df.select(sections.packed(F.col("s"), cap, tail).alias("p")).first()["p"]


@pytest.mark.parametrize("sizes, parts", [([7000, 7000, 6000], [1, 1, 2]), ([7000, 20000, 6000], [1, 2, 3]), ([14000, 600], [1, 1]), ([14000, 1600], [1, 1]), ([7000], [1]), ([], []), ([0, 20000], [1, 2])])
def test_packing(spark, sizes, parts):
    assert packed(spark, sizes) == parts


def test_pack_keeps_every_document(spark):
    df = spark.createDataFrame([("a", i, 4000) for i in range(9)] + [("b", 1, 1), (None, 2, 5)], "g string, o long, s long")
    got = sections.pack(df, "g", "o", "s")
    assert got.count() == 11
    assert {(r["g"], r["parts"]) for r in got.collect()} == {("a", 3), ("b", 1), (None, 1)}


def test_names_of_a_subset_are_those_of_the_whole(spark):
    title = F.lit("Título IV Algo")
    got = spark.range(1).select(sections.part_name(F.lit(7), F.lit(3), title, F.lit(2), F.lit(4)).alias("own"), sections.part_name(F.lit(7), F.lit(3), title, F.lit(2), F.lit(4), F.lit(3)).alias("next")).first()
    assert tuple(got) == ("07-03-titulo-iv-parte-2.md", "08-03-titulo-iv-parte-3.md")


def test_tree_reads_children_in_listed_order(spark):
    nodes = spark.createDataFrame([("r", None, 0), ("b", "r", 1), ("a", "r", 2), ("c", "b", 10), ("d", "b", 2), ("lost", "gone", 0)], "id string, parent string, sib_ord long")
    levelled = tree.levels(nodes)
    order = [r["id"] for r in tree.preorder(levelled).orderBy("position").collect()]
    assert order == ["r", "b", "d", "c", "a"]
    assert {r["id"] for r in tree.leaves(nodes).collect()} == {"a", "c", "d", "lost"}


def test_nearest_ancestor_falls_to_finer_levels_then_root(spark):
    nodes = spark.createDataFrame([("r", None, 0), ("t", "r", 1), ("l", "t", 1), ("x", "l", 1), ("l2", "r", 2), ("y", "l2", 1), ("z", "r", 3)], "id string, parent string, sib_ord long")
    kinds = spark.createDataFrame([("t", "title"), ("l", "letter"), ("l2", "letter")], "id string, kind string")
    got = dict(rows(tree.nearest(tree.levels(nodes), kinds, ["title", "letter"])))
    assert got == {"r": "r", "t": "t", "l": "t", "x": "t", "l2": "l2", "y": "l2", "z": "r"}


def unit_rows(spark, *us):
    return spark.createDataFrame([(1, o, f"1#{n or 'preamble'}", n, t, None) for o, (n, t) in enumerate(us)], "doc_id long, ordinal long, unit_id string, number string, text string, sha256 string").withColumn("sha256", F.sha2("text", 256))


CASES = [
    ([("3", "a"), ("4", "b")], [("5", "a"), ("6", "b")]),
    ([("1", "a")], [("1", "b")]),
    ([("1", "a")], [("1", "a")]),
    ([("3", "c"), ("4", "d")], [("3", "d")]),
    ([(None, "p"), ("1", "a")], [(None, "q"), ("1", "a")]),
    ([], [("1", "a")]),
    ([("1", "a"), ("2", "a")], [("1", "a")]),
]


@pytest.mark.parametrize("before, after", CASES)
def test_relational_events_equal_exact_ones(spark, before, after):
    a, b = unit_rows(spark, *before), unit_rows(spark, *after)
    fast = rows(units.events(a, b).select("type", "number", "from_number"))
    assert fast == rows(units.exact_events(a, b).select("type", "number", "from_number"))


def test_where_the_two_ways_differ(spark):
    """In reading order a new text claims its number's old unit before that unit's own text is met again."""
    a = unit_rows(spark, ("1", "a"), ("2", "b"))
    b = unit_rows(spark, ("1", "new"), ("2", "a"), ("3", "b"))
    assert rows(units.exact_events(a, b).select("type", "number")) == [("added", "3"), ("modified", "1"), ("modified", "2")]
    assert rows(units.events(a, b).select("type", "number")) == [("added", "1"), ("renumbered", "2"), ("renumbered", "3")]


def test_repeated_ids(spark):
    a = unit_rows(spark, ("1", "a"), ("1", "b"))
    b = unit_rows(spark, ("1", "c"), ("1", "b"))
    assert rows(units.exact_events(a, b).select("type", "number")) == [("added", "1"), ("modified", "1")]


def test_text_diff_is_capped():
    got = units.text_diff("\n".join(map(str, range(100))), "\n".join(f"x{i}" for i in range(100)))
    assert len(got.split("\n")) == 25 and got.endswith("líneas más)")


def test_segmentation(spark):
    docs = spark.createDataFrame([(1, "intro\n\n1. A\n\nmore\n\n2) B\n\n2.- no\n\n1.1. no\n\n1 - again"), (2, ""), (3, None)], "doc_id long, text string")
    got = rows(units.segment(docs).select("doc_id", "ordinal", "number", "text"))
    assert got == [(1, 0, None, "intro"), (1, 1, "1", "1. A\n\nmore"), (1, 2, "2", "2) B\n\n2.- no\n\n1.1. no"), (1, 3, "1", "1 - again")]


def test_classification(spark):
    schema = "doc_id long, source_sha256 string, content_sha256 string, notes array<string>"
    before = spark.createDataFrame([(i, "s", "c", ["n"]) for i in range(6)], schema)
    after = spark.createDataFrame([(0, "s", "c", ["n"]), (1, "s", "x", ["n"]), (2, "x", "c", ["n"]), (3, "x", "x", ["n"]), (4, "x", "x", ["n", "m"]), (9, "s", "c", None)], schema)
    got = {r["doc_id"]: r["category"] for r in changes.compare(before, after).collect()}
    assert got == {0: None, 1: "pipeline", 2: "cosmetic", 3: "editorial", 4: "normative", 5: "removed", 9: "new"}
    assert changes.compare(after, after).where("category is not null").count() == 0
    assert changes.summary(changes.compare(after, after)).first().asDict() == dict.fromkeys(changes.CATEGORIES, 0)


def test_coverage_of_nothing_is_whole(spark):
    docs = spark.createDataFrame([(1, ""), (2, "a b c"), (3, "x y z w v u t s r")], "doc_id long, text string")
    other = spark.createDataFrame([(1, "A b C"), (2, None)], "item_id long, text string")
    got = {r["doc_id"]: (r["total"], r["n_only"], r["coverage"], r["lexical"]) for r in coverage.judged(docs, other).collect()}
    assert got[1] == (0, 0, 1.0, 1.0)
    assert got[2] == (1, 0, 1.0, 1.0)
    assert got[3] == (2, 2, 0.0, 0.0)


def test_invariants(spark):
    limits = spark.createDataFrame([("a", "r", 2, 1), ("b", "r", 1, 0), ("c", "r", 1, 0)], "book string, root string, min_documents int, min_units int")
    docs = spark.createDataFrame([("a", "x" * 200, ["u"], [], [], "p"), ("b", "", [], [], [], None)], "book string, markdown string, units array<string>, figures array<string>, notes array<string>, path string")
    got = {r["book"]: r["problems"] for r in guard.problems(docs, limits).collect()}
    assert got["a"] == ["only 1 documents, expected >=2"]
    assert got["b"] == ["too few documents with a path", "too few documents with content"]
    assert got["c"] == ["only 0 documents, expected >=1"]
    with pytest.raises(guard.DegradedCorpus, match="c: only 0"):
        guard.enforce(guard.problems(docs, limits))
    assert len(guard.enforce(guard.problems(docs, limits), force=True)) == 4


def test_thinning_equals_a_loop(spark):
    rng = random.Random(5)
    events = [(1, i, h := rng.randrange(200), h + rng.randrange(30), "heading") for i in range(60)]
    kept, last = [], -1
    for _, i, h, b, how in sorted(events, key=lambda e: (e[2], e[3], e[4], e[1])):
        if not kept or h >= last:
            kept.append((i, h))
            last = b
    df = spark.createDataFrame(events, "book long, id long, head long, body_start long, how string")
    assert [(r["id"], r["head"]) for r in align.boundaries(df).orderBy("head", "body_start", "how", "id").collect()] == kept


def test_occurrences():
    text = "libro i, título 1 uno cuerpo libro i, título 1 uno otra"
    assert align.occurrences("libro i, título 1", "uno", "", text) == [(0, 21, "heading"), (29, 50, "heading")]
    assert align.occurrences("none", "", "y" * 50, "x" * 9 + "y" * 120) == [(9, 9, "body")]
    assert align.occurrences("none", "", "y" * 30, "y" * 120) == []


def test_latest_per_key(spark):
    df = spark.createDataFrame([(7, "2011-01-02", "b", 2), (7, "2012-01-01", "a", 3), (7, "2010-05-05", "b", 5)], "number long, date string, place string, o long")
    assert rows(index.latest(df, "number", "date", "place", "o")) == [(7, "2012-01-01", ["b", "a"])]


@pytest.mark.parametrize("values, median", [([1.0], 1.0), ([1.0, 2.0], 2.0), ([3.0, 1.0, 2.0], 2.0), ([1.0, 1.0, 5.0, 9.0], 5.0)])
def test_upper_median(spark, values, median):
    df = spark.createDataFrame([("s", v) for v in values], "g string, v double")
    assert rows(analytics.upper_median(df, "g", "v")) == [("s", median)]


def test_scope_ties_go_to_the_larger(spark):
    assert analytics.common_scope(spark.createDataFrame([(1,), (5,), (1,), (5,)], "n long"), "n").first()[0] == 5


def test_rates(spark):
    df = spark.createDataFrame([("a", 0.0, 0.0), ("a", 1.0, 10.0), ("a", 2.0, 12.0), ("a", 2.0, 20.0)], "g string, at double, v double")
    assert sorted(r["rate"] for r in analytics.rates(df, "g", F.col("at"), ["at", "v"], "v").collect()) == [0.0, 2.0, 10.0]


def test_charts(spark):
    bar = lambda v: spark.range(1).select(analytics.bar(F.lit(v), F.lit(10.0), 4)).first()[0]
    assert [bar(0.0), bar(10.0), bar(5.0), bar(99.0)] == ["", "████", "██", "████"]
    line = lambda v: spark.createDataFrame([(v,)], "v array<double>").select(analytics.sparkline(F.col("v"))).first()[0]
    assert line([2.0, 2.0]) == "⠤⠤" and line([]) == "" and line([0.0, 1.0])[-1] == analytics.BRAILLE[-1]


def test_prefix_semi(spark):
    crumbs = spark.createDataFrame([("Libro I, Tít",), ("Libro I, Título 1, Letra",), ("Libro II",), ("",)], "c string")
    known = spark.createDataFrame([("Libro I, Título 1",), ("",)], "p string")
    assert {r["c"] for r in align.prefix_semi(crumbs, known, "c", "p").collect()} == {"Libro I, Tít", "Libro I, Título 1, Letra"}


def test_page_of(spark):
    pages = spark.createDataFrame([("b", 1, "abc"), ("b", 2, ""), ("b", 3, "de")], "book string, page long, text string")
    starts = align.page_offsets(pages, "book", "page", "text")
    assert rows(starts) == [("b", 1, 0), ("b", 3, 4)]
    offsets = spark.createDataFrame([("b", 0), ("b", 3), ("b", 4), ("b", 99)], "book string, off long")
    assert rows(align.page_of(offsets, starts, "book", "off", "page").select("off", "page")) == [(0, 1), (3, 1), (4, 3), (99, 3)]


def test_trees_of_any_depth(spark):
    chain = spark.createDataFrame([(i, i - 1 if i else None, 0) for i in range(90)] + [(200, 201, 0), (201, 200, 0)], "id long, parent long, sib_ord int")
    got = {r["id"]: r["depth"] for r in tree.levels(chain).collect()}
    assert got == {i: i for i in range(90)}


def test_packing_keeps_only_where_parts_begin(spark):
    """The fold of a group of very many members ends soon."""
    sizes = [(i * 37) % 900 + 1 for i in range(60_000)]
    start = time.perf_counter()
    got = packed(spark, sizes, 1_500_000, 10)
    assert time.perf_counter() - start < 20 and len(got) == len(sizes) and got[-1] == max(got) == len(set(got)) == 19


def slow_anchors(docs, books, gap):
    return sorted((b, i, *x) for b, i, path, title, body in docs for x in align.occurrences(path.lower(), title.lower(), body.lower(), books[b].lower(), gap))


@pytest.mark.parametrize("patterns, piece", [(4_000_000, 1_000_000), (300, 700)])
def test_anchors_equal_a_search_for_each_document(spark, monkeypatch, patterns, piece):
    """In slices and blocks of any size, with repeated paths, titles beyond the gap, bodies only, and no path."""
    monkeypatch.setattr(align, "PATTERNS", patterns)
    monkeypatch.setattr(align, "SLICE", piece)
    rng = random.Random(5)
    word = lambda: rng.choice(["uno", "dos", "tres", "Libro", "Ñandú", "x"])
    books, docs = {}, []
    for b in "ab":
        text = []
        for i in range(25):
            path, title = f"Libro {rng.randrange(4)}, Letra {rng.choice('AB')}", f"Norma {rng.randrange(9)}"
            body = " ".join(word() for _ in range(rng.randrange(30)))
            docs.append((b, i, rng.choice([path, path, path, ""]), rng.choice([title, title, ""]), body))
            text += [path, " ".join(word() for _ in range(rng.randrange(12))), title, body]
        books[b] = " ".join(text)
    got = align.anchors(spark.createDataFrame(docs, "book string, id long, path string, title string, body string"), spark.createDataFrame(list(books.items()), "book string, text string"), 40)
    want = slow_anchors(docs, books, 40)
    assert len(want) > 30 and sorted(map(tuple, got.collect())) == want


def test_anchors_write_headings_not_what_stands_near(spark, monkeypatch):
    """Every path has all titles within the gap, in two books, and one document has copies: what is written follows the documents."""
    tables, write = {}, align.written
    monkeypatch.setattr(align, "written", lambda df, name: tables.setdefault(name, write(df, name)))
    monkeypatch.setattr(align, "PAIRS", 7, raising=False)
    text = " ".join([f"libro {i}," for i in range(40)] + [f"n {i}." for i in range(40)] + ["copia de norma"] * 30)
    docs = [("ab"[i % 2], i, f"Libro {i},", f"N {i}.", "") for i in range(40)] + [("a", 100 + i, "Copia", "Norma", "") for i in range(30)]
    docs.append(("b", 200, "Copia", "falta", "copia de norma " * 9))
    got = align.anchors(spark.createDataFrame(docs, "book string, id long, path string, title string, body string"), spark.createDataFrame([("a", text), ("b", text)], "book string, text string"), 900)
    want = slow_anchors(docs, {"a": text, "b": text}, 900)
    assert sorted(map(tuple, got.collect())) == want and [w[1:] for w in want if w[1] == 200] == [(200, text.index("copia"), text.index("copia"), "body")]
    assert len(want) == 40 + 30 * 30 + 1 and sum(t.count() for t in tables.values()) < 3 * len(docs)


def test_small_letters_keep_places():
    assert align.lowered("AİB") == "aİb" and align.lowered("ÑÁ") == "ñá"


@pytest.mark.parametrize("patterns", [4_000_000, 20])
def test_first_hits_equal_a_search_for_each_pair(spark, monkeypatch, patterns):
    monkeypatch.setattr(align, "PATTERNS", patterns)
    texts, items = {1: "the cat sat on the mat", 2: "concatenate", 3: "", 4: None}, {1: "cat", 2: "the", 3: "", 4: "cat sat", 5: None, 6: "cat"}
    got = align.first_hits(spark.createDataFrame(list(texts.items()), "d long, text string"), spark.createDataFrame(list(items.items()), "i long, text string"), "d", "text", "i", "text")
    want = [(d, i, t.find(p) + 1) for d, t in texts.items() if t is not None for i, p in items.items() if p is not None and p in t]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_thinning_of_very_many_events(spark):
    n = 30_000
    events = spark.range(n).select(F.lit("b").alias("book"), "id", (F.col("id") * 10).alias("head"), (F.col("id") * 10 + F.when(F.col("id") % 100 == 0, 95).otherwise(3)).alias("body_start"), F.lit("heading").alias("how"))
    got = align.boundaries(events)
    assert got.count() == n - n // 100 * 9 and got.where("next_head is null").count() == 1


def test_passages_by_characters(spark):
    shared = "one two three four five six seven eight nine ten"
    far = " ".join(f"w{i}" for i in range(80))
    docs = spark.createDataFrame([("b", 1, f"{shared} NEW WORDS here {far} {shared}"), ("b", 2, shared), ("b", 3, "")], "book string, id long, text string")
    known = coverage.reference(spark.createDataFrame([(shared + " " + far,)], "text string"))
    gone = coverage.missing(coverage.shingle_rows(docs, ["book", "id"]), known)
    got = coverage.passages(docs, gone, ["book", "id"], gap=60).orderBy("first").collect()
    text = docs.where("id = 1").first()["text"]
    first = [text.find("four")]
    assert [r["first"] for r in got][:1] == first and got[0]["passage"].startswith("four five six seven eight nine ten NEW WORDS") and all(r["passage"] in text for r in got) and {r["id"] for r in got} == {1}
    assert len(coverage.passages(docs, gone, ["book", "id"], gap=1, most=2).collect()) == 2


def test_passages_without_places_of_words(spark):
    """What the reference lacks is shown from each document's own row: no window, and no row for each word that is missing."""
    word = lambda i: ["İa", "b-c", "déf", "GH", "x1"][i % 5] + str(i)
    texts = ["", "  ", "one", "..Uno dos", " ".join(map(word, range(300))), "¡ " + " ".join(f"{word(i)}," for i in range(90)) + " " * 260 + " ".join(map(word, range(40))) + " ."]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (90, None)], "id long, text string")
    known = coverage.reference(spark.createDataFrame([(" ".join(map(word, range(20, 60))),), ("one",)], "text string"))
    got = coverage.lacking(docs, known, ["id"], gap=60, most=None)
    assert "Window" not in got._jdf.queryExecution().toString() and "left_anti" not in got._jdf.queryExecution().toString().lower().replace(" ", "_").replace("leftanti", "left_anti")
    gone = coverage.missing(coverage.shingle_rows(docs, ["id"]), known)
    assert rows(got) == rows(coverage.passages(docs, gone, ["id"], gap=60, most=None))
    found = {}
    for r in gone.collect():
        if r["id"] is not None:
            low = (texts[r["id"]] if len(texts[r["id"]].lower()) == len(texts[r["id"]]) else texts[r["id"]].lower()).lower()
            found.setdefault(r["id"], []).append([m.start() for m in re.finditer(r"[^\W]+", low)][r["pos"]])
    want = []
    for i, places in found.items():
        places.sort()
        opens = [k for k, p in enumerate(places) if k == 0 or p - places[k - 1] >= 60]
        want += [(i, n + 1, places[k]) for n, k in enumerate(opens)]
    assert rows(got.select("id", "run", "first")) == sorted(want, key=repr) and len(want) > 5


def exact_by_hand(before, after):
    """Unit events of one document as the rules say: in reading order, old units claimed by id, the last of a number answering to it."""
    had, out = set(), []
    for number, text in after:
        same = next((n for n, t in before if t == text and n not in had), None)
        last = next((t for n, t in reversed(before) if n == number), None)
        if same is not None:
            had.add(same)
            out += [("renumbered", number, same)] if same != number else []
        elif last is not None and number not in had:
            had.add(number)
            out += [("modified", number, None)] if last != text else []
        else:
            out.append(("added", number, None))
    for n in dict.fromkeys(n for n, _ in before):
        if n not in had and n not in {x[1] for x in out}:
            out.append(("removed", n, None))
    return sorted(out, key=repr)


def test_exact_events_equal_the_rules(spark):
    rng = random.Random(6)
    for _ in range(12):
        before, after = ([(str(rng.randrange(4)), rng.choice("abcdef")) for _ in range(rng.randrange(7))] for _ in range(2))
        if not before:
            continue
        got = rows(units.exact_events(unit_rows(spark, *before), unit_rows(spark, *after)).select("type", "number", "from_number")) if after else None
        assert got is None or got == exact_by_hand(before, after), (before, after)
