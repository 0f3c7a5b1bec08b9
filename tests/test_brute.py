"""Registered queries that SQL can't say, against slow versions in plain Python over the same tables."""

import difflib
import hashlib
import os
import re
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from foliospark.functions import html
from foliospark.operators import align
from foliospark.plans import catalog, changed, pages
from tests.conftest import rows
from tests.test_operators import exact_by_hand

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
BRUTE = {}


def brute(f):
    BRUTE[f.__name__] = f
    return f


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


CAPITAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZÁÉÍÓÚ"


def sentences(text):
    """Pieces that end in a mark after which a blank and a capital, or nothing, follow; marks after capitals end nothing."""
    out, begin = [], 0
    for i, c in enumerate(text):
        rest = text[i + 1 :]
        if c in ".;:" and i > begin and text[i - 1] not in CAPITAL and (not rest.strip() or (rest[0].isspace() and rest.lstrip()[:1] in CAPITAL + "¿(")):
            out.append(text[begin : i + 1])
            begin = i + 1
    return out


def excerpt_of(text, limit=60):
    lines = [x.strip() for x in re.sub(r"\[\[FIG[^\]]*\]\]", "", text).splitlines()]
    prose = [x for x in lines if x and x[0] not in "|#><" and not x.startswith(("![", "---")) and not re.fullmatch(r"\*\*[^*]+\*\*", x) and (len(x.split()) >= 6 or x[-1] in ".;:")]
    whole = " ".join(prose)
    for pattern, new in ((r"\[([^\]]*)\]\([^)]*\)", r"\1"), (r"\*\*|__|`", ""), (r"^(\d+[.)]|[a-z]\))\s+", "")):
        whole = re.sub(pattern, new, whole)
    words = next((s.split() for s in sentences(whole) if len(s.split()) >= 12), whole.split())
    return " ".join(words[:limit]) + ("…" if len(words) > limit else "")


@brute
def excerpt(spark):
    return [(r["doc_id"], excerpt_of(r["text"] or "") if r["text"] is not None else None) for r in table(spark, "documents").collect()]


@brute
def unified_diff(spark):
    prev, curr = ({r["doc_id"]: r["text"] for r in df.collect()} for df in changed.snapshots(spark, SF))
    out = []
    for i in prev.keys() & curr.keys():
        lines = [x.rstrip("\n") for x in difflib.unified_diff(prev[i].splitlines(), (curr[i] + (" (rev)" if i % 7 == 0 else "")).splitlines(), lineterm="", n=1)][2:]
        out.append((i, "\n".join(lines[:24] + ([f"… ({len(lines) - 24} líneas más)"] if len(lines) > 24 else []))))
    return out


@brute
def unit_events_exact(spark):
    before, after = (df.orderBy("ordinal").collect() for df in changed.unit_snapshots(spark, SF))
    out = []
    for doc in {r["doc_id"] for r in before + after}:
        sides = [[(r["number"], r["text"]) for r in side if r["doc_id"] == doc] for side in (before, after)]
        old, new = map(dict, sides)  # numbers are distinct here
        for kind, number, origin in exact_by_hand(*sides):
            diff = text = None
            if kind == "modified":
                lines = [x.rstrip("\n") for x in difflib.unified_diff(old[number].splitlines(), new[number].splitlines(), lineterm="", n=1)][2:]
                diff = "\n".join(lines[:24] + ([f"… ({len(lines) - 24} líneas más)"] if len(lines) > 24 else []))
            elif kind != "renumbered":
                text = (new if kind == "added" else old)[number][:400]
            out.append((doc, kind, number, origin, f"{doc}#{number}", diff, text))
    return out


@brute
def document_anchors(spark):
    c = table(spark, "conversations").orderBy("conv_id", "turn").collect()
    books = {}
    for r in c:
        books.setdefault(str(r["conv_id"] % 8), []).append(r["text"] or "")
    low = {b: align.lowered(" ".join(t)) for b, t in books.items()}
    out = []
    for r in c:
        text = align.lowered(r["text"] or "")
        out += [(str(r["conv_id"] % 8), r["conv_id"] * 1000 + r["turn"], *x) for x in align.occurrences(text[:12], text[13:23], text, low[str(r["conv_id"] % 8)])]
    return out


@brute
def html_to_markdown(spark):
    """Only the blocks set after each page, its notes and figures; :func:`test_markdown_equals_another_parser` holds whole texts."""
    return [(r["page_id"], True) for r in pages.site(spark, SF).collect()]


@brute
def figures_resolved(spark):
    out = []
    for r in catalog.QUERIES["html_to_markdown"](spark, SF).collect():
        text = r["markdown"].replace(f"[[FIG:{'ab' * 32}]]", f"![Figura](https://example.org/x.png)\n\n<!-- figura {'ab' * 32} -->")
        text = re.sub(r"\[\[FIG-MISSING:([^\]]*)\]\]", r"![Figura](https://example.org/\1)", text)
        out.append((r["pvid"], hashlib.sha256(text.encode()).hexdigest()))
    return out


END = "\n\n".join(["| a | b\\|c |\n| --- | --- |\n| 1 |  |", f"[[FIG:{"ab" * 32}]]\n\n\n\n[[FIG-MISSING:y.png]]", "> **Nota de actualización:** modificado"])


def normal(name, df):
    if name == "html_to_markdown":
        return sorted(((int(r["pvid"]), r["markdown"].endswith(END) and r["notes"] == "modificado" and r["figures"] == "ab" * 32) for r in df.collect()), key=repr)
    return rows(df)


def test_all_queries_without_sql_have_a_slow_version():
    assert set(BRUTE) >= set(catalog.QUERIES) - set(catalog.ORACLE)


@pytest.mark.parametrize("name", sorted(BRUTE))
def test_same_as_brute_force(spark, name):
    assert normal(name, catalog.QUERIES[name](spark, SF)) == sorted(BRUTE[name](spark), key=repr)


def from_tree(node):
    """Markdown of well-formed blocks by another parser: headings, paragraphs, lists and tables of plain text."""
    out = []
    for x in node:
        text = html.tidy("".join(x.itertext()))
        if x.tag == "ul":
            out += ["- " + html.tidy("".join(li.itertext())) for li in x]
        elif x.tag == "table":
            grid = [[html.tidy("".join(c.itertext())) for c in tr] for tr in x]
            width = max(map(len, grid))
            line = lambda cells, width=width: "| " + " | ".join(cells + [""] * (width - len(cells))) + " |"
            head = grid.pop(0) if any(c.tag == "th" for c in x[0]) else []
            out.append("\n".join([line(head), line(["---"] * width), *map(line, grid)]))
        else:
            out.append("#" * int(x.tag[1]) + " " + text if x.tag[0] == "h" else text)
    return "\n\n".join(out)


def test_markdown_equals_another_parser(spark):
    """Over the prose of the documents, in generated markup."""
    texts = [r["text"] for r in table(spark, "documents").where("length(text) between 40 and 2000 and not text rlike '[<>&|]'").select("text").limit(150).collect()]
    assert len(texts) > 100
    for i, t in enumerate(texts):
        w = t.split()
        w = [re.sub(r"[_^]\{", "", x) for x in w]
        cut = max(1, len(w) // 4)
        a, b, c, d = (" ".join(w[k * cut : (k + 1) * cut]) or "x" for k in range(4))
        cell = "th" if i % 2 else "td"
        body = f"<h{i % 5 + 1}>{a}</h{i % 5 + 1}><p>{b} <b>{c}</b></p><ul><li>{d}</li><li><i>{a}</i></li></ul><table><tr><{cell}>{w[0]}</{cell}><td>{b}</td></tr><tr><td>{w[-1]}</td></tr></table><div>{c}</div>"
        assert html.to_markdown(body)[0] == from_tree(ET.fromstring(f"<x>{body}</x>")), body
