"""Properties of plans and of results under another layout of the same rows."""

import os

import pytest
from pyspark.sql import functions as F

from foliospark.operators import coverage, sections, units
from foliospark.plans import catalog
from tests.conftest import rows

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
PYTHON = {"canonical_text_len", "slug_names", "part_filenames", "part_navigation", "markdown_section", "html_to_markdown", "parsed_documents", "hierarchy_levels", "figures_resolved", "unified_diff", "unit_events_exact", "document_anchors", "compared_publications", "comparison_report", "boundary_thinning", "boundary_thinning_spread", "containment_first_hit", "publication_sections"}


@needs_tables
@pytest.mark.parametrize("name", sorted(n for n in catalog.QUERIES if not n.startswith("stream")))
def test_plans(spark, name):
    plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    if name not in PYTHON:
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow")), "only built-in functions are needed here"


@needs_tables
def test_scans_read_only_what_they_need(spark):
    plan = catalog.QUERIES["book_subset"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,source:string>" in plan and "PushedFilters: [In(source" in plan


def test_layout_does_not_matter(spark):
    docs = spark.createDataFrame([(i, f"g{i % 3}", f"1. one {i}\n\nmore\n\n2) two", (i * 37) % 9000) for i in range(60)], "doc_id long, g string, text string, size long")
    for change in (lambda d: d.repartition(7), lambda d: d.orderBy(F.desc("doc_id")).coalesce(1)):
        other = change(docs)
        assert rows(units.segment(docs)) == rows(units.segment(other))
        assert rows(sections.pack(docs, "g", "doc_id", "size").select("doc_id", "part", "parts")) == rows(sections.pack(other, "g", "doc_id", "size").select("doc_id", "part", "parts"))
        assert rows(coverage.judged(docs, docs.limit(5))) == rows(coverage.judged(other, docs.limit(5)))


def test_a_text_covers_itself(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j"), (2, ""), (3, "k")], "doc_id long, text string")
    got = coverage.judged(docs, docs)
    assert {(r["coverage"], r["lexical"], r["n_only"], r["verdict"]) for r in got.collect()} == {(1.0, 1.0, 0, "match")}


def test_parts_of_a_subset_keep_their_names(spark):
    docs = spark.createDataFrame([(i, f"g{i % 4}", 4000) for i in range(80)], "doc_id long, g string, size long")
    packed = sections.pack(docs, "g", "doc_id", "size")
    order = sections.ordinals(packed, "g", "doc_id")
    some = packed.where("doc_id % 2 = 0").join(order, "g")
    whole = {(r["doc_id"]): (r["index"], r["part"]) for r in packed.join(order, "g").collect()}
    assert all(whole[r["doc_id"]] == (r["index"], r["part"]) for r in some.collect())


@needs_tables
@pytest.mark.parametrize("name, scans", [("coverage_report", 6), ("metrics_report", 0)])
def test_reports_judge_documents_once(spark, name, scans):
    """All parts of a report are made from one table of verdicts, not each from the documents."""
    plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("/documents.parquet") <= scans
