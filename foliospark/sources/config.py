"""Books and limits from a TOML file; the layout of a book's folders."""

from __future__ import annotations

import tomllib
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BOOKS = "slug string, pvid string, name string, pdf_file string, min_documents int, min_units int, ord int"


def find(start: str, name: str = "config.toml") -> Path:
    """The configuration in ``start`` or the nearest folder above it."""
    for folder in (Path(start).resolve(), *Path(start).resolve().parents):
        if (folder / name).is_file():
            return folder / name
    raise FileNotFoundError(f"no {name} in {start} or above")


def load(path: str | Path) -> dict:
    return tomllib.loads(Path(path).read_text(encoding="utf-8"))


def books(spark: SparkSession, config: dict, chosen: list[str] | None = None) -> DataFrame:
    """Books in the order of the configuration, with their roman number and folder; an unknown choice raises."""
    known = [b["slug"] for b in config.get("books", [])]
    unknown = [c for c in chosen or [] if c not in known]
    if unknown:
        raise ValueError(f"unknown book: {', '.join(unknown)}; known: {', '.join(known)}")
    rows = [(b["slug"], str(b["pvid"]), b.get("name", ""), b.get("pdf_file", ""), int(b.get("min_documents", 0)), int(b.get("min_units", 0)), i) for i, b in enumerate(config.get("books", [])) if not chosen or b["slug"] in chosen]
    df = spark.createDataFrame(rows, BOOKS)
    return df.withColumn("roman", F.concat(F.lit("Libro "), roman(F.col("slug")))).withColumn("folder", F.concat(F.lit("libro-"), F.lower(roman(F.col("slug")))))


def roman(slug: Column) -> Column:
    return F.upper(F.split_part(slug, F.lit("-"), F.lit(2)))


def folders(base: str, source: str, slug: str) -> dict[str, str]:
    """Where a book of a source keeps its parts."""
    root = f"{base.rstrip('/')}/source={source}/book={slug}"
    return {k: f"{root}/{k}" for k in ("cache", "documents", "images", "markdown", "state", "report")}
