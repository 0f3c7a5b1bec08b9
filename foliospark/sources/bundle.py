"""The deliverable: Markdown files of all books with their indexes, replaced as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.sources import files


def bundle(sections: DataFrame, indexes: DataFrame, root: DataFrame | None, path: str, expected: int) -> DataFrame:
    """Write sections (book, filename, text), an ``index.md`` for each book (book, section, ord, line) and, if all ``expected`` books are there, a root index.

    Returns what was written: (filename, size).
    """
    text = lambda df, by: df.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("section", "ord", "line"))), lambda x: x["line"]), "\n").alias("text"))
    out = sections.select(F.concat("book", F.lit("/"), "filename").alias("filename"), "text").unionByName(text(indexes, ["book"]).select(F.concat("book", F.lit("/index.md")).alias("filename"), "text"))
    if root is not None and sections.select("book").distinct().count() == expected:
        out = out.unionByName(text(root, []).select(F.lit("index.md").alias("filename"), "text"))
    return files.write_markdown(out, path)
