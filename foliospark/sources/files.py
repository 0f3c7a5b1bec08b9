"""File scans and sinks: HTML pages, binaries by content, JSON lines, Markdown, staged writes."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliospark.sources import filewriter, versions


def _fs(spark: SparkSession, path: str):
    """Hadoop's file system for a path, and the path; works on any store that Spark reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def is_file(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where) and fs.getFileStatus(where).isFile()


# ------------------------------------------------------------------------ scans
def html_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, html) of a folder of ``<page_id>.html`` files; bytes that are no UTF-8 are replaced."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.html").load(path)
    return files.select(F.regexp_extract("path", r"([^/]+)\.html$", 1).alias("page_id"), F.make_valid_utf8(F.col("content").cast("string")).alias("html"))


def binaries(spark: SparkSession, path: str) -> DataFrame:
    """(src, sha256, file, size): files addressed by their content, ``file`` being digest and suffix."""
    files = spark.read.format("binaryFile").load(path)
    digest, suffix = F.sha2("content", 256), F.lower(F.regexp_extract("path", r"(\.[A-Za-z0-9]+)$", 1))
    return files.select(F.col("path").alias("src"), digest.alias("sha256"), F.concat(digest, F.when(suffix == "", ".bin").otherwise(suffix)).alias("file"), F.col("length").alias("size"))


def write_json_document(df: DataFrame, path: str, order: list[str], most: int = 100_000) -> None:
    """All rows in order as one indented JSON text, for people and configuration: ``most`` rows at most, else an error.

    The new text replaces the old one when it is whole.
    """
    rows = df.orderBy(*order).limit(most + 1).toJSON().collect()  # of proven size
    if len(rows) > most:
        raise ValueError(f"more than {most} rows for one document; write_json_lines takes any number")
    spark = df.sparkSession
    fs, where = _fs(spark, path)
    _, staging = _fs(spark, f"{path}.staging-{uuid.uuid4().hex}")
    out = fs.create(staging, True)
    try:
        out.write(bytearray(json.dumps([json.loads(x) for x in rows], ensure_ascii=False, indent=2).encode() + b"\n"))
    finally:
        out.close()
    fs.delete(where, False)
    if not fs.rename(staging, where):
        raise OSError(f"could not move {staging} to {path}")


#: Where a body names its images.
IMAGE = r"""<img\b[^>]*?\bsrc\s*=\s*["']([^"']+)"""


def by_content(found: DataFrame, order: str = "src") -> DataFrame:
    """(sha256, first, n): one row for each content of ``found`` (sha256 and ``order``), with the first place that has it."""
    return found.groupBy("sha256").agg(F.min(order).alias("first"), F.count("*").alias("n"))


def new_sources(pages: DataFrame, index: DataFrame, body: Column, pattern: str = IMAGE) -> DataFrame:
    """Distinct sources that page bodies name and the index (src) has not."""
    found = pages.select(F.explode(F.regexp_extract_all(body, F.lit(pattern), F.lit(1))).alias("src")).distinct()
    return found.join(index.select("src"), "src", "left_anti")


def folder_size(spark: SparkSession, path: str) -> tuple[int, int]:
    """(bytes, files) below a folder, from the file system's own summary; (0, 0) if there is none."""
    fs, where = _fs(spark, path)
    if not fs.exists(where):
        return 0, 0
    found = fs.getContentSummary(where)
    return found.getLength(), found.getFileCount()


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str, last: int | None = None, order: str | None = None) -> DataFrame:
    """Tolerant scan of JSON lines: blank and malformed lines are left out.

    ``last`` keeps that many rows of the greatest ``order``. A missing file is an empty table.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    rows = rows.where(" or ".join(f"`{c}` is not null" for c in rows.columns))
    return rows if last is None else rows.orderBy(F.desc(order)).limit(last)


def json_document(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """An array of objects in one JSON text; a missing file is an empty table."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).json(path)


STATE = "book string, id string, etag string, last_modified string"


def http_state(spark: SparkSession, path: str) -> DataFrame:
    """What conditional requests are made with: (book, id, etag, last_modified); empty before the first crawl."""
    return versions.read(spark, path) if versions.exists(spark, path) else spark.createDataFrame([], STATE)


def keep_http_state(answers: DataFrame, path: str) -> None:
    """Advance the state by ``answers`` (book, id, status, etag, last_modified), a row for each page asked for.

    A page that was sent anew replaces its row; one that has not changed or
    could not be had keeps the row it has.
    """
    spark = answers.sparkSession
    sent = answers.where("status = 200").dropDuplicates(["book", "id"]).select("book", F.col("id").cast("string").alias("id"), "etag", "last_modified")
    old = http_state(spark, path).join(sent.select("book", "id"), ["book", "id"], "left_anti")
    versions.write(old.unionByName(sent), path)


# ------------------------------------------------------------------------ sinks
def _step(act, *args) -> None:
    """One step at the file system, which is done or not."""
    if act(*args) is False:
        raise OSError(f"the file system refused {act} of {', '.join(map(str, args))}")


def _swap(spark: SparkSession, ready: str, path: str) -> None:
    """Put the whole folder ``ready`` in the place of ``path``; :func:`settle` ends what a death leaves."""
    fs, where = _fs(spark, path.rstrip("/"))
    old, _at = f"{path.rstrip('/')}.old", lambda p: _fs(spark, p)[1]
    next_ = f"{path.rstrip('/')}.next"
    _step(fs.rename, _at(ready), _at(next_))  # from here on the new folder is the one that counts
    if fs.exists(where):
        _step(fs.rename, where, _at(old))
    _step(fs.rename, _at(next_), where)
    _step(fs.delete, _at(old), True) if fs.exists(_at(old)) else None


def settle(spark: SparkSession, path: str) -> None:
    """End a replacement of the folder ``path`` that died half way; the new folder takes its place where it was whole.

    Only for the one who writes there: a running replacement must not be ended by another.
    """
    fs, where = _fs(spark, path.rstrip("/"))
    next_, old = (_fs(spark, f"{path.rstrip('/')}.{x}")[1] for x in ("next", "old"))
    if fs.exists(next_):
        if fs.exists(where):
            fs.delete(old, True)
            fs.rename(where, old)
        fs.rename(next_, where)
    if fs.exists(old) and fs.exists(where):
        fs.delete(old, True)
    parent, name = where.getParent(), where.getName()
    for left in fs.listStatus(parent) if fs.exists(parent) else []:
        if left.getPath().getName().startswith((f"{name}.staging-", f"{name}.ready-")):
            fs.delete(left.getPath(), True)


def staged(df: DataFrame, path: str, fmt: str = "parquet", **options) -> None:
    """Overwrite the folder ``path`` only when the whole new content is written: a failed job leaves the old one.

    A driver that dies between the renames leaves the new folder whole beside
    its place, where :func:`settle`, which every such write begins with, puts
    it. State that must be there at any moment is a table of ``versions``.
    """
    spark = df.sparkSession
    settle(spark, path)
    fs, _ = _fs(spark, path)
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    try:
        df.write.format(fmt).options(**options).save(staging)
        _swap(spark, staging, path)
    except Exception:
        fs.delete(_fs(spark, staging)[1], True)
        raise


def write_json_lines(df: DataFrame, path: str, order: list[str], append: bool = False) -> None:
    """One object a line in a global order; any number of files, whose names follow the order."""
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    if append:
        rows.write.mode("append").json(path)
    else:
        staged(rows, path, "json")


def write_markdown(texts: DataFrame, path: str, name: str = "filename", text: str = "text") -> DataFrame:
    """One file of that name for each row, of distinct names; names may hold folders.

    Tasks write each text to its file in a folder beside ``path``, which takes
    its place in one step when all have ended; stale files go with the old
    folder. A file ends in one line break. The result (filename, size) is what
    was written.
    """
    spark = texts.sparkSession
    settle(spark, path)
    spark.dataSource.register(filewriter.NamedFiles)
    body = F.regexp_replace(F.col(text), r"\n\z", "")
    whole = _fs(spark, path.rstrip("/"))[0].makeQualified(_fs(spark, path.rstrip("/"))[1]).toString()
    texts.select(F.col(name).alias("filename"), F.concat(body, F.lit("\n")).alias("text")).write.format("named_files").mode("overwrite").option("path", whole).save()
    settle(spark, path)
    return texts.select(F.col(name).alias("filename"), (F.octet_length(body) + 1).cast("long").alias("size"))


def front_matter(fields: list[tuple[str, Column]]) -> Column:
    """A block of ``key: value`` lines between dashes; text values that need it are given as JSON by the caller."""
    lines = [F.concat(F.lit(f"{k}: "), v.cast("string")) for k, v in fields]
    return F.concat(F.lit("---\n"), F.concat_ws("\n", *lines), F.lit("\n---\n"))


def tail(rows: DataFrame, order: list, k: int) -> DataFrame:
    """The last ``k`` rows in ascending order."""
    top = rows.orderBy(*[F.desc(c) for c in order]).limit(k)
    return top.withColumn("_r", F.row_number().over(Window.orderBy(*order))).orderBy("_r").drop("_r")


# ---------------------------------------------------------------------- purging
def purge(spark: SparkSession, targets: dict[str, list[str]], names: list[str], really: bool = False) -> list[tuple[str, int, int]]:
    """(name, bytes, files) of the named sets of paths, measured before they are deleted; a dry run by default."""
    unknown = [n for n in names if n not in targets]
    if unknown:
        raise ValueError(f"unknown purge targets: {', '.join(unknown)}")
    out = []
    for name in names:
        sizes = [folder_size(spark, p) for p in targets[name]]
        out.append((name, sum(s[0] for s in sizes), sum(s[1] for s in sizes)))
        if really:
            for p in targets[name]:
                fs, where = _fs(spark, p)
                fs.delete(where, True)
    return out
