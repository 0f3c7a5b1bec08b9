"""Text and images of PDF files by poppler's programs, where these are installed, or from text that was extracted before."""

from __future__ import annotations

import re
import shutil
import subprocess
import tempfile
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def available() -> bool:
    return all(shutil.which(x) for x in ("pdftotext", "pdfinfo", "pdfimages"))


def pages_of_text(texts: DataFrame, key: str = "book", text: str = "text") -> DataFrame:
    """(key, page, text): extracted text cut at form feeds; pages keep their true number."""
    return texts.select(key, F.posexplode(F.split(text, "\f", -1)).alias("p", "t")).select(key, (F.col("p") + 1).cast("long").alias("page"), F.col("t").alias("text"))


def _on_file(content: bytes, *command: str) -> bytes:
    """A program's output for a PDF; the file is the task's own and gone afterwards."""
    with tempfile.NamedTemporaryFile(suffix=".pdf") as f:
        f.write(content)
        f.flush()
        done = subprocess.run([c.replace("{}", f.name) for c in command], capture_output=True, check=False)
    return done.stdout if done.returncode == 0 else b""


def page_count(content: bytes) -> int:
    """Pages of a PDF; 0 if it can't be read."""
    found = re.search(rb"^Pages:\s+(\d+)", _on_file(content, "pdfinfo", "{}"), re.M)
    return int(found[1]) if found else 0


def _texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"path": batch["path"], "pages": [page_count(c) for c in batch["content"]], "text": [_on_file(c, "pdftotext", "-enc", "UTF-8", "{}", "-").decode("utf-8", "replace") for c in batch["content"]]})


def _images(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            with tempfile.TemporaryDirectory() as folder:
                (Path(folder) / "x.pdf").write_bytes(content)
                subprocess.run(["pdfimages", "-png", "-p", f"{folder}/x.pdf", f"{folder}/i"], capture_output=True, check=False)
                for f in sorted(Path(folder).glob("i-*.png")):
                    _, page, n = f.stem.split("-")
                    yield pd.DataFrame({"path": [path], "page": [int(page)], "n": [int(n)], "content": [f.read_bytes()]})


def texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, pages, text) of PDF files."""
    if not available():
        raise RuntimeError("poppler is not installed: give extracted text to pages_of_text")
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(_texts, "path string, pages long, text string")


def images(spark: SparkSession, path: str) -> DataFrame:
    """(path, page, n, sha256, content) of the images in PDF files."""
    if not available():
        raise RuntimeError("poppler is not installed")
    rows = spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(_images, "path string, page long, n long, content binary")
    return rows.withColumn("sha256", F.sha2("content", 256))


def visual_key(content: bytes) -> bytes | None:
    """A picture as 16 x 16 grey values; None if it can't be read. Needs Pillow."""
    import io

    from PIL import Image

    try:
        with Image.open(io.BytesIO(content)) as picture:
            return picture.convert("L").resize((16, 16), Image.Resampling.LANCZOS).tobytes()
    except OSError:
        return None


def new_keys(images: DataFrame, memo: DataFrame) -> DataFrame:
    """(sha256, key) of contents whose key is not remembered yet; each content is looked at once."""

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"sha256": batch["sha256"], "key": [visual_key(c) for c in batch["content"]]})

    fresh = images.join(memo.select("sha256"), "sha256", "left_anti").dropDuplicates(["sha256"])
    return fresh.select("sha256", "content").mapInPandas(keys, "sha256 string, key binary")
