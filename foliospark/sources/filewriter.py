"""A sink of named files: tasks write them where they belong, and a commit makes the folder whole.

``df.write.format("named_files").mode("overwrite").option("path", <folder>).save()``
with rows (filename, text). A task writes each file aside and moves it to its
name in a staging folder, so an attempt that is repeated writes the same files
again. The commit checks that no name was written by two tasks and moves the
staging folder to ``<folder>.next``, which ``files.settle`` puts in its place;
an abort deletes it. No file is moved by the driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage


def store_of(path: str) -> tuple[fs.FileSystem, str]:
    """A store and a path in it, for workers that have no session."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    """What a task has written: how many files, and their bytes."""

    files: int
    size: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str):
        self.path = path.rstrip("/")
        self.staging = f"{self.path}.staging-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, at = store_of(self.staging)
        made, n, size = set(), 0, 0
        for batch in iterator:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                parts = name.split("/")
                if not name or any(p in ("", ".", "..") for p in parts):
                    raise ValueError(f"no name of a file: {name!r}")
                folder = "/".join((at, *parts[:-1]))
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    made.add(folder)
                draft, data = f"{folder}/.{uuid.uuid4().hex}", (text or "").encode()
                with store.open_output_stream(draft) as out:
                    out.write(data)
                store.move(draft, f"{folder}/{parts[-1]}")
                n, size = n + 1, size + len(data)
        return Written(n, size)

    def commit(self, messages: list[Written | None]) -> None:
        store, at = store_of(self.staging)
        store.create_dir(at, recursive=True)
        found = sum(1 for f in store.get_file_info(fs.FileSelector(at, recursive=True)) if f.type == fs.FileType.File and not f.base_name.startswith("."))
        if found != (told := sum(m.files for m in messages if m)):
            store.delete_dir(at)
            raise ValueError(f"{told} files were written under {found} names")
        store.move(at, store_of(f"{self.path}.next")[1])

    def abort(self, messages: list[Written | None]) -> None:
        store, at = store_of(self.staging)
        if store.get_file_info(at).type != fs.FileType.NotFound:
            store.delete_dir(at)


class NamedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "filename string, text string"

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"])
