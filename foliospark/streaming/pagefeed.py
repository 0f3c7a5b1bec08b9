"""Pages that crawls found new, changed or gone, as a streaming source.

``spark.readStream.format("changed_pages").option("path", <cache>).load()`` reads
the cache of ``sources.crawl``. An offset is a version of its table; a batch is
what the versions after the last offset have added, each file a partition. The
offsets are in the query's checkpoint, so a restart goes on where it was. With
a ``reader`` name the source also leaves beside the table from which version on
it reads, and ``forget`` keeps what such readers still need.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from foliospark.sources import versions
from foliospark.sources.filewriter import store_of

SCHEMA = "run long, depth int, page_id string, kind string, etag string, last_modified string, html string, sha256 string, error string"
_COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
KINDS = ("new", "changed", "removed")


class LostVersions(Exception):
    """Versions that a reader has not read are gone."""


@dataclass
class _File(InputPartition):
    path: str


class _Reader(DataSourceStreamReader):
    def __init__(self, path: str, name: str, kinds: tuple[str, ...]):
        self.path, self.name, self.kinds = path.rstrip("/"), name, kinds

    def _commits(self) -> dict[int, str]:
        store, at = store_of(f"{self.path}/pages/commits")
        if store.get_file_info(at).type == fs.FileType.NotFound:
            return {}
        found = {f.base_name[:-5]: f.path for f in store.get_file_info(fs.FileSelector(at)) if f.base_name.endswith(".json")}
        return {int(n): p for n, p in found.items() if n.isdigit()}

    def _told(self, path: str) -> dict:
        store, _ = store_of(self.path)
        with store.open_input_stream(path) as f:
            return json.loads(f.read())

    def initialOffset(self) -> dict:
        return {"version": 0}

    def latestOffset(self) -> dict:
        return {"version": max(self._commits(), default=0)}

    def partitions(self, start: dict, end: dict) -> list[_File]:
        """Files that the versions after ``start`` up to ``end`` have added; versions that only move rows add none."""
        self._keep(start)  # a restart may plan this batch again
        commits, begin = self._commits(), start["version"]
        wanted = [n for n in sorted(commits) if begin < n <= end["version"]]
        if begin and wanted != list(range(begin + 1, end["version"] + 1)):
            raise LostVersions(f"versions after {begin} of {self.path} are gone")
        held = set(self._told(commits[begin])["parts"]) if begin in commits else set()
        added: list[str] = []
        for n in wanted:
            told = self._told(commits[n])
            if not told.get("rearranged") or (not begin and n == wanted[0]):
                added += [p for p in told["parts"] if p not in held]
            held |= set(told["parts"])
        store, at = store_of(f"{self.path}/pages/data")
        files = [f.path for p in added for f in store.get_file_info(fs.FileSelector(f"{at}/{p}")) if f.base_name.endswith(".parquet")]
        return [_File(f) for f in sorted(files)]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        store, _ = store_of(self.path)
        with store.open_input_file(partition.path) as f:
            for batch in pq.ParquetFile(f).iter_batches(1000, columns=_COLUMNS):
                batch = batch.select(_COLUMNS)
                yield batch.filter(pc.is_in(batch.column("kind"), pa.array(self.kinds)))

    def commit(self, end: dict) -> None:
        self._keep(end)

    def _keep(self, offset: dict) -> None:
        """Leave word that versions after ``offset`` are still to be read."""
        if not self.name:
            return
        store, at = store_of(f"{self.path}/readers")
        store.create_dir(at, recursive=True)
        draft = f"{at}/.{uuid.uuid4().hex}"
        with store.open_output_stream(draft) as f:
            f.write(json.dumps(offset).encode())
        store.move(draft, f"{at}/{self.name}.json")


class ChangedPages(DataSource):
    """Options: ``path``; ``reader``, a name to keep versions for; ``kinds``, separated by commas."""

    @classmethod
    def name(cls) -> str:
        return "changed_pages"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader(self.options["path"], self.options.get("reader", ""), tuple(self.options.get("kinds", ",".join(KINDS)).split(",")))


def changed(spark: SparkSession, path: str, reader: str = "") -> DataFrame:
    """The stream of pages that crawls against the cache at ``path`` found new, changed or gone."""
    spark.dataSource.register(ChangedPages)
    return spark.readStream.format("changed_pages").option("path", path).option("reader", reader).load()


def forget(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """As ``versions.vacuum`` of the cache, but for what named readers have not read."""
    store, at = store_of(f"{path.rstrip('/')}/readers")
    last = versions.version(spark, f"{path}/pages").number
    read = [last]
    if store.get_file_info(at).type != fs.FileType.NotFound:
        for f in store.get_file_info(fs.FileSelector(at)):
            if f.base_name.endswith(".json"):
                with store.open_input_stream(f.path) as told:
                    read.append(json.loads(told.read())["version"])
    return versions.vacuum(spark, f"{path}/pages", keep=max(keep, last - min(read) + 1))
