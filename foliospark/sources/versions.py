"""Tables of versions: data that is written once, and a commit that makes it the table.

A table's folder holds ``data/<id>`` (Parquet, never changed) and
``commits/<number>.json``, which names the data of that version, its schema and
how far each feed has come. A commit is written aside and renamed to its number
in one step that fails where the number is taken, so a writer that dies at any
moment leaves the version before or the version after, and of two writers one
is told. Readers are pinned to the version that they opened: data goes only by
:func:`vacuum`.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class Conflict(Exception):
    """Another writer has committed the version meanwhile."""


@dataclass(frozen=True)
class Version:
    """A committed version.

    ``feeds``: of each named feed the last of its batches that the table holds;
    ``rearranged``: it has no rows that the version before had not.
    """

    number: int
    parts: tuple[str, ...]
    schema: str
    feeds: dict[str, int] = field(default_factory=dict)
    rearranged: bool = False


def _store(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _numbers(spark: SparkSession, path: str) -> list[int]:
    fs, where = _store(spark, f"{path}/commits")
    if not fs.exists(where):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(where)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """A version of the table, the latest where no number is given; None where there is none."""
    found = _numbers(spark, path)
    if not found or (number is not None and number not in found):
        return None
    fs, where = _store(spark, f"{path}/commits/{number or found[-1]:020d}.json")
    stream = fs.open(where)
    try:
        told = json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()
    return Version(told["number"], tuple(told["parts"]), told["schema"], told["feeds"], told["rearranged"])


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_numbers(spark, path))


def read(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The rows of a version, the latest where no number is given."""
    found = version(spark, path, number)
    if found is None:
        raise FileNotFoundError(f"no version {'' if number is None else number} of {path}")
    return _parts(spark, path, found, list(found.parts))


def parts(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """The rows of some parts of the table's last version, by the names in :class:`Version`."""
    return _parts(spark, path, version(spark, path), names)


def _parts(spark: SparkSession, path: str, of: Version, names: list[str]) -> DataFrame:
    schema = StructType.fromJson(json.loads(of.schema))
    return spark.read.schema(schema).parquet(*(f"{path}/data/{p}" for p in names)) if names else spark.createDataFrame([], schema)


def _write_data(df: DataFrame, path: str) -> str:
    name = uuid.uuid4().hex
    df.write.parquet(f"{path}/data/{name}")
    return name


def _write_draft(spark: SparkSession, path: str, told: Version) -> str:
    """The commit's text under a name that no reader looks at."""
    draft = f"{path}/commits/.{uuid.uuid4().hex}"
    fs, where = _store(spark, draft)
    out = fs.create(where, False)
    try:
        out.write(bytearray(json.dumps(told.__dict__ | {"parts": list(told.parts)}).encode()))
    finally:
        out.close()
    return draft


def _publish(spark: SparkSession, path: str, draft: str, number: int) -> None:
    """Renames the draft to its number; never over another commit."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(f"{path}/commits/{number:020d}.json")
    source = jvm.org.apache.hadoop.fs.Path(draft)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    try:
        context.rename(source, target, spark.sparkContext._gateway.new_array(kind, 0))
    except Exception as e:  # py4j wraps what Hadoop throws
        if "FileAlreadyExists" in str(e):
            raise Conflict(f"version {number} of {path} is there already") from e
        raise


def write(df: DataFrame, path: str, append: bool = False, feed: str | None = None, batch: int = 0, rearranged: bool = False) -> Version:
    """Commit the next version: ``df`` alone, or after the rows of the version before.

    With a ``feed`` the commit also says that its ``batch`` is in the table,
    and a batch that is there already (one that is replayed) changes nothing.
    Raises :class:`Conflict` where another writer was first.
    """
    spark = df.sparkSession
    last = version(spark, path)
    feeds = dict(last.feeds) if last else {}
    if feed is not None:
        if feeds.get(feed, -1) >= batch:
            return last
        feeds[feed] = batch
    held = last.parts if append and last else ()
    if held and StructType.fromJson(json.loads(last.schema)).simpleString() != df.schema.simpleString():
        raise ValueError(f"rows of {df.schema.simpleString()} do not fit the table at {path}")
    told = Version(last.number + 1 if last else 1, (*held, _write_data(df, path)), df.schema.json(), feeds, rearranged)
    _publish(spark, path, _write_draft(spark, path, told), told.number)
    return told


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete what the last ``keep`` versions do not need, drafts and data of writers that died too; the data folders that went.

    Only for a table that nobody writes to or reads from an older version.
    """
    numbers = _numbers(spark, path)
    needed = {p for n in numbers[-keep:] for p in version(spark, path, n).parts}
    gone = []
    for folder, stays in (("commits", {f"{n:020d}.json" for n in numbers[-keep:]}), ("data", needed)):
        fs, where = _store(spark, f"{path}/{folder}")
        for f in fs.listStatus(where) if fs.exists(where) else []:
            name = f.getPath().getName()
            if name not in stays and not (folder == "commits" and name.endswith(".crc") and name[1:-4] in stays):
                fs.delete(f.getPath(), True)
                if folder == "data":
                    gone.append(name)
    return sorted(gone)
