"""Tables of versions: what a writer that dies anywhere leaves, what readers see, what a replayed batch does."""

import pytest

from foliospark.sources import files, versions
from tests.conftest import rows

STEPS = ["_write_data", "_write_draft", "_publish"]


class Killed(BaseException):
    pass


def dying(monkeypatch, step, after):
    """The writer dies before or after a step."""
    real = getattr(versions, step)

    def run(*args):
        if after:
            real(*args)
        raise Killed

    monkeypatch.setattr(versions, step, run)


def test_versions_are_kept_apart(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not versions.exists(spark, path) and versions.version(spark, path) is None
    with pytest.raises(FileNotFoundError):
        versions.read(spark, path)
    versions.write(spark.range(2), path)
    versions.write(spark.range(5, 6), path, append=True)
    versions.write(spark.range(9, 10), path)
    assert [rows(versions.read(spark, path, n)) for n in (1, 2, 3, None)] == [[(0,), (1,)], [(0,), (1,), (5,)], [(9,)], [(9,)]]
    with pytest.raises(ValueError, match="do not fit"):
        versions.write(spark.range(1).selectExpr("'a' AS x"), path, append=True)
    assert versions.version(spark, path).number == 3


def test_an_opened_version_stays_what_it_was(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.write(spark.range(3), path)
    opened = versions.read(spark, path)
    versions.write(spark.range(7), path)
    assert opened.count() == 3 and versions.read(spark, path).count() == 7


@pytest.mark.parametrize("append", [False, True])
@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("after", [False, True])
def test_a_writer_that_dies_leaves_the_old_version_or_the_new(spark, tmp_path, monkeypatch, step, after, append):
    path = str(tmp_path / "t")
    versions.write(spark.range(1), path)
    with monkeypatch.context() as m, pytest.raises(Killed):
        dying(m, step, after)
        versions.write(spark.range(1, 3), path, append=append)
    new = [(0,), (1,), (2,)] if append else [(1,), (2,)]
    assert rows(versions.read(spark, path)) == (new if (step, after) == ("_publish", True) else [(0,)])
    versions.write(spark.range(8, 9), path)
    assert rows(versions.read(spark, path)) == [(8,)]
    versions.vacuum(spark, path)
    assert rows(versions.read(spark, path)) == [(8,)]
    assert len([p for p in (tmp_path / "t" / "data").iterdir()]) == 1
    assert [p.name for p in (tmp_path / "t" / "commits").iterdir() if not p.name.endswith(".crc")] == [f"{versions.version(spark, path).number:020d}.json"]


def test_of_two_writers_one_is_told(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versions.write(spark.range(1), path)
    real = versions._write_data

    def slow(df, where):
        monkeypatch.setattr(versions, "_write_data", real)
        versions.write(spark.range(4), path)  # another writer is first
        return real(df, where)

    monkeypatch.setattr(versions, "_write_data", slow)
    with pytest.raises(versions.Conflict):
        versions.write(spark.range(2), path)
    assert versions.read(spark, path).count() == 4


def test_a_batch_is_taken_once(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch in (0, 1, 1, 0, 2):
        versions.write(spark.range(batch, batch + 1), path, append=True, feed="a", batch=batch)
    versions.write(spark.range(1, 2), path, append=True, feed="b", batch=1)
    assert rows(versions.read(spark, path)) == [(0,), (1,), (1,), (2,)]
    assert versions.version(spark, path).feeds == {"a": 2, "b": 1}


def test_vacuum_keeps_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(4):
        versions.write(spark.range(i), path)
    assert len(versions.vacuum(spark, path, keep=2)) == 2
    assert [versions.read(spark, path, n).count() for n in (3, 4)] == [2, 3]
    with pytest.raises(FileNotFoundError):
        versions.read(spark, path, 1)


# ------------------------------------------------------------- folders in place
@pytest.mark.parametrize("dies_at", range(6))
def test_a_staged_folder_survives_a_death_at_any_step(spark, tmp_path, monkeypatch, dies_at):
    path, step = str(tmp_path / "t"), 0
    files.staged(spark.range(3), path)
    real = files._step

    def counted(*args):
        nonlocal step
        if step == dies_at:
            raise Killed
        step += 1
        return real(*args)

    with monkeypatch.context() as m:
        m.setattr(files, "_step", counted)
        try:
            files.staged(spark.range(5), path)
        except Killed:
            pass
    files.settle(spark, path)
    assert spark.read.parquet(path).count() in (3, 5)
    files.staged(spark.range(7), path)
    assert spark.read.parquet(path).count() == 7
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
