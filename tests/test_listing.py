"""Walks by an index find what Spark's own listing finds, and list changed folders only."""

import os
import shutil
from datetime import timedelta

import pytest
from pyspark.sql import DataFrame

from fareflow.sources.listing import SETTLES, walk_folders
from fareflow.sources.ledger import list_files

AT_ONCE = timedelta(0)


def put(root, *names):
    for name in names:
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(name)


def found(walk):
    return sorted((r.path, r.length, r.modified_at) for r in walk.files.collect())


def whole(spark, root):
    return sorted((r.path, r.length, r.modified_at) for r in list_files(spark, str(root)).collect())


@pytest.fixture
def raw(tmp_path):
    root = tmp_path / "raw"
    put(root, "top.csv", "a/1.csv", "a/2.txt", "a/b/c/3.csv", "a/b/.4.csv", "_gone/5.csv", "_k=1/6.csv")
    put(root, "odd #%20? [x]/7 8.csv", "e/._COPYING_/9.csv", "e/_SUCCESS", "ü/10.csv")
    (root / "empty" / "deep").mkdir(parents=True)
    return root


def test_same_files_as_spark(spark, raw, tmp_path):
    walk = walk_folders(spark, str(raw), str(tmp_path / "index"), settles=AT_ONCE)
    assert found(walk) == whole(spark, raw)
    assert len(found(walk)) == 6 and walk.listed == walk.folders == 10
    assert walk.files.dtypes == list_files(spark, str(raw)).dtypes


def test_changed_folders_only(spark, raw, tmp_path):
    index = str(tmp_path / "index")
    walk_folders(spark, str(raw), index, settles=AT_ONCE)
    again = walk_folders(spark, str(raw), index, settles=AT_ONCE)
    assert again.listed == 0 and again.folders == 10 and found(again) == whole(spark, raw)
    put(raw, "a/b/c/new.csv", "empty/deep/er/11.csv")
    (raw / "a" / "1.csv").unlink()
    shutil.rmtree(raw / "ü")
    # Changed: the root, a, a/b/c, empty/deep; new: empty/deep/er.
    after = walk_folders(spark, str(raw), index, settles=AT_ONCE)
    assert after.listed == 5 and after.folders == 10 and found(after) == whole(spark, raw)
    last = walk_folders(spark, str(raw), index, settles=AT_ONCE)
    assert last.listed == 0 and found(last) == whole(spark, raw)


def test_recent_folders_are_listed_again(spark, raw, tmp_path):
    index = str(tmp_path / "index")
    walk_folders(spark, str(raw), index)
    assert walk_folders(spark, str(raw), index).listed == 10
    old = (raw / "a").stat().st_mtime - 2 * SETTLES.total_seconds()
    os.utime(raw / "a", (old, old))
    assert walk_folders(spark, str(raw), index).listed == 10
    assert walk_folders(spark, str(raw), index).listed == 9


def test_one_large_folder_and_many_small(spark, tmp_path):
    raw = tmp_path / "raw"
    put(raw, *[f"large/{k}.csv" for k in range(12_000)], *[f"small/{k}/x.csv" for k in range(300)])
    walk = walk_folders(spark, str(raw), str(tmp_path / "index"), settles=AT_ONCE)
    assert found(walk) == whole(spark, raw) and walk.listed == 303
    again = walk_folders(spark, str(raw), str(tmp_path / "index"), settles=AT_ONCE)
    assert found(again) == whole(spark, raw) and again.listed == 0


def test_driver_gets_numbers_only(spark, raw, tmp_path, monkeypatch):
    def refuse(*_):
        raise AssertionError("rows on the driver")

    for name in ("collect", "toPandas", "toLocalIterator", "toArrow", "take", "head"):
        monkeypatch.setattr(type(spark.range(1)), name, refuse)
    for _ in range(2):
        walk = walk_folders(spark, str(raw), str(tmp_path / "index"), settles=AT_ONCE)
    monkeypatch.undo()
    assert isinstance(walk.files, DataFrame) and len(found(walk)) == 6


def test_empty_and_missing_roots(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    index = str(tmp_path / "index")
    walk = walk_folders(spark, str(tmp_path / "raw"), index)
    assert walk.files.isEmpty() and walk.folders == 1
    with pytest.raises(FileNotFoundError):
        walk_folders(spark, str(tmp_path / "none"), index)
