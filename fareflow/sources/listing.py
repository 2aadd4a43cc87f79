"""Listing by tasks, level by level, which leaves out folders that have not changed.

The driver gets numbers only: folders are dealt to tasks, which write down what they find, and
the folders among that are the next level's work. An index holds what the last walk found. A
folder whose time is still the same is not listed again; only its subfolders' times are looked
up. Stores that keep no times of folders (object stores) are listed whole each time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.session import scratch_path
from fareflow.sources.claims import claimed
from fareflow.sources.lake import read_report, write_report
from fareflow.sources.ledger import LISTING_TASKS, RAW_SUFFIXES

ENTRY = "folder string, path string, is_folder boolean, length bigint, modified_at timestamp"
# A folder changed this shortly before a walk is listed again by the next one: it may have
# changed once more within one tick of the store's clock, or that clock may be off.
SETTLES = timedelta(minutes=10)
# Folders that are worth a task.
FOLDERS_PER_TASK = 16
# Entries that a task hands over at once.
_PIECE = 10_000

_ARROW = pa.schema([
    ("folder", pa.string()), ("path", pa.string()), ("is_folder", pa.bool_()), ("length", pa.int64()),
    ("modified_at", pa.timestamp("us", "UTC")),
])


@dataclass
class Walk:
    """The files found, as ``list_files`` gives them, and how many folders there are and were listed."""

    files: DataFrame
    folders: int
    listed: int


def walk_folders(
    spark: SparkSession,
    root: str,
    index: str,
    suffix: str | Sequence[str] = RAW_SUFFIXES,
    settles: timedelta = SETTLES,
) -> Walk:
    """Every file below ``root`` ending in ``suffix``, or in one of several, by the index of the last walk and what changed since.

    Hidden names (``.x``, ``_x``) are left out, as Spark does. A file that is overwritten in
    place leaves its folder's time as it is, so its length and time may be old ones; a loaded file is
    known by its path. A folder that goes while the walk is under way counts as empty. A missing
    root is an error. One walk at a time holds the index; it is replaced once the walk is done.
    """
    with claimed(spark, index, "walk"):
        began = datetime.now(timezone.utc)
        try:
            known = read_report(spark, index)
        except FileNotFoundError:
            known = None
        entries, folders, listed = _walked(spark, _qualified(spark, root), known)
        settled = F.coalesce(F.col("modified_at") < F.lit(began - settles), F.lit(False))
        write_report(entries.withColumn("settled", settled), index, sort_by="path")
    endings = [suffix] if isinstance(suffix, str) else suffix
    named = reduce(lambda a, b: a | b, [F.col("path").endswith(end) for end in endings])
    files = entries.where(~F.col("is_folder") & named)
    return Walk(files.select("path", "length", "modified_at"), folders, listed)


def _walked(spark: SparkSession, root: str, known: DataFrame | None) -> tuple[DataFrame, int, int]:
    """All entries, the number of folders, and that of folders listed."""
    out, look, children = scratch_path(spark, "walk"), *_lookers(_storage(spark))
    level = spark.createDataFrame([(None, root)], "folder string, path string").mapInArrow(look, ENTRY)
    folders = listed = depth = 0
    while True:
        level.write.parquet(f"{out}/depth={depth}")
        found = spark.read.schema(ENTRY).parquet(f"{out}/depth={depth}").where("is_folder")
        count = found.count()
        if not count:
            break
        folders += count
        fresh, carried = found, None
        if known is not None:
            settled = known.where("is_folder AND settled").select("path", "modified_at")
            same = found.join(settled, ["path", "modified_at"], "left_semi").select(F.col("path").alias("folder"))
            fresh = found.join(settled, ["path", "modified_at"], "left_anti")
            carried = known.join(same, "folder", "left_semi").select(*_ARROW.names)
        changed = fresh.count()
        listed += changed
        level = _dealt(fresh.select("folder", "path"), changed).mapInArrow(children, ENTRY)
        if carried is not None:
            below = _dealt(carried.where("is_folder").select("folder", "path"), count)
            level = level.unionByName(carried.where("NOT is_folder")).unionByName(below.mapInArrow(look, ENTRY))
        depth += 1
    if not folders:
        raise FileNotFoundError(root)
    return spark.read.schema(ENTRY).parquet(*[f"{out}/depth={d}" for d in range(depth + 1)]), folders, listed


def _dealt(rows: DataFrame, count: int) -> DataFrame:
    """Rows over as many tasks as they are worth, whatever few bytes they have."""
    tasks = min(-(-count // FOLDERS_PER_TASK), LISTING_TASKS)
    return rows.repartition(max(1, tasks), "path")


def _lookers(storage: dict[str, str]) -> tuple[Callable, Callable]:
    """Two functions over Arrow batches: what paths are now, and what folders hold."""

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                system, inside = _opened(row["path"], storage)
                info = system.get_file_info(inside)
                if info.type != fs.FileType.NotFound:
                    rows.append(_entry(row["folder"], row["path"], info))
            yield pa.RecordBatch.from_pylist(rows, _ARROW)

    def children(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch["path"].to_pylist():
                system, inside = _opened(folder, storage)
                infos = system.get_file_info(fs.FileSelector(inside, allow_not_found=True))
                shown = [i for i in infos if not _hidden(i.base_name)]
                for at in range(0, len(shown), _PIECE):
                    rows = [_entry(folder, f"{folder}/{i.base_name}", i) for i in shown[at : at + _PIECE]]
                    yield pa.RecordBatch.from_pylist(rows, _ARROW)

    return look, children


def _entry(folder: str | None, path: str, info: fs.FileInfo) -> dict:
    """One row; times in milliseconds, as Hadoop gives them."""
    is_folder = info.type == fs.FileType.Directory
    at = None if info.mtime_ns is None else info.mtime_ns // 1_000_000 * 1_000
    return {
        "folder": folder, "path": path, "is_folder": is_folder, "length": None if is_folder else info.size,
        "modified_at": at,
    }


def _hidden(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _opened(path: str, storage: dict[str, str]) -> tuple[fs.FileSystem, str]:
    """The file system of a qualified path, and the path in its own terms."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), f"/{rest.lstrip('/')}"
    place, _, inside = rest.lstrip("/").partition("/")
    if scheme in ("s3", "s3a", "s3n"):
        return fs.S3FileSystem(**storage), f"{place}/{inside}"
    return fs.FileSystem.from_uri(f"{scheme}://{place}/")[0], f"/{inside}"


def _qualified(spark: SparkSession, root: str) -> str:
    """The root with scheme and authority, as Spark names the files below it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(path).toString()


def _storage(spark: SparkSession) -> dict[str, str]:
    """The S3 client's options, from the settings of ``session.object_store_conf``."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    names = {"endpoint": "endpoint_override", "access.key": "access_key", "secret.key": "secret_key"}
    found = {ours: conf.get(f"fs.s3a.{theirs}") for theirs, ours in names.items()}
    found["scheme"] = "http" if conf.get("fs.s3a.connection.ssl.enabled") == "false" else "https"
    return {name: value for name, value in found.items() if value}
