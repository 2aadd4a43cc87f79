"""Which files there are, which are loaded, and which are left.

The ledger is a Parquet table of small appends, the log, and a folded copy of the older ones.
A file counts as loaded once a row with status ``loaded`` names its path; a failed file stays
new and is tried again.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.schema import LEDGER_COLUMNS
from fareflow.session import scratch_path
from fareflow.sources.claims import claimed
from fareflow.sources.lake import loaded_batches

# The listing's tasks, however many and however large the files are.
LISTING_TASKS = 200
# Raw files, as they are or compressed; Spark's CSV source reads both.
RAW_SUFFIXES = (".csv", ".csv.gz")


def name_pattern(suffixes: str | Sequence[str]) -> str:
    """A glob for names that end in one of the suffixes, which may hold wildcards."""
    return f"*{suffixes}" if isinstance(suffixes, str) else f"*{{{','.join(suffixes)}}}"


def list_files(spark: SparkSession, root: str, suffix: str | Sequence[str] = RAW_SUFFIXES) -> DataFrame:
    """Every file below ``root`` ending in ``suffix``, or in one of several, written down once and read back.

    Contents are not read, but Spark deals files out by their length, so large ones would
    get a task each. A session of its own bounds the tasks without touching this one's settings.
    """
    lister = spark.newSession()
    lister.conf.set("spark.sql.files.maxPartitionNum", str(LISTING_TASKS))
    files = (
        lister.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", name_pattern(suffix))
        .load(root)
    )
    found = files.select("path", "length", F.col("modificationTime").alias("modified_at"))
    path = scratch_path(spark, "listing")
    found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def with_suffix(listing: DataFrame, suffix: str = ".csv") -> DataFrame:
    """The files of a listing that end in ``suffix``."""
    return listing.where(F.col("path").endswith(suffix))


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """The ledger; empty if there is none yet. Any other error is raised.

    That is the newest folded copy and the log files it does not cover.
    """
    reader = spark.read.schema(LEDGER_COLUMNS)
    newest = max(_folded(spark, root), default=None)
    if newest is not None:
        log = _log_files(spark, root, besides=_covered(spark, root, newest))
        return reader.parquet(f"{root}/{_FOLDED}/{newest}/rows", *[f"{root}/{name}" for name in log])
    try:
        return reader.parquet(root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_COLUMNS)


# Hidden from Spark's own listing of the log, in batch and stream.
_FOLDED = "_folded"
# Log files from which on ``fold_ledger`` does something.
FOLD_AT = 100


def fold_ledger(spark: SparkSession, root: str, least: int = FOLD_AT) -> bool:
    """Copy the log's rows into a few files once there are ``least`` log files.

    A copy counts once its list of covered files is there, which is written last. Covered log
    files go with the next fold, so a reader that has just listed them still finds them; older
    copies go then too. One claim lets one fold run at a time.
    """
    if len(_log_files(spark, root, besides=set())) < least:
        return False
    with claimed(spark, root, "fold"):
        versions = sorted(_folded(spark, root))
        covered = _covered(spark, root, versions[-1]) if versions else set()
        log = _log_files(spark, root, besides=covered)
        if len(log) < least:
            return False
        new = f"{int(versions[-1]) + 1 if versions else 1:012d}"
        folder = f"{root}/{_FOLDED}/{new}"
        rows = read_ledger(spark, root)
        few = rows.repartition(1 + len(log) // (100 * least), F.coalesce("batch_id", F.lit("")))
        few.write.mode("overwrite").parquet(f"{folder}/rows")
        system, jvm_path = _file_system(spark, root)
        still_there = set(_log_files(spark, root, besides=set()))
        for name in covered & still_there:
            system.delete(jvm_path(f"{root}/{name}"), False)
        out = system.create(jvm_path(f"{folder}/covers"), True)
        try:
            out.write(bytearray("\n".join(sorted((covered & still_there) | set(log))).encode()))
        finally:
            out.close()
        for old in versions[:-1]:
            system.delete(jvm_path(f"{root}/{_FOLDED}/{old}"), True)
    return True


def _file_system(spark: SparkSession, root: str):
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return jvm_path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm_path


def _folded(spark: SparkSession, root: str) -> list[str]:
    """The complete folded copies."""
    system, jvm_path = _file_system(spark, root)
    found = system.globStatus(jvm_path(f"{root}/{_FOLDED}/*/covers"))
    return [entry.getPath().getParent().getName() for entry in found or ()]


def _covered(spark: SparkSession, root: str, version: str) -> set[str]:
    """The log files that a folded copy holds."""
    system, jvm_path = _file_system(spark, root)
    source = system.open(jvm_path(f"{root}/{_FOLDED}/{version}/covers"))
    try:
        return set(bytes(source.readAllBytes()).decode().splitlines())
    finally:
        source.close()


def _log_files(spark: SparkSession, root: str, besides: set[str]) -> list[str]:
    system, jvm_path = _file_system(spark, root)
    if not system.exists(jvm_path(root)):
        return []
    names = [e.getPath().getName() for e in system.listStatus(jvm_path(root)) if e.isFile()]
    return sorted(n for n in names if not n.startswith(("_", ".")) and n not in besides)


def ledger_files(spark: SparkSession, root: str) -> set[str]:
    """What the ledger is made of now, by name: log files and folded copies. Whatever is recorded adds a name."""
    return {*_log_files(spark, root, besides=set()), *(f"{_FOLDED}/{version}" for version in _folded(spark, root))}


def record(
    ledger_root: str,
    files: DataFrame,
    batch_id: str,
    status: str,
    at: datetime,
    error: str | None = None,
) -> None:
    """Add ledger rows for the files of one batch in a single file, which commits as a whole."""
    known = {"batch_id": batch_id, "status": status, "error": error}
    rows = files.withColumns(
        {name: F.lit(value).cast("string") for name, value in known.items()} | {"recorded_at": F.lit(at)}
    )
    have = {name: kind for name, kind in (c.split() for c in LEDGER_COLUMNS.strip().split(",\n"))}
    missing = {n: F.lit(None).cast(k) for n, k in have.items() if n not in rows.columns}
    rows.withColumns(missing).select(*have).coalesce(1).write.mode("append").parquet(ledger_root)


def append(spark: SparkSession, ledger_root: str, rows: DataFrame) -> None:
    """Add rows that have some of the ledger's columns, in a single file."""
    empty = spark.createDataFrame([], LEDGER_COLUMNS)
    whole = empty.unionByName(rows, allowMissingColumns=True)
    whole.coalesce(1).write.mode("append").parquet(ledger_root)


def one_row(spark: SparkSession) -> DataFrame:
    """A frame of one row and no ledger column, for entries that are about no file."""
    return spark.range(0, 1, 1, numPartitions=1).drop("id")


def new_files(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Listed files the ledger does not hold as loaded, told apart by full path."""
    loaded = ledger.where(F.col("status") == "loaded").select("path")
    return listing.join(loaded, "path", "left_anti")


def absent_files(source: DataFrame, target: DataFrame, key: str = "path") -> DataFrame:
    """Files of one listing that another lacks, by path or by any other key column."""
    return source.join(target.select(key), key, "left_anti")


def base_name(path: str = "path") -> Column:
    """The last segment of a path, for comparing listings of two different roots."""
    return F.substring_index(F.col(path), "/", -1)


def batch_sizes(ledger: DataFrame) -> DataFrame:
    """``batch_id``, ``bytes`` and ``published`` of every batch that readers see.

    Bytes are those of the files a batch was loaded from, as recorded; unknown ones count zero.
    """
    bytes_ = F.sum(F.coalesce(F.when(F.col("status") == "loaded", F.col("length")), F.lit(0)))
    known = ledger.groupBy("batch_id").agg(
        bytes_.alias("bytes"), F.bool_or(F.col("status") == "published").alias("published")
    )
    return known.join(loaded_batches(ledger), "batch_id", "left_semi")


def unpublished_batches(ledger: DataFrame) -> DataFrame:
    """Loaded batches that the downstream jobs have not covered yet."""
    published = ledger.where(F.col("status") == "published").select("batch_id")
    return loaded_batches(ledger).join(published, "batch_id", "left_anti")


def has_new_data(listing: DataFrame, ledger: DataFrame) -> bool:
    """Whether the load or the downstream jobs have anything to do."""
    return not new_files(listing, ledger).isEmpty() or not unpublished_batches(ledger).isEmpty()
