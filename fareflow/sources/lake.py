"""The Parquet trip lake and the report file."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.schema import PICKUP

YearMonth = tuple[int, int]


def write_lake(
    enriched: DataFrame,
    root: str,
    mode: str = "append",
    sort_by: str | None = PICKUP,
    rows_per_file: int = 0,
    gather: bool = True,
) -> None:
    """Write trips partitioned by year and month.

    Rows are gathered by month through a rebalance rather than a plain repartition:
    AQE cuts a month that outgrows the advisory partition size into several tasks and
    merges small ones, so no month is ever one task. Sorting each task's rows by month
    is what the writer needs anyway; adding the pickup time gives Parquet useful
    min/max statistics. Without adaptive execution every month is spread over all
    shuffle partitions by a hash of the row. Without ``gather`` rows stay in the tasks they are in,
    for callers that have dealt months to tasks.

    Times are stored as ``session.prepare`` says, INT64 with statistics.
    """
    order = ["year", "month"] + ([sort_by] if sort_by else [])
    rows = _gathered(enriched) if gather else enriched
    writer = rows.sortWithinPartitions(*order).write
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.partitionBy("year", "month").mode(mode).parquet(root)


def _gathered(enriched: DataFrame) -> DataFrame:
    conf = enriched.sparkSession.conf
    if conf.get("spark.sql.adaptive.enabled") == "true":
        return enriched.hint("rebalance", "year", "month")
    spread = F.pmod(F.xxhash64(*enriched.columns), F.lit(int(conf.get("spark.sql.shuffle.partitions"))))
    return enriched.repartition("year", "month", spread)


def read_lake(
    spark: SparkSession,
    root: str,
    since: YearMonth | None = None,
    until: YearMonth | None = None,
    ledger: DataFrame | None = None,
    schema: str | None = None,
) -> DataFrame:
    """The lake's trips, optionally from month ``since`` to month ``until`` inclusive.

    The bounds test partition columns only, so other months are never listed for
    reading. A lake written in batches needs its ``ledger``: only batches recorded as
    loaded are read, which hides whatever a load that died half-way left behind. That is a
    semi-join on the partition column, so Spark prunes the folders of other batches.
    ``batch_id`` is dropped.

    The schema comes from the files unless given.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    lake = reader.parquet(root)
    for bound in _month_bounds(since, until):
        lake = lake.where(bound)
    if "batch_id" not in lake.columns:
        return lake
    if ledger is None:
        raise ValueError("a lake written in batches is read through its ledger")
    return lake.join(loaded_batches(ledger), "batch_id", "left_semi").drop("batch_id")


def loaded_batches(ledger: DataFrame) -> DataFrame:
    """The ids of the batches that are complete and not merged into another."""
    merged = ledger.where(F.col("status") == "merged").select("batch_id")
    loaded = ledger.where(F.col("status") == "loaded").select("batch_id").distinct()
    return loaded.join(merged, "batch_id", "left_anti")


def _month_bounds(since: YearMonth | None, until: YearMonth | None) -> list[Column]:
    year, month = F.col("year"), F.col("month")
    bounds = []
    if since is not None:
        bounds.append((year > since[0]) | ((year == since[0]) & (month >= since[1])))
    if until is not None:
        bounds.append((year < until[0]) | ((year == until[0]) & (month <= until[1])))
    return bounds


def write_report(
    report: DataFrame, path: str, sort_by: str = "date", one_file: bool = False
) -> None:
    """Write a new version of the report below ``path``, then drop the older ones.

    A version counts once it is complete, so a run that dies on the way leaves the last
    report in place. ``one_file`` sends its rows, one per day, through one task.
    """
    spark = report.sparkSession
    report = report.repartition(1).sortWithinPartitions(sort_by) if one_file else report.orderBy(sort_by)
    older = _versions(spark, path)
    report.write.parquet(f"{path}/version={time.time_ns():020d}-{uuid.uuid4().hex[:8]}")
    system, _ = _hadoop(spark, path)
    for name in older:
        system.delete(_path(spark, f"{path}/{name}"), True)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version of the report."""
    versions = _versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no complete report below {path}")
    return spark.read.parquet(f"{path}/{versions[-1]}")


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Complete versions, oldest first."""
    system, folder = _hadoop(spark, path)
    if not system.exists(folder):
        return []
    names = [entry.getPath().getName() for entry in system.listStatus(folder)]
    done = [n for n in names if n.startswith("version=") and system.exists(_path(spark, f"{path}/{n}/_SUCCESS"))]
    return sorted(done)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """What the files below a folder add up to."""
    system, folder = _hadoop(spark, path)
    return system.getContentSummary(folder).getLength()


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder and those above it, unless it is there."""
    system, folder = _hadoop(spark, path)
    system.mkdirs(folder)


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _hadoop(spark: SparkSession, path: str):
    """The file system that holds ``path``, and the path in its own terms."""
    folder = _path(spark, path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder
