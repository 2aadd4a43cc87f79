"""The daily report: rebuilt from the lake, or kept up to date from sums per batch and day."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.operators.stats import added_sums, daily_stats_full, daily_sums, merged_days
from fareflow.schema import BATCH_LAKE_COLUMNS, DAILY_REPORT, SUMS_COLUMNS
from fareflow.session import scratch_path
from fareflow.sources.claims import claimed
from fareflow.sources.lake import loaded_batches, read_report, write_report
from fareflow.sources.ledger import read_ledger, unpublished_batches


def refresh_daily_report(
    trips: DataFrame,
    path: str,
    calculated_at: Column | datetime | None = None,
    one_file: bool = False,
) -> DataFrame:
    """Write a new version of the report and return it as read back.

    The trips are read once; looking at the result costs no second run.
    """
    report = daily_stats_full(trips, calculated_at).select(*DAILY_REPORT)
    write_report(report, path, one_file=one_file)
    return read_report(trips.sparkSession, path).orderBy("date")


def add_batch_sums(spark: SparkSession, lake_root: str, ledger: DataFrame, sums_root: str) -> None:
    """Sum the batches that no report covers yet, by batch and day, into ``sums_root``.

    Only those batches are read. Their folders are replaced, so a repeated run adds nothing.
    """
    _sum_batches(spark, lake_root, unpublished_batches(ledger), sums_root)


def add_missing_sums(
    spark: SparkSession, lake_root: str, ledger: DataFrame, sums_root: str, among: DataFrame | None = None
) -> None:
    """Give every batch that readers see its sums, or those of them that ``among`` names.

    A batch that compaction made gets the sums of what it replaced where those are all there;
    only other batches without sums are read.
    """
    seen = loaded_batches(ledger)
    seen = seen if among is None else seen.join(among, "batch_id", "left_semi")
    sums = read_sums(spark, sums_root)
    known = sums.select("batch_id").distinct()
    missing = stored_ids(seen.join(known, "batch_id", "left_anti"))
    parts = ledger.where(F.col("status") == "merged").select("batch_id", F.col("merged_into").alias("into"))
    parts = parts.join(missing.select(F.col("batch_id").alias("into")), "into", "left_semi")
    marked = parts.join(known.withColumn("known", F.lit(True)), "batch_id", "left")
    whole = marked.groupBy("into").agg(F.bool_and(F.coalesce("known", F.lit(False))).alias("whole"))
    whole = stored_ids(whole.where("whole").select(F.col("into").alias("batch_id")))
    if not whole.isEmpty():
        taken = parts.join(whole.select(F.col("batch_id").alias("into")), "into", "left_semi")
        carried = sums.join(taken, "batch_id").drop("batch_id").withColumnRenamed("into", "batch_id")
        _write_sums(added_sums(carried, "batch_id"), sums_root)
    rest = missing.join(whole, "batch_id", "left_anti")
    if not rest.isEmpty():
        _sum_batches(spark, lake_root, rest, sums_root)


def stored_ids(ids: DataFrame) -> DataFrame:
    """A list of batches that stays as it is while sums are written."""
    path = scratch_path(ids.sparkSession, "batches")
    ids.write.parquet(path)
    return ids.sparkSession.read.schema(ids.schema).parquet(path)


def _sum_batches(spark: SparkSession, lake_root: str, ids: DataFrame, sums_root: str) -> None:
    lake = spark.read.schema(BATCH_LAKE_COLUMNS).parquet(lake_root)
    _write_sums(daily_sums(lake.join(ids, "batch_id", "left_semi"), "batch_id"), sums_root)


def _write_sums(sums: DataFrame, sums_root: str) -> None:
    rows = sums.repartition("batch_id").write.partitionBy("batch_id")
    rows.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(sums_root)


def carry_sums(spark: SparkSession, sums_root: str, ids: list[str], new: str) -> None:
    """Give a batch the sums of the batches it replaces."""
    rows = read_sums(spark, sums_root).where(F.col("batch_id").isin(ids)).drop("batch_id")
    added_sums(rows).coalesce(1).write.mode("overwrite").parquet(f"{sums_root}/batch_id={new}")


def read_sums(spark: SparkSession, sums_root: str) -> DataFrame:
    """Daily sums by batch; none if there are none yet. Any other error is raised."""
    try:
        sums = spark.read.option("basePath", sums_root).schema(SUMS_COLUMNS).parquet(sums_root)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SUMS_COLUMNS)
    return sums


def counted_sums(sums: DataFrame, ledger: DataFrame) -> DataFrame:
    """The sums that make up the report: each loaded trip's once.

    A batch gives way to the one it was merged into as soon as that one has sums, and counts
    until then.
    """
    loaded = ledger.where(F.col("status") == "loaded").select("batch_id").distinct()
    known = sums.select(F.col("batch_id").alias("merged_into")).distinct()
    replaced = ledger.where("merged_into IS NOT NULL").select("batch_id", "merged_into")
    replaced = replaced.join(known, "merged_into", "left_semi").select("batch_id").distinct()
    return sums.join(loaded, "batch_id", "left_semi").join(replaced, "batch_id", "left_anti")


def merge_batch_sums(
    spark: SparkSession, ledger: DataFrame, sums_root: str, path: str, calculated_at: Column | datetime | None = None
) -> DataFrame:
    """The report over all loaded batches, from their sums alone."""
    counted = counted_sums(read_sums(spark, sums_root), ledger)
    write_report(merged_days(counted, calculated_at).select(*DAILY_REPORT), path)
    return read_report(spark, path).orderBy("date")


def update_report(
    spark: SparkSession,
    ledger_root: str,
    sums_root: str,
    path: str,
    fresh: DataFrame,
    calculated_at: Column | datetime | None = None,
) -> tuple[DataFrame, int]:
    """The report with the days of ``fresh`` batches merged anew, and how many days those are.

    The other days are carried over from the last version as they are, with the time they were
    calculated at; that version has to cover every published batch. Sums are looked up between
    the first and the last of the days only. Without a last version all days are merged. Updates
    take turns and read the ledger when it is theirs, so none loses what another has reported.
    """
    with claimed(spark, path, "report"):
        sums = read_sums(spark, sums_root)
        counted = counted_sums(sums, read_ledger(spark, ledger_root))
        try:
            last = read_report(spark, path)
        except FileNotFoundError:
            days = stored_ids(counted.select("bucket").distinct())
            report = merged_days(counted, calculated_at).select(*DAILY_REPORT)
        else:
            days = stored_ids(sums.join(fresh, "batch_id", "left_semi").select("bucket").distinct())
            ends = days.agg(F.min("bucket").alias("lowest"), F.max("bucket").alias("highest")).first()
            # A day more at both ends, for hours that the driver's own zone has twice.
            day = timedelta(days=1)
            between = F.col("bucket").between(ends.lowest - day, ends.highest + day) if ends.lowest else F.lit(False)
            merged = merged_days(counted.where(between).join(days, "bucket", "left_semi"), calculated_at)
            carried = last.join(days.select(F.col("bucket").alias("date")), "date", "left_anti")
            report = carried.select(*DAILY_REPORT).unionByName(merged.select(*DAILY_REPORT))
        write_report(report, path)
        return read_report(spark, path).orderBy("date"), days.count()
