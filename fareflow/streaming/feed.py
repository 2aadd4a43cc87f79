"""Daily statistics of a lake of batches, kept up to date by a stream over its ledger."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fareflow.operators.stats import merged_days
from fareflow.plans.report import add_missing_sums, counted_sums, read_sums
from fareflow.schema import LEDGER_COLUMNS
from fareflow.sources.ledger import read_ledger


def follow_ledger(
    spark: SparkSession,
    lake_root: str,
    ledger_root: str,
    sums_root: str,
    checkpoint: str,
    files_per_trigger: int | None = 1_000,
    until_done: bool = True,
) -> StreamingQuery:
    """Keep the daily sums of every batch that the ledger names.

    The ledger is the stream, not the lake's folders: a micro-batch sums the batches that its
    rows record as loaded. A folder without a ledger row is never looked at, one recorded late
    is summed when its row comes, and a batch that compaction made takes over the sums of
    those it replaced. Batches that are merged by then, or have their sums, are skipped, so
    rows that come twice and a micro-batch that is run again change nothing. What is behind the
    checkpoint but has no sums (a lost folder of sums, say) is made up for at the start.

    ``until_done`` stops when the ledger has been read; else the stream goes on.
    """
    add_missing_sums(spark, lake_root, read_ledger(spark, ledger_root), sums_root)
    reader = spark.readStream.schema(LEDGER_COLUMNS).option("maxFileAge", "36500d")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)

    def keep(rows: DataFrame, number: int) -> None:
        session = rows.sparkSession
        named = rows.where(F.col("status") == "loaded").select("batch_id").distinct()
        add_missing_sums(session, lake_root, read_ledger(session, ledger_root), sums_root, named)

    writer = reader.parquet(ledger_root).writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if until_done else writer).start()


def followed_report(
    spark: SparkSession, ledger_root: str, sums_root: str, calculated_at: Column | datetime | None = None
) -> DataFrame:
    """Every measure by day over the batches summed so far.

    Right at any time: a merged batch counts until the stream has seen what replaced it.
    """
    counted = counted_sums(read_sums(spark, sums_root), read_ledger(spark, ledger_root))
    return merged_days(counted, calculated_at)
