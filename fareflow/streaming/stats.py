"""Daily statistics kept up to date by a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fareflow.operators.stats import closing_days, daily_sums, merged_days
from fareflow.schema import DROPOFF, PICKUP
from fareflow.sources.lake import loaded_batches


def stream_lake(
    spark: SparkSession,
    root: str,
    schema: str,
    files_per_trigger: int | None = 10_000,
    ledger: DataFrame | None = None,
    checkpoint: str | None = None,
) -> DataFrame:
    """The lake's Parquet files as a stream.

    A lake written in batches needs its ledger, and the stream then shows the batches that are
    loaded when it starts, in one pass. A second run would miss batches that were recorded late and
    repeat merged ones, so the ``checkpoint`` must be given too, and an error is raised if it has
    been used. For statistics that go on, see ``feed.follow_ledger``.
    """
    reader = spark.readStream.schema(schema).option("maxFileAge", "36500d")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    lake = reader.parquet(root)
    if "batch_id" not in lake.columns:
        if _written_in_batches(spark, root):
            raise ValueError("give the schema with batch_id, and the ledger")
        return lake
    if ledger is None or checkpoint is None:
        raise ValueError("a lake written in batches is read through its ledger, with a fresh checkpoint")
    if _found(spark, f"{checkpoint}/offsets/*"):
        raise ValueError(f"{checkpoint} has been used; a lake of batches is streamed in one pass")
    return lake.join(loaded_batches(ledger), "batch_id", "left_semi").drop("batch_id")


def _written_in_batches(spark: SparkSession, root: str) -> bool:
    return _found(spark, f"{root}/batch_id=*")


def _found(spark: SparkSession, pattern: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def keep_daily_sums(trips: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write every micro-batch's sums by day to a folder of its own below ``path``.

    Nothing is ever late and no state is held: ``streamed_report`` merges the sums. Only the
    days a micro-batch touches are written; one that is run again replaces its folder.
    """

    def keep(batch: DataFrame, number: int) -> None:
        daily_sums(batch).write.mode("overwrite").parquet(f"{path}/part={number}")

    return (
        trips.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def streamed_report(spark: SparkSession, path: str) -> DataFrame:
    """Every measure by day over all micro-batches so far."""
    return merged_days(spark.read.parquet(path))


def append_closed_days(
    trips: DataFrame, path: str, checkpoint: str, late_by: str = "1 day", pickup: str = PICKUP
) -> StreamingQuery:
    """Append each day once the watermark has passed it.

    Pass the query to ``finish``, which fails if a row came too late to count.
    """
    zoned = trips.withColumns({c: F.col(c).cast("timestamp") for c in (pickup, DROPOFF)})
    return (
        closing_days(zoned, late_by, pickup).writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def finish(query: StreamingQuery) -> None:
    """Wait for a stream to end; rows dropped behind its watermark are an error."""
    late: dict[int, int] = {}
    over = False
    while not over:
        over = query.awaitTermination(1)
        for step in query.recentProgress:
            late[step["batchId"]] = sum(s["numRowsDroppedByWatermark"] for s in step["stateOperators"])
    dropped = sum(late.values())
    if dropped:
        raise RuntimeError(f"{dropped} late row(s) or partial sums came behind the watermark and are not in the result")
