"""CSV files to lake as a stream; its checkpoint is the record of what is loaded."""

from __future__ import annotations

import hashlib
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fareflow.operators.trips import enrich_trips, normalize_columns
from fareflow.sources.lake import stored_bytes, write_lake
from fareflow.sources.ledger import one_row, record


def with_source_file(raw: DataFrame) -> DataFrame:
    """Add the path each row was read from."""
    return raw.select("*", F.col("_metadata.file_path").alias("source_file"))


def stream_to_lake(
    raw: DataFrame,
    lake_root: str,
    ledger_root: str,
    checkpoint: str,
    loaded_at: Column | datetime | None = None,
) -> StreamingQuery:
    """Append a stream of raw trips to a lake and stop when the backlog is done.

    Each micro-batch goes to its own ``batch_id=...`` folder, gathered by month as the
    batch load does, and is then recorded in the ledger. Its name follows from the
    checkpoint and the micro-batch's number: one that is run again after a crash replaces
    its folder, so a file counts once. Readers go through the ledger, as for batch loads.
    """
    rows = enrich_trips(normalize_columns(raw), loaded_at)
    name = hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def load(batch: DataFrame, number: int) -> None:
        batch_id = f"s-{name}-{number}"
        folder = f"{lake_root}/batch_id={batch_id}"
        write_lake(batch, folder, "overwrite")
        written = F.lit(stored_bytes(batch.sparkSession, folder)).cast("long")
        entry = one_row(batch.sparkSession).withColumn("length", written)
        record(ledger_root, entry, batch_id, "loaded", datetime.now(timezone.utc))

    return (
        rows.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
