"""CSV files to lake as a stream over announcements, not over the files themselves.

An announcement is a small Parquet file that names files to load. The stream remembers
announcements, one a walk, and never the raw files, however many there are.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from fareflow.plans.load import LoadReport, load_new_files, stored_listing
from fareflow.sources.lake import make_folder
from fareflow.sources.ledger import new_files, read_ledger

FILES = "path string, length bigint, modified_at timestamp"
# Announcements are written in order of time, so one that is older than the newest by more than
# this has been read; the stream forgets it.
REMEMBERED = "7d"


def announce(files: DataFrame, ledger_root: str, arrivals_root: str) -> int:
    """Announce the listed files that are not loaded yet, in one Parquet file. Returns their number.

    A file that was announced before and is not loaded is announced again, so nothing hangs on
    an announcement that got lost or failed. Announcing nothing writes nothing.
    """
    pending = new_files(files, read_ledger(files.sparkSession, ledger_root))
    pending = stored_listing(pending.select("path", "length", "modified_at"))
    count = pending.count()
    if count:
        pending.coalesce(1).write.mode("append").parquet(arrivals_root)
    return count


def load_arrivals(
    spark: SparkSession,
    arrivals_root: str,
    lake_root: str,
    ledger_root: str,
    checkpoint: str,
    loaded_at: datetime | None = None,
    files_per_batch: int = 10_000,
    match_header: bool = False,
    most_malformed: float = 1.0,
    per_trigger: int = 1,
    until_done: bool = True,
    seen: Callable[[LoadReport], None] | None = None,
) -> StreamingQuery:
    """Load what is announced, each file once, with malformed lines counted as the batch load does.

    A micro-batch takes ``per_trigger`` announcements and loads their files that the ledger does
    not hold, under the load's claim. So files announced twice, a micro-batch that is run
    again after a crash, and batch loads at the same time load nothing twice. A file that cannot
    be read is recorded as failed and stays new: the next announcement names it again.
    Announcements that are done are deleted by the stream. ``seen`` is shown each micro-batch's report.
    A folder that does not exist yet holds no announcements.
    """
    make_folder(spark, arrivals_root)
    reader = (
        spark.readStream.schema(FILES)
        .option("maxFilesPerTrigger", per_trigger)
        .option("maxFileAge", REMEMBERED)
        .option("cleanSource", "delete")
    )

    def load(rows: DataFrame, number: int) -> None:
        named = stored_listing(rows.dropDuplicates(["path"]))
        report = load_new_files(
            named.sparkSession, "", lake_root, ledger_root, loaded_at,
            files_per_batch, match_header, named, most_malformed,
        )
        if seen is not None:
            seen(report)

    writer = reader.parquet(arrivals_root).writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if until_done else writer).start()
