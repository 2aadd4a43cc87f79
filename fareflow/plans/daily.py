"""The daily run: load, report, train; it stops early when nothing is new."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from fareflow.plans.load import LoadReport, load_new_files, mark_published, stored_listing
from fareflow.plans.report import add_batch_sums, update_report
from fareflow.plans.train import TrainReport, train_fares
from fareflow.schema import BATCH_LAKE_COLUMNS
from fareflow.sources.lake import read_lake
from fareflow.sources.ledger import has_new_data, list_files, read_ledger, unpublished_batches
from fareflow.sources.listing import walk_folders


@dataclass
class Folders:
    raw: str
    lake: str
    ledger: str
    report: str
    model: str
    listing: str | None = None
    """Index of ``raw``; with one, only folders that have changed are listed."""

    @property
    def sums(self) -> str:
        """Daily sums by batch, from which the report is merged."""
        return f"{self.report}-sums"


@dataclass
class DailyRun:
    load: LoadReport
    report: DataFrame | None = None
    days_rewritten: int = 0
    training: TrainReport | None = None
    open_before: bool = False
    open_after_load: bool = False
    open_after_publish: bool = False


def run_daily(
    spark: SparkSession, at: Folders, files_per_batch: int = 10_000, match_header: bool = False, strict: bool = True
) -> DailyRun:
    """Load what is new, bring the report up to date and fit the model anew.

    The gate is open while there are files to load or batches the report and the model do
    not cover. Behind a closed gate nothing runs. If the report or the fit fails, its batches
    stay unpublished, so the next run tries again even without new files. The report reads
    the new batches only and merges their days with the older sums; other days are carried over
    from its last version. The fit reads the lake. Unreadable files keep the gate open; ``strict`` raises for them after all else is done.
    """
    files = walk_folders(spark, at.raw, at.listing).files if at.listing else list_files(spark, at.raw)
    run = DailyRun(LoadReport(), open_before=has_new_data(files, read_ledger(spark, at.ledger)))
    if run.open_before:
        run.load = load_new_files(
            spark, at.raw, at.lake, at.ledger,
            files_per_batch=files_per_batch, match_header=match_header, files=files,
        )
        ledger = read_ledger(spark, at.ledger)
        run.open_after_load = not unpublished_batches(ledger).isEmpty()
    if run.open_after_load:
        fresh = stored_listing(unpublished_batches(ledger))
        add_batch_sums(spark, at.lake, ledger, at.sums)
        run.report, run.days_rewritten = update_report(spark, at.ledger, at.sums, at.report, fresh)
        trips = read_lake(spark, at.lake, ledger=ledger, schema=BATCH_LAKE_COLUMNS)
        run.training = train_fares(trips, at.model)
        mark_published(spark, at.ledger, fresh)
        run.open_after_publish = not unpublished_batches(read_ledger(spark, at.ledger)).isEmpty()
    if strict:
        run.load.check()
    return run
