"""Run the jobs from a shell: ``spark-submit ... -m fareflow`` or ``python -m fareflow``.

Cluster, memory and store settings come from spark-submit, as for any Spark job.
"""

from __future__ import annotations

import argparse

from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import SparkSession

from fareflow.operators import fares, stats
from fareflow.plans.compact import compact_lake
from fareflow.plans.daily import Folders, run_daily
from fareflow.plans.load import load_new_files
from fareflow.plans.report import refresh_daily_report
from fareflow.plans.train import TrainReport, train_fares
from fareflow.schema import TRIP_COLUMNS
from fareflow.session import prepare
from fareflow.sources.lake import read_lake
from fareflow.sources.ledger import list_files, read_ledger
from fareflow.sources.listing import walk_folders
from fareflow.sources.trip_csv import stream_trip_csv
from fareflow.streaming.arrivals import announce, load_arrivals
from fareflow.streaming.feed import follow_ledger, followed_report
from fareflow.streaming.load import stream_to_lake


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="fareflow", description=__doc__.splitlines()[0])
    jobs = parser.add_subparsers(dest="job", required=True)
    folders = {
        "raw": "CSV files, at any depth",
        "lake": "Parquet trips",
        "ledger": "record of loaded files",
        "checkpoint": "the stream's record of what it has read",
        "arrivals": "announcements of files to load",
        "sums": "daily sums by batch",
        "report": "daily statistics",
        "model": "fitted fare model",
        "listing": "index of the raw folder; with one, only folders that have changed are listed",
    }

    def job(name: str, text: str, *needed: str, optional: tuple[str, ...] = ()) -> None:
        sub = jobs.add_parser(name, help=text)
        for folder in (*needed, *optional):
            sub.add_argument(f"--{folder}", required=folder in needed, help=folders[folder])

    job("load", "load new CSV files into the lake", "raw", "lake", "ledger", optional=("listing",))
    job("stream", "the same as a stream", "raw", "lake", "ledger", "checkpoint")
    job(
        "arrivals", "announce new CSV files and load what is announced, as a stream",
        "raw", "lake", "ledger", "arrivals", "checkpoint", optional=("listing",),
    )
    job("follow", "daily statistics as a stream over the ledger", "lake", "ledger", "sums", "checkpoint")
    job("compact", "merge the lake's small batches", "lake", "ledger", optional=("sums",))
    job("report", "rebuild the daily statistics", "lake", "report", optional=("ledger",))
    job("preview", "first days of the statistics and trips per month", "lake", optional=("ledger",))
    job("train", "fit and save the fare model", "lake", "model", optional=("ledger",))
    job("score", "try a saved model on a few trips", "model")
    job("run", "load, report and train", "raw", "lake", "ledger", "report", "model", optional=("listing",))
    return parser


def _trips(spark: SparkSession, args: argparse.Namespace):
    ledger = read_ledger(spark, args.ledger) if args.ledger else None
    # read_lake refuses a lake of batches without a ledger
    return read_lake(spark, args.lake, ledger=ledger)


def _show(training: TrainReport) -> None:
    print(training.summary.formula)
    print(f"{training.quality.n} test rows, RMSE {training.quality.rmse:.2f}, "
          f"R2 {training.quality.r2:.4f}")
    training.examples.show()


def main() -> None:
    args = _parser().parse_args()
    spark = prepare(SparkSession.builder.appName(f"fareflow {args.job}").getOrCreate())
    try:
        if args.job == "load":
            files = walk_folders(spark, args.raw, args.listing).files if args.listing else None
            report = load_new_files(spark, args.raw, args.lake, args.ledger, files=files)
            print(f"{report.loaded} file(s) loaded")
            report.check()
        elif args.job == "stream":
            raw = stream_trip_csv(spark, args.raw, TRIP_COLUMNS)
            stream_to_lake(raw, args.lake, args.ledger, args.checkpoint).awaitTermination()
        elif args.job == "arrivals":
            files = walk_folders(spark, args.raw, args.listing).files if args.listing else list_files(spark, args.raw)
            print(f"{announce(files, args.ledger, args.arrivals)} file(s) announced")
            load_arrivals(spark, args.arrivals, args.lake, args.ledger, args.checkpoint).awaitTermination()
        elif args.job == "compact":
            made = compact_lake(spark, args.lake, args.ledger, args.sums)
            print(f"{len(made)} merged batch(es) written")
        elif args.job == "follow":
            follow_ledger(spark, args.lake, args.ledger, args.sums, args.checkpoint).awaitTermination()
            stats.first_days(followed_report(spark, args.ledger, args.sums)).show()
        elif args.job == "report":
            refresh_daily_report(_trips(spark, args), args.report).show(5)
        elif args.job == "preview":
            trips = _trips(spark, args)
            stats.first_days(stats.daily_stats_full(trips)).show()
            stats.monthly_counts(trips).show(100)
        elif args.job == "train":
            _show(train_fares(_trips(spark, args), args.model))
        elif args.job == "score":
            model = LinearRegressionModel.load(args.model)
            fares.describe_model(spark, model).show(truncate=False)
            fares.score(fares.named_trips(spark), model).show(truncate=False)
        else:
            run = run_daily(
                spark, Folders(args.raw, args.lake, args.ledger, args.report, args.model, args.listing)
            )
            if run.report is None:
                print("nothing new")
            else:
                run.report.show(5)
                _show(run.training)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
