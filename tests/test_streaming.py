"""The streams agree with their batch forms."""

from datetime import datetime, timedelta
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fareflow.operators.stats import daily_stats_full
from fareflow.operators.trips import enrich_trips
from fareflow.plans.compact import compact_lake, remove_merged
from fareflow.plans.load import lake_rows
from fareflow.plans.load import load_new_files
from fareflow.plans.report import read_sums
from fareflow.schema import BATCH_LAKE_COLUMNS
from fareflow.sources.lake import read_lake, write_lake
from fareflow.sources.ledger import one_row, read_ledger, record
from fareflow.sources.tables import trips_from_tables
from fareflow.sources.trip_csv import read_trip_csv, stream_trip_csv
from fareflow.streaming.feed import follow_ledger, followed_report
from fareflow.streaming.load import stream_to_lake, with_source_file
from fareflow.streaming.stats import append_closed_days, finish, keep_daily_sums, stream_lake, streamed_report
from tests.helpers import make_trips
from tests.test_load import line, put

AT = datetime(2024, 1, 1)


def as_rows(df):
    return sorted(map(tuple, df.drop("calculated_at").collect()))


@pytest.fixture
def folders(tmp_path):
    raw = tmp_path / "raw"
    put(raw, "a.csv", *[line(1 + n % 20) for n in range(60)])
    put(raw, "sub/b.csv", line(3), line(4, pickup=False), "too,short")
    return raw, str(tmp_path / "lake"), str(tmp_path / "checkpoint")


def run(spark, raw, lake, checkpoint):
    stream = stream_trip_csv(spark, str(raw), files_per_trigger=1)
    stream_to_lake(stream, lake, lake + "-ledger", checkpoint, AT).awaitTermination()


def read(spark, lake):
    return read_lake(spark, lake, ledger=read_ledger(spark, lake + "-ledger"))


def test_stream_loads_each_file_once(spark, folders):
    raw, lake, checkpoint = folders
    run(spark, raw, lake, checkpoint)
    assert read(spark, lake).count() == 61
    run(spark, raw, lake, checkpoint)
    assert read(spark, lake).count() == 61
    put(raw, "c.csv", line(21), line(22))
    run(spark, raw, lake, checkpoint)
    assert read(spark, lake).count() == 63


def test_micro_batch_run_again_replaces_its_folder(spark, folders):
    """A crash after the write and before the commit repeats the micro-batch."""
    raw, lake, checkpoint = folders
    run(spark, raw, lake, checkpoint)
    last = max((Path(checkpoint) / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    run(spark, raw, lake, checkpoint)
    assert read(spark, lake).count() == 61


def test_stream_gathers_months(spark, folders):
    raw, lake, checkpoint = folders
    run(spark, raw, lake, checkpoint)
    for batch in Path(lake).glob("batch_id=*"):
        assert len(list(batch.rglob("*.parquet"))) == len(list(batch.rglob("month=*")))


def test_stream_stores_times_with_statistics(spark, folders):
    raw, lake, checkpoint = folders
    run(spark, raw, lake, checkpoint)
    meta = pq.ParquetFile(next(Path(lake).rglob("year=*/**/*.parquet"))).metadata
    kinds = {meta.schema.column(i).name: meta.schema.column(i).physical_type for i in range(len(meta.schema))}
    assert kinds["tpep_pickup_datetime"] == "INT64"


def test_stream_and_batch_load_the_same_rows(spark, folders):
    raw, lake, checkpoint = folders
    run(spark, raw, lake, checkpoint)
    paths = [str(p) for p in raw.rglob("*.csv")]
    batch = lake_rows(read_trip_csv(spark, paths), AT)
    columns = ["tpep_pickup_datetime", "trip_distance", "total_amount", "year", "month"]
    assert as_rows(read(spark, lake).select(columns)) == as_rows(batch.select(columns))


def test_source_file_is_kept_on_request(spark, folders):
    raw, lake, checkpoint = folders
    stream = with_source_file(stream_trip_csv(spark, str(raw)))
    stream_to_lake(stream, lake, lake + "-ledger", checkpoint, AT).awaitTermination()
    sources = {r.source_file.rsplit("/", 1)[1] for r in read(spark, lake).collect()}
    assert sources == {"a.csv", "b.csv"}


def test_streams_and_reads_of_batches_need_the_ledger(spark, folders):
    raw, lake, _ = folders
    load_new_files(spark, str(raw), lake, lake + "-ledger")
    with pytest.raises(ValueError, match="ledger"):
        read_lake(spark, lake)
    for schema in (BATCH_LAKE_COLUMNS, BATCH_LAKE_COLUMNS.replace(", batch_id STRING", "")):
        with pytest.raises(ValueError, match="ledger"):
            stream_lake(spark, lake, schema)


@pytest.fixture(scope="module")
def lake(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("stream") / "lake")
    rows = enrich_trips(trips_from_tables(spark, sf_dir), AT)
    write_lake(rows, root)
    return root, rows.schema


@pytest.mark.parametrize("files", [40, 7])
def test_streamed_report_equals_batch(spark, lake, tmp_path, files):
    """Many micro-batches, and months in the order the files happen to come."""
    root, schema = lake
    path = str(tmp_path / "sums")
    stream = stream_lake(spark, root, schema, files_per_trigger=files)
    keep_daily_sums(stream, path, str(tmp_path / "ck")).awaitTermination()
    batch = daily_stats_full(read_lake(spark, root))
    assert as_rows(streamed_report(spark, path)) == as_rows(batch)


def late_months_first(spark, rows, root):
    for year in (1999, 1996):
        write_lake(rows.where(F.col("year") == year), root)


def test_late_months_first_lose_nothing(spark, sf_dir, tmp_path):
    rows = enrich_trips(trips_from_tables(spark, sf_dir), AT)
    root, path = str(tmp_path / "lake"), str(tmp_path / "sums")
    late_months_first(spark, rows, root)
    stream = stream_lake(spark, root, rows.schema, files_per_trigger=6)
    keep_daily_sums(stream, path, str(tmp_path / "ck")).awaitTermination()
    assert as_rows(streamed_report(spark, path)) == as_rows(daily_stats_full(read_lake(spark, root)))


def test_rows_behind_the_watermark_are_an_error(spark, sf_dir, tmp_path):
    rows = enrich_trips(trips_from_tables(spark, sf_dir), AT)
    root = str(tmp_path / "lake")
    late_months_first(spark, rows, root)
    stream = stream_lake(spark, root, rows.schema, files_per_trigger=6)
    query = append_closed_days(stream, str(tmp_path / "days"), str(tmp_path / "ck"))
    with pytest.raises(RuntimeError, match="watermark"):
        finish(query)


def test_closed_days_are_a_subset_of_batch(spark, lake, tmp_path):
    root, schema = lake
    path = str(tmp_path / "days")
    finish(append_closed_days(stream_lake(spark, root, schema, files_per_trigger=None), path, str(tmp_path / "ck")))
    closed = spark.read.parquet(path)
    batch = daily_stats_full(read_lake(spark, root))
    closed_rows, batch_rows = as_rows(closed), as_rows(batch)
    assert set(closed_rows) <= set(batch_rows)
    assert 0 < len(batch_rows) - len(closed_rows) <= 3
    newest = batch.agg(F.max("date")).first()[0]
    assert closed.where(F.col("date") == newest).isEmpty()


def test_used_checkpoint_is_refused_for_batches(spark, folders, tmp_path):
    raw, lake, _ = folders
    load_new_files(spark, str(raw), lake, lake + "-ledger")
    book, checkpoint = read_ledger(spark, lake + "-ledger"), str(tmp_path / "once")
    stream = stream_lake(spark, lake, BATCH_LAKE_COLUMNS, ledger=book, checkpoint=checkpoint)
    keep_daily_sums(stream, str(tmp_path / "sums"), checkpoint).awaitTermination()
    with pytest.raises(ValueError, match="has been used"):
        stream_lake(spark, lake, BATCH_LAKE_COLUMNS, ledger=book, checkpoint=checkpoint)


class Followed:
    """A lake of batches whose ledger a stream follows."""

    def __init__(self, spark, folder):
        self.spark, self.lake, self.ledger, self.sums = spark, f"{folder}/l", f"{folder}/b", f"{folder}/s"
        self.checkpoint = f"{folder}/c"

    def write(self, name, days):
        pickups = [datetime(2024, 1, d, 10) for d in days]
        rows = make_trips(self.spark, *[
            {"tpep_pickup_datetime": p, "tpep_dropoff_datetime": p + timedelta(minutes=10)} for p in pickups
        ])
        write_lake(enrich_trips(rows, AT), f"{self.lake}/batch_id={name}", "overwrite")

    def enter(self, name):
        record(self.ledger, one_row(self.spark), name, "loaded", AT)

    def follow(self):
        query = follow_ledger(self.spark, self.lake, self.ledger, self.sums, self.checkpoint, files_per_trigger=1)
        query.awaitTermination()
        return query

    def trips(self):
        return {r.date.day: r.total_trips for r in followed_report(self.spark, self.ledger, self.sums).collect()}


def test_followed_ledger_counts_every_trip_once(spark, tmp_path):
    it = Followed(spark, tmp_path)
    it.write("b1", [1, 2])
    it.write("b2", [2, 3])
    it.enter("b1")
    it.follow()
    assert it.trips() == {1: 1, 2: 1}
    it.enter("b2")  # recorded late
    it.follow()
    assert it.trips() == {1: 1, 2: 2, 3: 1}
    it.write("b3", [9])
    it.enter("b3")  # merged before the stream sees it
    compact_lake(spark, it.lake, it.ledger, fan_in=3)
    remove_merged(spark, it.lake, it.ledger)
    assert it.trips() == {1: 1, 2: 2, 3: 1}
    it.follow()
    assert it.trips() == {1: 1, 2: 2, 3: 1, 9: 1}
    it.write("b4", [9])
    it.enter("b4")
    compact_lake(spark, it.lake, it.ledger, fan_in=2)  # merges what a merge had made
    assert it.trips() == {1: 1, 2: 2, 3: 1, 9: 1}
    it.follow()
    assert it.trips() == {1: 1, 2: 2, 3: 1, 9: 2}
    it.follow()
    assert it.trips() == {1: 1, 2: 2, 3: 1, 9: 2}


def test_merge_of_a_merge_that_was_never_followed(spark, tmp_path):
    it = Followed(spark, tmp_path)
    for k, name in enumerate(("b1", "b2")):
        it.write(name, [1 + k])
        it.enter(name)
    it.follow()
    compact_lake(spark, it.lake, it.ledger, fan_in=2)
    it.write("b3", [5])
    it.enter("b3")
    compact_lake(spark, it.lake, it.ledger, fan_in=2)
    remove_merged(spark, it.lake, it.ledger)
    assert it.trips() == {1: 1, 2: 1}
    it.follow()
    assert it.trips() == {1: 1, 2: 1, 5: 1}


def test_merged_batch_takes_over_sums_unread(spark, tmp_path):
    it = Followed(spark, tmp_path)
    for name in ("b1", "b2"):
        it.write(name, [4])
        it.enter(name)
    it.follow()
    (new,) = compact_lake(spark, it.lake, it.ledger, fan_in=2)
    for file in Path(f"{it.lake}/batch_id={new}").rglob("*.parquet"):
        file.write_bytes(b"broken")  # a reader would fail
    it.follow()
    assert it.trips() == {4: 2}
    assert read_sums(spark, it.sums).where(F.col("batch_id") == new).count() == 1


def test_lost_sums_are_made_up_for(spark, tmp_path):
    it = Followed(spark, tmp_path)
    it.write("b1", [4])
    it.enter("b1")
    it.follow()
    it.sums += "-elsewhere"
    it.follow()
    assert it.trips() == {4: 1}
