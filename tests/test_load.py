"""Files in, each exactly once, whatever goes wrong on the way."""

import gzip
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fareflow.plans import daily
from fareflow.plans.compact import compact_lake, remove_merged
from fareflow.plans.daily import Folders, run_daily
import fareflow.sources.ledger as ledger_module
from fareflow.plans.load import LoadError, lake_rows, load_new_files
from fareflow.plans.report import read_sums
from fareflow.sources.lake import loaded_batches, read_lake, write_lake
from fareflow.sources.ledger import (
    absent_files,
    batch_sizes,
    has_new_data,
    list_files,
    new_files,
    read_ledger,
    unpublished_batches,
)
from fareflow.sources.trip_csv import read_trip_csv
from tests.helpers import NAMES, plan_of

HEADER = ",".join(NAMES)


def line(day, distance=2.0, pickup=True):
    values = {
        "vendorid": "1",
        "tpep_pickup_datetime": f"2015-01-{day:02d} 10:00:00" if pickup else "",
        "tpep_dropoff_datetime": f"2015-01-{day:02d} 10:12:00",
        "passenger_count": str(1 + day % 4),
        "trip_distance": str(distance),
        "fare_amount": str(3 + 2.5 * distance),
        "tip_amount": "1.0",
        "total_amount": str(5 + 2.5 * distance),
    }
    return ",".join(values.get(name, "") for name in NAMES)


def put(folder, name, *lines):
    target = folder / name
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text("\n".join([HEADER, *lines]) + "\n")


@pytest.fixture
def at(tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    names = ("lake", "ledger", "report", "model")
    return raw, Folders(str(raw), *[str(tmp_path / n) for n in names])


def lake_count(spark, at):
    return read_lake(spark, at.lake, ledger=read_ledger(spark, at.ledger)).count()


def load(spark, at, **options):
    return load_new_files(spark, at.raw, at.lake, at.ledger, **options)


def test_discovery_descends_and_keeps_only_csv(spark, at):
    raw, to = at
    put(raw, "a.csv", line(1))
    put(raw, "deep/er/b.csv", line(1))
    put(raw, "notes.txt", "x")
    found = list_files(spark, to.raw).collect()
    assert sorted(r.path.rsplit("/", 1)[1] for r in found) == ["a.csv", "b.csv"]
    assert all(r.length > 0 and r.modified_at for r in found)
    assert list_files(spark, to.raw).columns == ["path", "length", "modified_at"]


def test_listing_large_files_takes_few_tasks(spark, tmp_path, monkeypatch):
    """Sparse files of 200 MB, which Spark would deal out one by one."""
    monkeypatch.setattr(ledger_module, "LISTING_TASKS", 5)
    for n in range(40):
        with open(tmp_path / f"{n}.csv", "wb") as file:
            file.truncate(200 * 1024 * 1024)
    listing = list_files(spark, str(tmp_path))
    parts = [f for f in listing.inputFiles() if "part-" in f]
    assert listing.count() == 40 and len(parts) <= 6
    assert spark.conf.get("spark.sql.files.maxPartitionNum", None) is None


def test_loading_twice_is_loading_once(spark, at):
    raw, to = at
    put(raw, "a.csv", line(1), line(2, pickup=False))
    put(raw, "b.csv", line(3), "too,short")
    first = load(spark, to)
    assert first.loaded == 2 and lake_count(spark, to) == 2
    assert load(spark, to).loaded == 0 and lake_count(spark, to) == 2
    put(raw, "c.csv", line(4))
    assert load(spark, to).loaded == 1 and lake_count(spark, to) == 3


def test_malformed_lines_are_counted_by_file(spark, at):
    raw, to = at
    put(raw, "a b%20+c.csv", line(1), "too,short", line(2) + ",9", line(3).replace("10:12:00", "noon"))
    put(raw, "good.csv", line(4), line(5, pickup=False))
    put(raw, "nothing.csv")
    put(raw, "unplaced.csv", line(6, pickup=False) + ",9")
    report = load(spark, to)
    assert (report.loaded, report.failed, report.dropped) == (4, 0, 4) and lake_count(spark, to) == 2
    rows = {r.path.rsplit("/", 1)[1]: (r.status, r.dropped) for r in read_ledger(spark, to.ledger).collect()}
    assert rows == {"a b%20+c.csv": ("loaded", 3), "good.csv": ("loaded", 0), "nothing.csv": ("loaded", 0),
                    "unplaced.csv": ("loaded", 1)}


def test_a_batch_without_a_fitting_line_is_counted_too(spark, at):
    raw, to = at
    put(raw, "a.csv", "too,short", "x")
    put(raw, "none.csv")
    assert load(spark, to).dropped == 2
    assert load(spark, to).loaded == 0


def test_a_file_with_too_many_malformed_lines_fails(spark, at):
    raw, to = at
    put(raw, "half.csv", line(1), "too,short")
    put(raw, "most.csv", line(2), "too,short", "x")
    report = load(spark, to, most_malformed=0.5)
    assert (report.loaded, report.failed, report.dropped) == (1, 1, 1) and lake_count(spark, to) == 1
    rows = {r.path.rsplit("/", 1)[1]: (r.status, r.dropped, r.error) for r in read_ledger(spark, to.ledger).collect()}
    assert rows["half.csv"] == ("loaded", 1, None)
    assert rows["most.csv"][:2] == ("failed", 2) and "malformed" in rows["most.csv"][2]
    assert load(spark, to).loaded == 1 and lake_count(spark, to) == 2


def test_ledger_keeps_what_the_listing_says(spark, at):
    raw, to = at
    put(raw, "a.csv", line(1))
    listed = list_files(spark, to.raw).first()
    load(spark, to)
    entry = read_ledger(spark, to.ledger).first()
    assert (entry.path, entry.length, entry.modified_at) == tuple(listed)
    assert entry.status == "loaded" and entry.error is None
    assert abs((datetime.now() - entry.recorded_at).total_seconds()) < 600


def test_same_name_in_two_folders_is_two_files(spark, at):
    raw, to = at
    put(raw, "x/a.csv", line(1))
    put(raw, "y/a.csv", line(2))
    assert load(spark, to).loaded == 2 and lake_count(spark, to) == 2


def test_names_with_wildcards_and_blanks(spark, at):
    raw, to = at
    for day, name in enumerate(["a b.csv", "c[1].csv", "d{x,y}.csv", "e%20f.csv", "g?.csv"], 1):
        put(raw, name, line(day))
    report = load(spark, to)
    assert report.failed == 0 and report.loaded == 5
    assert lake_count(spark, to) == 5
    assert load(spark, to).loaded == 0


def test_batches_are_bounded(spark, at):
    raw, to = at
    for n in range(5):
        put(raw, f"{n}.csv", line(n + 1))
    report = load(spark, to, files_per_batch=2)
    assert report.loaded == 5 and 2 <= report.batches <= 3
    assert lake_count(spark, to) == 5


def test_unreadable_file_is_set_apart_and_tried_again(spark, at):
    raw, to = at
    for n in range(4):
        put(raw, f"{n}.csv", line(n + 1))
    broken = gzip.compress(("\n".join([HEADER] + [line(5, d / 7) for d in range(9000)])).encode())
    (raw / "9.csv.gz").write_bytes(broken[: len(broken) // 2])
    # A compressed file is picked up by its full suffix.
    listing = list_files(spark, to.raw, suffix=".csv*")
    assert listing.count() == 5
    import fareflow.plans.load as job

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(job, "list_files", lambda s, r: list_files(s, r, ".csv*"))
        report = load(spark, to)
        assert (report.loaded, report.batches, report.failed) == (4, 1, 1)
        entry = read_ledger(spark, to.ledger).where("status = 'failed'").first()
        assert "9.csv.gz" in entry.path == report.first_failed and "FAILED_READ_FILE" in entry.error
        with pytest.raises(LoadError):
            report.check()
        assert lake_count(spark, to) == 4
        (raw / "9.csv.gz").write_bytes(gzip.compress(f"{HEADER}\n{line(6)}\n".encode()))
        assert load(spark, to).loaded == 1
    assert lake_count(spark, to) == 5
    statuses = read_ledger(spark, to.ledger).groupBy("status").count().collect()
    assert {r.status: r["count"] for r in statuses} == {"loaded": 5, "failed": 1}


def test_file_with_another_header_is_set_apart_on_request(spark, at):
    raw, to = at
    put(raw, "a.csv", line(1))
    (raw / "b.csv").write_text(",".join(reversed(NAMES)) + f"\n{line(2)}\n")
    report = load(spark, to, match_header=True)
    assert (report.loaded, report.failed) == (1, 1) and report.first_failed.endswith("b.csv")


def test_errors_of_the_job_are_raised(spark, at):
    raw, to = at
    put(raw, "a.csv", line(1))
    with pytest.raises(Exception, match="(?i)mkdir|permission|not a directory|exist"):
        load_new_files(spark, to.raw, "/proc/nowhere", to.ledger)
    assert read_ledger(spark, to.ledger).isEmpty()


def test_leftovers_of_a_dead_run_are_not_read(spark, at):
    raw, to = at
    put(raw, "a.csv", line(1))
    rows = lake_rows(read_trip_csv(spark, to.raw))
    write_lake(rows, f"{to.lake}/batch_id=b-dead", "overwrite")
    assert load(spark, to).loaded == 1
    assert spark.read.parquet(to.lake).count() == 2
    assert lake_count(spark, to) == 1


def test_ledger_prunes_folders(spark, at):
    raw, to = at
    put(raw, "a.csv", line(1))
    load(spark, to)
    plan = plan_of(read_lake(spark, to.lake, ledger=read_ledger(spark, to.ledger)))
    assert "dynamicpruning" in plan.split("PartitionFilters: [")[1].split("]")[0]
    empty = read_ledger(spark, to.ledger + "-none")
    assert read_lake(spark, to.lake, ledger=empty).isEmpty()


def test_two_runs_over_the_same_files_count_once(spark, at):
    """Both start from the same ledger, as two concurrent runs do."""
    raw, to = at
    put(raw, "a.csv", line(1), line(2))
    put(raw, "b.csv", line(3))
    files = list_files(spark, to.raw)
    for book in ("one", "two"):
        load_new_files(spark, to.raw, to.lake, f"{to.ledger}/{book}", files=files)
    both = read_ledger(spark, f"{to.ledger}/one").union(read_ledger(spark, f"{to.ledger}/two"))
    assert read_lake(spark, to.lake, ledger=both).count() == 3


def test_missing_ledger_is_empty_but_a_broken_one_raises(spark, at, tmp_path):
    assert read_ledger(spark, str(tmp_path / "none")).isEmpty()
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        read_ledger(spark, str(tmp_path / "bad")).collect()


def test_missing_raw_folder_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        list_files(spark, str(tmp_path / "none")).collect()


def test_failed_files_stay_new(spark):
    listing = spark.createDataFrame([("a",), ("b",), ("c",)], "path string")
    ledger = spark.createDataFrame([("a", "loaded"), ("b", "failed")], "path string, status string")
    assert sorted(r.path for r in new_files(listing, ledger).collect()) == ["b", "c"]
    assert [r.path for r in absent_files(listing, listing.where("path < 'c'")).collect()] == ["c"]


def test_daily_run_end_to_end(spark, at):
    raw, to = at
    put(raw, "a.csv", *[line(1 + n % 28, 0.5 + n / 10) for n in range(200)])
    run = run_daily(spark, to)
    assert run.load.loaded == 1
    assert run.report.count() == 28 and run.report.agg(F.sum("total_trips")).first()[0] == 200
    assert run.training.quality.n > 0 and run.training.summary.per_mile > 2
    assert run.training.examples.count() == 5
    ledger = read_ledger(spark, to.ledger)
    assert not has_new_data(list_files(spark, to.raw), ledger)
    again = run_daily(spark, to)
    assert again.load.loaded == 0 and again.report is None and again.training is None


def test_daily_run_by_an_index(spark, at, tmp_path):
    raw, to = at
    to.listing = str(tmp_path / "listing")
    put(raw, "deep/a.csv", *[line(1 + n % 28, 0.5 + n / 10) for n in range(200)])
    assert run_daily(spark, to).days_rewritten == 28
    put(raw, "deep/b c.csv", line(3), line(4))
    again = run_daily(spark, to)
    assert again.load.loaded == 1 and again.days_rewritten == 2
    assert again.report.agg(F.sum("total_trips")).first()[0] == 202
    assert not run_daily(spark, to).open_before


def test_daily_run_repeats_a_step_that_failed(spark, at, monkeypatch):
    raw, to = at
    put(raw, "a.csv", *[line(1 + n % 28, 0.5 + n / 10) for n in range(200)])
    with monkeypatch.context() as patch:
        patch.setattr(daily, "train_fares", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_daily(spark, to)
    ledger = read_ledger(spark, to.ledger)
    assert unpublished_batches(ledger).count() == 1
    assert has_new_data(list_files(spark, to.raw), ledger)
    again = run_daily(spark, to)
    assert again.load.loaded == 0 and again.training.quality.n > 0
    assert unpublished_batches(read_ledger(spark, to.ledger)).isEmpty()


def test_compaction_keeps_rows_files_and_report(spark, at):
    raw, to = at
    put(raw, "a.csv", *[line(1 + n % 28, 0.5 + n / 10) for n in range(100)])
    run_daily(spark, to)
    put(raw, "b.csv", *[line(1 + n % 28, 0.7 + n / 10) for n in range(100)])
    before = run_daily(spark, to).report.drop("calculated_at").collect()
    assert compact_lake(spark, to.lake, to.ledger) == []
    assert len(compact_lake(spark, to.lake, to.ledger, fan_in=2)) == 1
    remove_merged(spark, to.lake, to.ledger)
    assert lake_count(spark, to) == 200 and len(list(Path(to.lake).glob("batch_id=*"))) == 1
    again = run_daily(spark, to)
    assert again.load.loaded == 0 and again.report.drop("calculated_at").collect() == before
    assert not run_daily(spark, to).open_before


def put_month(raw, name, rows, days=28):
    put(raw, name, *[line(1 + n % days, 0.5 + n / 10) for n in range(rows)])


def test_compaction_carries_sums(spark, at):
    """A run after the compaction has nothing to do, and the report stays."""
    raw, to = at
    reports = []
    for k in range(3):
        put_month(raw, f"{k}.csv", 40 + k)
        reports.append(run_daily(spark, to).report.drop("calculated_at").collect())
        compact_lake(spark, to.lake, to.ledger, to.sums, fan_in=2)
        remove_merged(spark, to.lake, to.ledger)
        assert not run_daily(spark, to).open_before
    put_month(raw, "last.csv", 5)
    after = run_daily(spark, to).report
    assert lake_count(spark, to) == 40 + 41 + 42 + 5
    assert sum(r.total_trips for r in after.collect()) == 128


def test_large_batches_are_neither_read_nor_written(spark, at):
    raw, to = at
    put_month(raw, "large.csv", 2000)
    load(spark, to)
    large = loaded_batches(read_ledger(spark, to.ledger)).first().batch_id
    for k in range(2):
        put_month(raw, f"small{k}.csv", 3)
        load(spark, to)
    bytes_of = {r.batch_id: r.bytes for r in batch_sizes(read_ledger(spark, to.ledger)).collect()}
    limit = bytes_of[large]
    assert max(v for k, v in bytes_of.items() if k != large) * 4 < limit
    kept = {p: p.stat().st_mtime_ns for p in Path(f"{to.lake}/batch_id={large}").rglob("*")}
    for p in Path(f"{to.lake}/batch_id={large}").rglob("*.parquet"):
        p.chmod(0o000)
        p.write_bytes(b"broken")  # a reader would fail
    made = compact_lake(spark, to.lake, to.ledger, fan_in=2, smallest=limit // 4)
    assert len(made) == 1
    left = {r.batch_id: r.bytes for r in batch_sizes(read_ledger(spark, to.ledger)).collect()}
    assert left == {large: limit, made[0]: sum(v for k, v in bytes_of.items() if k != large)}
    assert set(kept) == set(Path(f"{to.lake}/batch_id={large}").rglob("*"))
    assert compact_lake(spark, to.lake, to.ledger, fan_in=2, smallest=limit * 10, largest=limit) == []


def test_a_merge_that_fills_the_next_tier_takes_it_in(spark, at):
    """Rows that would climb two tiers in a row are written once, and end up in one batch all the same."""
    raw, to = at
    for name, rows in (("a", 20), ("b", 20), ("c", 40)):
        put_month(raw, f"{name}.csv", rows)
        load(spark, to)
    sizes = [r.bytes for r in batch_sizes(read_ledger(spark, to.ledger)).collect()]
    made = compact_lake(spark, to.lake, to.ledger, fan_in=2, smallest=max(sizes))
    assert len(made) == 1 and lake_count(spark, to) == 80
    assert [tuple(r) for r in batch_sizes(read_ledger(spark, to.ledger)).collect()] == [(made[0], sum(sizes), False)]
    assert len(list(Path(to.lake).glob("batch_id=c-*"))) == 1


def test_a_load_alone_reads_the_ledger_once(spark, at, monkeypatch):
    """Whatever the number of batches; another load's entries make it look again."""
    import fareflow.plans.load as job

    raw, to = at
    for n in range(8):
        put(raw, f"{n}.csv", line(1 + n))
    reads = []
    with monkeypatch.context() as patch:
        patch.setattr(job, "read_ledger", lambda *a: reads.append(1) or read_ledger(*a))
        report = load(spark, to, files_per_batch=2)
    assert report.loaded == 8 and report.batches > 1 and len(reads) == 1
    assert lake_count(spark, to) == 8


def test_entries_of_another_load_count_in_every_later_batch(spark, at, monkeypatch):
    """Another run records all that is left after the first batch."""
    import fareflow.plans.load as job

    raw, to = at
    for n in range(8):
        put(raw, f"{n}.csv", line(1 + n))
    files, turns, taken, claimed = list_files(spark, to.raw), [], [], job.claimed

    def after_another(*arguments):
        turns.append(1)
        if len(turns) == 2:
            rest = job.stored_listing(new_files(files, read_ledger(spark, to.ledger)))
            taken.append(rest.count())
            ledger_module.record(to.ledger, rest, "b-other", "loaded", datetime(2024, 1, 1))
        return claimed(*arguments)

    with monkeypatch.context() as patch:
        patch.setattr(job, "claimed", after_another)
        assert load(spark, to, files=files, files_per_batch=2).loaded == 8 - taken[0]
    assert len(turns) > 2 and taken[0] > 0


def test_compressed_raw_files_are_found(spark, at, tmp_path):
    """By the listing, the walk and the stream, without being asked for."""
    from fareflow.sources.listing import walk_folders
    from fareflow.sources.trip_csv import stream_trip_csv

    raw, to = at
    put(raw, "a.csv", line(1))
    (raw / "b.csv.gz").write_bytes(gzip.compress(f"{HEADER}\n{line(2)}\n{line(3)}\n".encode()))
    put(raw, "c.csv.bak", line(4))
    listed, walked = list_files(spark, to.raw), walk_folders(spark, to.raw, str(tmp_path / "index")).files
    for files in (listed, walked):
        assert sorted(r.path.rsplit("/", 1)[1] for r in files.collect()) == ["a.csv", "b.csv.gz"]
    sink = stream_trip_csv(spark, to.raw).writeStream.format("parquet").option("path", str(tmp_path / "out"))
    sink.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    assert load(spark, to).loaded == 2 and lake_count(spark, to) == 3


def test_queries_pack_their_raw_files(spark, tmp_path, sf_dir):
    from fareflow.plans import queries

    queries._write_raw_csv(spark, sf_dir, str(tmp_path / "packed"))
    names = [p for p in (tmp_path / "packed").rglob("part-*")]
    assert names and all(p.name.endswith(".csv.gz") for p in names)
    assert 2 * sum(p.stat().st_size for p in names) < sum(len(gzip.decompress(p.read_bytes())) for p in names)


def test_published_and_unpublished_do_not_mix(spark, at):
    raw, to = at
    put_month(raw, "a.csv", 3)
    run_daily(spark, to)
    put_month(raw, "b.csv", 3)
    load(spark, to)
    assert compact_lake(spark, to.lake, to.ledger, to.sums, fan_in=2) == []


def test_two_loads_at_once_take_every_file_once(spark, at):
    raw, to = at
    for k in range(6):
        put(raw, f"{k}.csv", line(1 + k))
    files = list_files(spark, to.raw)
    shares = [files.where("path NOT LIKE '%/0.csv'"), files.where("path NOT LIKE '%/1.csv'")]
    with ThreadPoolExecutor(2) as pool:
        reports = list(pool.map(lambda share: load(spark, to, files=share, files_per_batch=2), shares))
    assert sum(r.loaded for r in reports) == 6 and lake_count(spark, to) == 6
    loaded = read_ledger(spark, to.ledger).where("status = 'loaded'")
    assert loaded.count() == loaded.select("path").distinct().count() == 6


def test_two_compactions_at_once_count_once(spark, at):
    raw, to = at
    for k in range(4):
        put(raw, f"{k}.csv", line(1 + k))
        load(spark, to)
    with ThreadPoolExecutor(2) as pool:
        made = list(pool.map(lambda _: compact_lake(spark, to.lake, to.ledger), range(2)))
    assert sorted(map(len, made)) == [0, 1] and lake_count(spark, to) == 4


def test_a_load_that_lost_its_claim_records_nothing(spark, at, monkeypatch):
    from fareflow.sources import claims

    raw, to = at
    put(raw, "a.csv", line(1))

    def lost(self):
        raise claims.ClaimLost("gone")

    with monkeypatch.context() as patch:
        patch.setattr(claims.Claim, "check", lost)
        with pytest.raises(claims.ClaimLost):
            load(spark, to)
    assert read_ledger(spark, to.ledger).isEmpty()
    assert load(spark, to).loaded == 1 and lake_count(spark, to) == 1


def test_a_merge_moves_no_row_between_tasks(spark, at, monkeypatch):
    """Batches are gathered by month already; a month stays in few files, and rows are whole in one job or several."""
    import fareflow.plans.compact as job
    import fareflow.sources.lake as lake_module

    raw, to = at
    gathered, whole = [], lake_module._gathered
    monkeypatch.setattr(lake_module, "_gathered", lambda rows: gathered.append(1) or whole(rows))
    for name, rows in (("a", 30), ("b", 20), ("c", 10)):
        put_month(raw, f"{name}.csv", rows)
        put(raw, f"{name}-feb.csv", *[line(3, 0.5).replace("2015-01", "2015-02")] * rows)
        load(spark, to)
    rows = sorted(map(str, read_lake(spark, to.lake, ledger=read_ledger(spark, to.ledger)).drop("processed_at").collect()))
    gathered.clear()
    made = compact_lake(spark, to.lake, to.ledger, fan_in=2)
    assert len(made) == 1 and not gathered
    assert len(list(Path(f"{to.lake}/batch_id={made[0]}").rglob("*.parquet"))) == 2
    after = read_lake(spark, to.lake, ledger=read_ledger(spark, to.ledger)).drop("processed_at")
    assert sorted(map(str, after.collect())) == rows and len(rows) == 120
    put_month(raw, "d.csv", 5)
    load(spark, to)
    monkeypatch.setattr(job, "TASK_BYTES", (1, 1))
    monkeypatch.setattr(job, "MOST_TASKS", 2)
    made = compact_lake(spark, to.lake, to.ledger, fan_in=2)
    assert len(made) == 1 and lake_count(spark, to) == 125
    assert len(list(Path(f"{to.lake}/batch_id={made[0]}").rglob("*.parquet"))) == 3


def test_wrong_headers_do_not_cost_reads_of_the_batch(spark, at, monkeypatch):
    """Files with a wrong header are found by their first lines; the rest is read once."""
    import fareflow.plans.load as job

    raw, to = at
    put_month(raw, "a.csv", 40)
    put(raw, "empty.csv")
    put(raw, "malformed.csv", "x", line(4))
    for name in ("w1.csv", "w2.csv"):
        put(raw, name, line(1))
        (raw / name).write_text((raw / name).read_text().replace("vendorid", "vendor"))
    reads, load_lines = [], job._load_lines
    monkeypatch.setattr(job, "LOOK_FIRST", 0, raising=False)
    monkeypatch.setattr(job, "_load_lines", lambda *a: reads.append(1) or load_lines(*a))
    report = load(spark, to, match_header=True)
    assert (report.loaded, report.failed, report.dropped) == (3, 2, 1) and len(reads) == 1
    assert lake_count(spark, to) == 41
    failed = read_ledger(spark, to.ledger).where("status = 'failed'")
    assert sorted(r.path[-6:] for r in failed.collect()) == ["w1.csv", "w2.csv"]
