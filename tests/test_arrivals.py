"""The stream over announcements loads each file once and remembers announcements only."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fareflow.plans.load import load_new_files
from fareflow.sources.lake import read_lake
from fareflow.sources.ledger import list_files, read_ledger
from fareflow.streaming.arrivals import announce, load_arrivals
from tests.test_load import HEADER, line, put


class Places:
    def __init__(self, spark, root):
        self.spark, self.raw = spark, root / "raw"
        self.raw.mkdir()
        self.lake, self.ledger, self.arrivals, self.checkpoint = (
            str(root / name) for name in ("lake", "ledger", "arrivals", "checkpoint")
        )

    def announce(self):
        return announce(list_files(self.spark, str(self.raw)), self.ledger, self.arrivals)

    def load(self, **options):
        reports = []
        query = load_arrivals(
            self.spark, self.arrivals, self.lake, self.ledger, self.checkpoint, seen=reports.append, **options
        )
        query.awaitTermination()
        return reports

    def trips(self):
        return read_lake(self.spark, self.lake, ledger=read_ledger(self.spark, self.ledger)).count()


@pytest.fixture
def at(spark, tmp_path):
    return Places(spark, tmp_path)


def test_memory_grows_with_announcements_not_files(at):
    for k in range(4):
        for n in range(10):
            put(at.raw, f"{k}/{n}.csv", line(1 + n))
        assert at.announce() == 10
        assert [r.loaded for r in at.load()] == [10]
    assert at.trips() == 40 and at.announce() == 0 and at.load() == []
    log = [p for p in Path(at.checkpoint, "sources", "0").iterdir() if not p.name.startswith(".")]
    entries = [text for p in log for text in p.read_text().splitlines()[1:]]
    assert len(entries) == 4 and not any(".csv" in text for text in entries)
    assert len(list(Path(at.arrivals).glob("*.parquet"))) <= 1  # the newest may stay


def test_announced_twice_and_loaded_by_another(at, spark):
    put(at.raw, "a.csv", line(1))
    put(at.raw, "b.csv", line(2))
    assert at.announce() == 2 and at.announce() == 2
    load_new_files(
        spark, str(at.raw), at.lake, at.ledger,
        files=list_files(spark, str(at.raw)).where(F.col("path").endswith("a.csv")),
    )
    assert [r.loaded for r in at.load()] == [1, 0]
    assert at.trips() == 2


def test_failed_file_is_announced_again(at):
    put(at.raw, "a.csv", line(1))
    bad = at.raw / "b.csv"
    bad.write_text(",".join(reversed(HEADER.split(","))) + "\n" + line(2) + "\n")
    assert at.announce() == 2
    (report,) = at.load(match_header=True)
    assert (report.loaded, report.failed) == (1, 1) and at.trips() == 1
    put(at.raw, "b.csv", line(2))
    assert at.announce() == 1
    assert [r.loaded for r in at.load(match_header=True)] == [1] and at.trips() == 2


def test_malformed_lines_are_counted(at, spark):
    put(at.raw, "a.csv", line(1), "too,short", line(2) + ",too long")
    at.announce()
    assert [r.dropped for r in at.load()] == [2]
    assert [r.dropped for r in read_ledger(spark, at.ledger).collect()] == [2] and at.trips() == 1


def test_nothing_announced(at):
    assert at.announce() == 0 and at.load() == []
