"""Load new CSV files into the lake, each exactly once."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from datetime import datetime, timezone
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fareflow.operators.trips import enrich_trips, normalize_columns
from fareflow.session import MIB, scratch_path
from fareflow.sources.claims import Claim, claimed
from fareflow.sources.lake import stored_bytes, write_lake
from fareflow.sources.ledger import append, ledger_files, list_files, new_files, read_ledger, record
from fareflow.sources.trip_csv import MALFORMED, check_headers, line_counts, read_marked_csv

# What Spark says when the data of a file, rather than the job, is at fault.
_FILE_ERRORS = ("FAILED_READ_FILE", "PATH_NOT_FOUND")
# Mean length from which on a header is looked at before the file is read: what Spark says opening a file costs.
LOOK_FIRST = 4 * MIB


class LoadError(RuntimeError):
    """Some files could not be read; all others are loaded and recorded."""


@dataclass
class LoadReport:
    """Counts; which files failed and why is in the ledger, beside the first of them here.

    ``dropped`` are the malformed lines of loaded files; the ledger has them by file.
    """

    loaded: int = 0
    batches: int = 0
    failed: int = 0
    dropped: int = 0
    first_failed: str | None = None

    def check(self) -> None:
        if self.failed:
            raise LoadError(f"{self.failed} file(s) failed, first: {self.first_failed}")


def load_new_files(
    spark: SparkSession,
    raw_root: str,
    lake_root: str,
    ledger_root: str,
    loaded_at: datetime | None = None,
    files_per_batch: int = 10_000,
    match_header: bool = False,
    files: DataFrame | None = None,
    most_malformed: float = 1.0,
) -> LoadReport:
    """Load every file below ``raw_root`` the ledger does not hold as loaded.

    Files go in batches of about ``files_per_batch``, dealt by a hash of their path, and each
    batch is one Spark read and one write to a folder of its own, ``batch_id=...``. Its
    ledger rows follow in one file; only then do readers see it. A run that dies in
    between leaves a folder nobody reads, and the next run loads those files anew. The
    batch's name follows from its files, so a run that is repeated writes the same folder.

    A batch is loaded under a claim on the ledger, and what the ledger holds by then is left
    out of it. So runs at the same time, whatever each of them has listed, take turns by batch
    and load every file once. The ledger is read for that only if it holds files this run has neither
    seen at its start nor written.

    An unreadable file is recorded as failed and its batch tried again without it. With ``match_header``
    the headers of a batch of large files are looked at first, so a wrong one does not cost a read of
    the batch. A file of which more than the share ``most_malformed`` of all lines does not fit the
    layout is recorded as failed as well.
    Such lines of other files are left out, and their number is recorded with the file. The write counts
    them as it goes; only a batch that has some is read once more, to tell the files apart. Call
    ``check()`` on the report to raise for failed files. ``files`` may hold the listing.
    """
    loaded_at = loaded_at or datetime.now(timezone.utc)
    files = list_files(spark, raw_root) if files is None else files
    known = ledger_files(spark, ledger_root)
    pending = stored_listing(new_files(files, read_ledger(spark, ledger_root)))
    count = -(-pending.count() // files_per_batch)
    report = LoadReport()
    for k in range(count):
        part = pending.where(F.pmod(F.xxhash64("path"), F.lit(count)) == k)
        with claimed(spark, ledger_root, "load") as claim:
            found = ledger_files(spark, ledger_root)
            if not found <= known:
                part = new_files(part, read_ledger(spark, ledger_root))
            paths = [row.path for row in part.select("path").collect()]
            _load_batch(part, paths, lake_root, ledger_root, loaded_at, match_header, report, claim, most_malformed)
            known |= ledger_files(spark, ledger_root) - found
    return report


def stored_listing(files: DataFrame) -> DataFrame:
    """A listing that stays as it is while the ledger grows."""
    path = scratch_path(files.sparkSession, "pending")
    files.write.parquet(path)
    return files.sparkSession.read.schema(files.schema).parquet(path)


def mark_published(
    spark: SparkSession, ledger_root: str, batches: DataFrame, at: datetime | None = None
) -> None:
    """Record that the downstream jobs have covered these batches."""
    rows = batches.select("batch_id").withColumns(
        {
            "status": F.lit("published"),
            "recorded_at": F.lit(at or datetime.now(timezone.utc)),
        }
    )
    append(spark, ledger_root, rows)


def lake_rows(raw: DataFrame, loaded_at: datetime | None = None) -> DataFrame:
    """Raw trips as the lake stores them."""
    return enrich_trips(normalize_columns(raw), loaded_at)


def _literal(path: str) -> str:
    """The path with its wildcard characters taken as they are."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _file_error(error: Exception) -> str | None:
    """The line of an error that blames a file, if there is one."""
    lines = str(error).splitlines()
    return next((line for line in lines if any(mark in line for mark in _FILE_ERRORS)), None)


def _batch_id(paths: list[str]) -> str:
    """A name that follows from the files."""
    return f"b-{hashlib.md5(chr(10).join(sorted(paths)).encode()).hexdigest()}"


def _load_batch(
    files: DataFrame,
    paths: list[str],
    lake_root: str,
    ledger_root: str,
    loaded_at: datetime,
    match_header: bool,
    report: LoadReport,
    claim: Claim,
    most_malformed: float,
) -> None:
    """Load the files named by ``paths``, a bounded number, setting unreadable ones apart."""
    while paths:
        batch_id = _batch_id(paths)
        literal = [_literal(p) for p in paths]
        try:
            if match_header and _mean_length(files) >= LOOK_FIRST:
                check_headers(files.sparkSession, literal)
            raw = read_marked_csv(files.sparkSession, literal, match_header=match_header)
            dropped, too_many = _load_lines(raw, f"{lake_root}/batch_id={batch_id}", loaded_at, paths, most_malformed)
        except (Py4JJavaError, PySparkException) as error:
            reason = _file_error(error)
            if reason is None:
                raise
            bad = paths[0] if len(paths) == 1 else _named_in(reason, paths)
            if bad is None:
                middle = len(paths) // 2
                for part in (paths[:middle], paths[middle:]):
                    of_part = files.where(F.col("path").isin(part))
                    _load_batch(
                        of_part, part, lake_root, ledger_root, loaded_at, match_header, report, claim, most_malformed
                    )
                return
            apart, dropped = [bad], {}
        else:
            apart, reason = too_many, f"more than {most_malformed:.2%} of the lines are malformed"
        claim.check()
        if not apart:
            record(ledger_root, _with_dropped(files, dropped), batch_id, "loaded", loaded_at)
            report.loaded += len(paths)
            report.batches += 1
            report.dropped += sum(dropped.values())
            return
        failed = files.where(F.col("path").isin(apart))
        if dropped:
            failed = _with_dropped(failed, dropped)
        record(ledger_root, failed, batch_id, "failed", loaded_at, reason)
        report.failed += len(apart)
        report.first_failed = report.first_failed or min(apart)
        paths = [p for p in paths if p not in set(apart)]
        files = files.where(~F.col("path").isin(apart))


def _mean_length(files: DataFrame) -> float:
    """In bytes, as listed; 0 if the listing says nothing about it."""
    return (files.agg(F.avg("length")).first()[0] or 0.0) if "length" in files.columns else 0.0


def _load_lines(
    raw: DataFrame, folder: str, loaded_at: datetime, paths: list[str], most_malformed: float
) -> tuple[dict[str, int], list[str]]:
    """Write the lines that fit. Returns how many do not, by file that has such, and the files with too many."""
    seen = Observation()
    fitting = raw.observe(seen, F.count(MALFORMED).alias("malformed")).where(F.col(MALFORMED).isNull()).drop(MALFORMED)
    write_lake(lake_rows(fitting, loaded_at), folder, "overwrite")
    # Where nothing was written, Spark may have dropped the counting along with the empty plan.
    if stored_bytes(raw.sparkSession, folder) and not seen.get["malformed"]:
        return {}, []
    # Spark names a file read percent-encoded, a listed one as it is.
    named = {_one_slash(p): p for p in paths}
    found = [r for r in line_counts(raw).collect() if r.malformed]
    counts = [(named[_one_slash(unquote(r.file))], r.lines, r.malformed) for r in found]
    dropped = {path: malformed for path, _, malformed in counts}
    return dropped, [path for path, lines, malformed in counts if malformed > most_malformed * lines]


def _with_dropped(files: DataFrame, dropped: dict[str, int]) -> DataFrame:
    """The files with their number of dropped lines."""
    if not dropped:
        return files.withColumn("dropped", F.lit(0).cast("long"))
    counts = files.sparkSession.createDataFrame(list(dropped.items()), "path string, dropped long")
    return files.join(counts, "path", "left").fillna(0, ["dropped"])


def _named_in(reason: str, paths: list[str]) -> str | None:
    """The path an error line names; the longest, should one be the start of another."""
    said = _decoded(reason)
    return max((p for p in paths if _decoded(p) in said), key=len, default=None)


def _one_slash(text: str) -> str:
    return re.sub(r"(\w:)/+", r"\1/", text)


def _decoded(text: str) -> str:
    return unquote(_one_slash(text))
