"""Strict trip CSV, as a batch or as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.schema import TRIP_COLUMNS
from fareflow.sources.ledger import RAW_SUFFIXES, name_pattern

# Holds a line that does not fit the layout, as it stands in the file.
MALFORMED = "malformed_line"


def _strict(match_header: bool) -> dict[str, str]:
    return {
        "header": "true",
        "mode": "DROPMALFORMED",
        "enforceSchema": str(not match_header).lower(),
    }


def read_trip_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: str = TRIP_COLUMNS,
    match_header: bool = False,
) -> DataFrame:
    """Rows of the files that fit the schema; an empty field is null.

    Columns bind by position and the header's names are skipped; ``match_header``
    makes a header in another order fail the read.

    Spark parses only the columns a plan uses, so a line with a bad value in an
    unused column passes. Write all columns first, then count.
    """
    paths = paths if isinstance(paths, str) else list(paths)
    return spark.read.schema(schema).options(**_strict(match_header)).csv(paths)


def read_marked_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: str = TRIP_COLUMNS,
    match_header: bool = False,
) -> DataFrame:
    """All lines of the files; ``malformed_line`` is null where ``read_trip_csv`` would keep the row."""
    paths = paths if isinstance(paths, str) else list(paths)
    options = _strict(match_header) | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    return spark.read.schema(f"{schema}, {MALFORMED} STRING").options(**options).csv(paths)


def check_headers(spark: SparkSession, paths: Sequence[str], schema: str = TRIP_COLUMNS) -> None:
    """Fail as a read with ``match_header`` would, with the first line or two of every file.

    Each file gets a task that ends with its first row. A session of its own sets that without
    touching this one's settings.
    """
    reader = spark.newSession()
    reader.conf.set("spark.sql.files.openCostInBytes", reader.conf.get("spark.sql.files.maxPartitionBytes"))
    lines = read_marked_csv(reader, paths, schema, match_header=True)
    # Spark checks the names of the columns that a plan uses.
    used = [c for c in lines.columns if c != MALFORMED]
    lines.limit(1).agg(F.bit_xor(F.xxhash64(*used))).collect()


def line_counts(marked: DataFrame) -> DataFrame:
    """``file``, ``lines``, ``malformed`` and a ``checksum`` of every file of ``read_marked_csv`` that has lines."""
    fields = [c for c in marked.columns if c != MALFORMED]
    # Spark parses only what a plan uses, so a checksum of all columns stays among the counts.
    return marked.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count(MALFORMED).alias("malformed"),
        F.bit_xor(F.xxhash64(*fields)).alias("checksum"),
    )


def stream_trip_csv(
    spark: SparkSession,
    root: str,
    schema: str = TRIP_COLUMNS,
    files_per_trigger: int | None = 10_000,
    match_header: bool = False,
) -> DataFrame:
    """The same rows as an incremental stream over every ``*.csv`` or ``*.csv.gz`` below ``root``.

    ``maxFileAge`` is raised from its default of a week, past which Spark would skip
    a late file that is older than the newest one seen.
    """
    reader = (
        spark.readStream.schema(schema)
        .options(**_strict(match_header))
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", name_pattern(RAW_SUFFIXES))
        .option("maxFileAge", "36500d")
    )
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.csv(root)
