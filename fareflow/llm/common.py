"""What the operators of this folder share: tables, written intermediates, Arrow batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareflow.session import scratch_path, setting

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Rows handed to Python at once. Texts vary from one word to megabytes, so few rows.
ROWS_PER_BATCH = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))


def free_name(df: DataFrame, name: str) -> str:
    """``name`` with underscores before it until no column begins with it, in whatever case."""
    taken = [c.lower() for c in df.columns]
    while any(c.startswith(name.lower()) for c in taken):
        name = f"_{name}"
    return name


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    Its lineage ends there: nothing is computed twice, and a lost executor costs a read.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` written in ascending ``order`` (nulls first) with ``at``, each row's place from 0.

    Rows are dealt by ranges of the order, so no group of equal values is one task: where the
    order leaves rows equal, the place they were read from parts them. Only the row count of
    each range is added up in one place.
    """
    spread = df.withColumn("_read", F.monotonically_increasing_id())
    keys = [*order, "_read"]
    ranges = spread.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_read")
    # The upper bits are the range, the lower 33 the place in it.
    rows = stored(ranges.withColumn("_slot", F.monotonically_increasing_id()), name)
    rows = rows.withColumn("_range", F.shiftright("_slot", 33))
    counts = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_start"))
    place = F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_start")
    return rows.join(starts, "_range").withColumn("at", place).drop("_range", "_start", "_slot")


def crc32_of(key: Column) -> Column:
    """The unsigned CRC-32 of an integer's decimal digits; null for null."""
    return F.crc32(key.cast("string").cast("binary"))
