"""The registered queries: every operator run over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone
from functools import partial, reduce

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareflow.functions import in_split, round_stable
from fareflow.operators import fares, stats, trips
from fareflow.plans.compact import compact_lake, remove_merged
from fareflow.plans.daily import Folders, run_daily
from fareflow.plans.load import lake_rows, load_new_files, mark_published, stored_listing
from fareflow.plans.report import add_batch_sums, merge_batch_sums, refresh_daily_report, update_report
from fareflow.plans.train import train_fares
from fareflow.schema import BATCH_LAKE_COLUMNS, DAILY_REPORT, DROPOFF, TRIP_COLUMNS
from fareflow.session import scratch_path
from fareflow.sources import lake, ledger
from fareflow.sources.listing import walk_folders
from fareflow.sources.tables import fares_from_tables, trips_from_tables
from fareflow.sources.trip_csv import read_trip_csv, stream_trip_csv
from fareflow.streaming.arrivals import announce, load_arrivals
from fareflow.streaming.feed import follow_ledger, followed_report
from fareflow.streaming.load import stream_to_lake
from fareflow.streaming.stats import (
    append_closed_days,
    finish,
    keep_daily_sums,
    stream_lake,
    streamed_report,
)

Query = Callable[[SparkSession, str], DataFrame]

KEY = ["trip_id"]
RAW_COLUMNS = [line.split()[0] for line in TRIP_COLUMNS.strip().splitlines()]


def load_time() -> Column:
    """A fixed load time, so results can be compared."""
    return F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")


def unzoned(df: DataFrame) -> DataFrame:
    """Timestamps as wall-clock times of the session zone, like the test tables'."""
    zoned = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


# --- statistics -----------------------------------------------------------------


def daily_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unzoned(stats.daily_stats(trips_from_tables(spark, sf_dir), load_time()))


def daily_stats_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unzoned(stats.daily_stats_full(trips_from_tables(spark, sf_dir), load_time()))


def first_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = stats.daily_stats_full(trips_from_tables(spark, sf_dir), load_time())
    return unzoned(stats.first_days(full.select(*DAILY_REPORT)))


def monthly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.monthly_counts(_enriched(spark, sf_dir))


def fare_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.fare_correlation(fares_from_tables(spark, sf_dir))


def dataset_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fares.split_counts(fares_from_tables(spark, sf_dir), KEY)


# --- rows -----------------------------------------------------------------------


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.enrich_trips(trips_from_tables(spark, sf_dir), load_time())


def enrich_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unzoned(_enriched(spark, sf_dir))


def trip_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.with_duration(trips_from_tables(spark, sf_dir)).select("trip_id", "duration_min")


def valid_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = trips.with_duration(trips_from_tables(spark, sf_dir))
    return unzoned(trips.valid_trips(timed))


def normalize_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    shouting = items.toDF(*[name.upper() for name in items.columns])
    return trips.normalize_columns(shouting)


def trip_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = fares.trip_sample(fares_from_tables(spark, sf_dir), KEY)
    return sample.select("trip_id", "trip_distance", "fare_amount")


# --- training rows and model ----------------------------------------------------


def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fares.training_set(fares_from_tables(spark, sf_dir), keep=KEY)


def training_set_fallback_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    without_fare = fares_from_tables(spark, sf_dir).drop("fare_amount")
    return fares.training_set(without_fare, keep=KEY)


def training_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = fares.assemble(training_set(spark, sf_dir))
    values = vector_to_array("features")
    return vectors.select(
        "trip_id",
        "label",
        F.size(values).alias("n_features"),
        values[0].alias("feature_distance"),
        values[1].alias("feature_passengers"),
    )


def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = in_split(KEY, fares.TRAIN_PERCENT)
    return training_set(spark, sf_dir).select(
        "trip_id", F.when(train, "train").otherwise("test").alias("part")
    )


def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the parts of the seeded split relate to the whole: sizes, overlap, share."""
    train, test = fares.random_split(training_set(spark, sf_dir))
    parts = train.withColumn("part", F.lit(1)).unionByName(test.withColumn("part", F.lit(0)))
    each = parts.groupBy("trip_id").agg(F.count(F.lit(1)).alias("n"), F.avg("part").alias("share"))
    near = F.abs(F.avg("share") - fares.TRAIN_PERCENT / 100) < 0.05
    return each.agg(
        F.sum("n").alias("n_rows"), F.count_if(F.col("share") % 1 != 0).alias("n_in_both"), near.alias("share_is_near")
    )


def _fit(spark: SparkSession, sf_dir: str, **overrides) -> tuple[LinearRegressionModel, DataFrame]:
    train, test = fares.stable_split(training_set(spark, sf_dir), KEY)
    return fares.fit_fares(train, **overrides), test


PLAIN = {"regParam": 0.0}


def _described(spark: SparkSession, model: LinearRegressionModel, digits: int) -> DataFrame:
    described = fares.describe_model(spark, model)
    numbers = ("intercept", "per_mile", "per_passenger")
    return described.select(*[round_stable(F.col(n), digits).alias(n) for n in numbers])


def _coefficients(spark: SparkSession, sf_dir: str, digits: int, overrides: dict) -> DataFrame:
    model, _ = _fit(spark, sf_dir, **overrides)
    return _described(spark, model, digits)


fare_model = partial(_coefficients, digits=4, overrides={})


def fare_model_ols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coefficients of the unpenalised fit with its row count and standard errors."""
    model, _ = _fit(spark, sf_dir, **PLAIN)
    errors = fares.fit_errors(model)
    shown = {n: round_stable(F.lit(float(v)), 8) for n, v in errors.items() if n != "n_rows"}
    return _described(spark, model, 6).withColumns(shown | {"n_rows": F.lit(errors["n_rows"]).cast("bigint")})


def _summary(model: DataFrame) -> DataFrame:
    return model.select(
        "formula",
        round_stable(F.col("intercept"), 2).alias("base_fare"),
        round_stable(F.col("per_mile"), 2).alias("per_mile"),
        round_stable(F.col("per_passenger"), 2).alias("per_passenger"),
    )


def model_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, _ = _fit(spark, sf_dir)
    return _summary(fares.describe_model(spark, model))


def model_summary_ols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unpenalised fit in words, with a passenger term from either threshold on."""
    model, _ = _fit(spark, sf_dir, **PLAIN)
    rows = [
        _summary(fares.describe_model(spark, model, effect)).withColumn("min_effect", F.lit(effect))
        for effect in (0.001, 0.01)
    ]
    return rows[0].unionByName(rows[1])


def _rounded(df: DataFrame, *kept: str, digits: int = 4) -> DataFrame:
    return df.select(*kept, round_stable(F.col("prediction"), digits).alias("prediction"))


def _score_trips(spark: SparkSession, sf_dir: str, overrides: dict) -> DataFrame:
    model, test = _fit(spark, sf_dir, **overrides)
    return _rounded(fares.score(test, model), "trip_id", "label", digits=3)


def _model_metrics(spark: SparkSession, sf_dir: str, overrides: dict) -> DataFrame:
    model, test = _fit(spark, sf_dir, **overrides)
    return fares.fit_quality(fares.score(test, model)).select(
        "n", round_stable(F.col("rmse"), 4).alias("rmse"), round_stable(F.col("r2"), 6).alias("r2")
    )


def _score_cases(spark: SparkSession, sf_dir: str, overrides: dict) -> DataFrame:
    model, _ = _fit(spark, sf_dir, **overrides)
    numbers = fares.FEATURES
    examples = fares.example_trips(spark).withColumn("description", F.lit("Example"))
    named = fares.named_trips(spark).withColumns({n: F.col(n).cast("double") for n in numbers})
    cases = named.unionByName(examples)
    return _rounded(fares.score_vectors(cases, model), "description", *numbers, digits=3)


def _fare_curve(spark: SparkSession, sf_dir: str, overrides: dict) -> DataFrame:
    model, _ = _fit(spark, sf_dir, **overrides)
    return _rounded(fares.fare_curve(spark, model), "trip_distance", digits=3)


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, test = _fit(spark, sf_dir, **PLAIN)
    path = scratch_path(spark, "model")
    model.write().overwrite().save(path)
    loaded = LinearRegressionModel.load(path)
    return _rounded(fares.score_vectors(test, loaded), "trip_id", digits=3)


def trained_fares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training job's model and its quality on the test rows, with the rows kept in memory and read anew."""
    rows = fares_from_tables(spark, sf_dir)
    results = []
    for kept in (True, False):
        done = train_fares(rows, scratch_path(spark, "model"), KEY, keep_in_memory=kept, chooser=in_split)
        found = done.summary.asDict() | done.quality.asDict()
        numbers = [float(found[n]) for n in ("intercept", "per_mile", "per_passenger", "rmse", "r2")]
        results.append((kept, found["n"], *numbers))
    layout = "kept boolean, n bigint, intercept double, per_mile double, per_passenger double, rmse double, r2 double"
    table = spark.createDataFrame(results, layout)
    return table.select("kept", "n", *[round_stable(F.col(c), 4).alias(c) for c in table.columns[2:]])


# --- files, lake and streams ----------------------------------------------------


def _raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips with all columns of the raw layout; what the tables lack follows from the rest."""
    miles, vendor = F.col("trip_distance"), F.col("vendorid")
    more = {
        "pickup_longitude": miles - 74,
        "pickup_latitude": miles + 40,
        "ratecodeid": F.col("passenger_count") + 1,
        "store_and_fwd_flag": F.when(vendor == "1", "Y").otherwise("N"),
        "dropoff_longitude": miles * 2 - 74,
        "dropoff_latitude": miles * 2 + 40,
        "payment_type": vendor.cast("int") + 1,
        "extra": F.col("tip_amount") + 1,
        "mta_tax": F.col("fare_amount") * 2,
        "tolls_amount": F.col("total_amount") * 4,
        "improvement_surcharge": F.lit(0.25),
    }
    return trips_from_tables(spark, sf_dir).withColumns(more).select("trip_id", *RAW_COLUMNS)


# Raw files are compressed, as feeds are; at this level that costs no time, and a third of the bytes is left.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def _write_raw_csv(spark: SparkSession, sf_dir: str, root: str, only: Column | None = None) -> None:
    """Raw CSV files with a header, one folder per passenger count; ``only`` some trips, beside what is there."""
    rows = _raw_trips(spark, sf_dir).withColumn("source", F.coalesce("passenger_count", F.lit(-1)))
    rows = rows if only is None else rows.where(only)
    rows.drop("trip_id").write.options(header=True, **PACKED).partitionBy("source").csv(root, mode="append")


def _damaged_lines(rows: DataFrame, *beside: Column) -> DataFrame:
    """Trips as CSV lines, some cut short, some too long, some with a bad value."""
    damage = F.substring_index("trip_id", "-", 1).cast("bigint") % 13
    fields = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in RAW_COLUMNS}
    last = RAW_COLUMNS[-1]
    # concat_ws leaves nulls out, so a null field shortens the line.
    fields[last] = F.when(damage != 1, fields[last])
    fields["one too many"] = F.when(damage == 2, "9")
    for value, name, bad in ((3, "passenger_count", "1.0"), (4, DROPOFF, "notatime")):
        fields[name] = F.when(damage == value, bad).otherwise(fields[name])
    return rows.select(F.concat_ws(",", *fields.values()).alias(",".join(RAW_COLUMNS)), *beside)


def csv_strict_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, parsed = scratch_path(spark, "csv"), scratch_path(spark, "parsed")
    # One column named like the whole header, under a separator no line contains,
    # makes the writer emit header and lines as they are.
    lines = _damaged_lines(_raw_trips(spark, sf_dir))
    lines.write.options(header=True, sep="\u0001", quote="\u0000", emptyValue="").csv(raw)
    read_trip_csv(spark, raw).write.parquet(parsed)
    return unzoned(spark.read.parquet(parsed)).select(*RAW_COLUMNS)


def load_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines dropped by folder of raw files, one of which holds nothing but malformed lines and fails."""
    at = _places(spark)
    order = F.substring_index("trip_id", "-", 1).cast("bigint")
    source = F.when(order % 13 == 2, 5).otherwise(order % 5).alias("source")
    lines = _damaged_lines(_raw_trips(spark, sf_dir), source)
    written = lines.write.options(header=True, sep="\u0001", quote="\u0000", emptyValue="", **PACKED)
    written.partitionBy("source").csv(at.raw)
    load_new_files(spark, at.raw, at.lake, at.ledger, files_per_batch=20, most_malformed=0.9)
    source = F.regexp_extract("path", "source=([0-9]+)", 1).cast("bigint").alias("source")
    return ledger.read_ledger(spark, at.ledger).groupBy(source, "status").agg(F.sum("dropped").alias("dropped"))


def lake_write_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "lake")
    lake.write_lake(_enriched(spark, sf_dir), root)
    return unzoned(lake.read_lake(spark, root))


def load_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of a lake whose load time is the clock's: one time for all rows of a load, between its start and end."""
    root = scratch_path(spark, "lake")
    began = datetime.now(timezone.utc)
    lake.write_lake(lake_rows(trips_from_tables(spark, sf_dir)), root)
    ended = datetime.now(timezone.utc)
    at = F.col("processed_at")
    return lake.read_lake(spark, root).agg(
        F.count(F.lit(1)).alias("trips"),
        (F.min(at) == F.max(at)).alias("one_time"),
        F.bool_and(at.between(F.lit(began), F.lit(ended))).alias("in_time"),
    )


def lake_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "lake")
    lake.write_lake(_enriched(spark, sf_dir), root)
    months = lake.read_lake(spark, root, since=(1996, 11), until=(1999, 3))
    return stats.monthly_counts(months)


def stats_write_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "report")
    return unzoned(refresh_daily_report(trips_from_tables(spark, sf_dir), path, load_time()))


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw folder's listing drawn from the orders: a CSV and a note per customer and year."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    name = F.concat_ws("/", F.lit("raw"), F.year("o_orderdate"), F.col("o_custkey"))
    files = orders.select(name.alias("stem")).distinct()
    kinds = F.explode(F.array(F.lit(".csv"), F.lit(".txt")))
    return files.select("stem", kinds.alias("kind")).select(
        F.concat("stem", "kind").alias("path"), F.length("stem").cast("bigint").alias("length")
    )


def _listing_ledger(listing: DataFrame) -> DataFrame:
    """A ledger over that listing: of every three customers one is loaded, one has failed."""
    customer = F.regexp_extract("path", r"(\d+)\.csv$", 1)
    known = ledger.with_suffix(listing).withColumn("turn", customer.cast("bigint") % 3)
    status = F.when(F.col("turn") == 0, "loaded").otherwise("failed")
    return known.where(F.col("turn") < 2).select("path", status.alias("status"))


def new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = _listing(spark, sf_dir)
    return ledger.new_files(ledger.with_suffix(listing), _listing_ledger(listing))


def absent_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to copy: base names of the newer half that the older half's folder lacks."""
    listing = ledger.with_suffix(_listing(spark, sf_dir)).withColumn("name", ledger.base_name())
    older = F.col("path") < "raw/1998"
    return ledger.absent_files(listing.where(~older), listing.where(older), "name").select(
        "path", "name"
    )


def _places(spark: SparkSession) -> Folders:
    root = scratch_path(spark, "trips")
    return Folders(*[f"{root}/{name}" for name in ("raw", "lake", "ledger", "report", "model")])


def new_data_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many files are found, and the gate before a load, after it and after publishing."""
    at = _places(spark)
    _write_raw_csv(spark, sf_dir, at.raw)
    files = ledger.list_files(spark, at.raw)
    before = ledger.new_files(files, ledger.read_ledger(spark, at.ledger))
    sources = before.select(F.regexp_extract("path", "source=([^/]+)", 1).alias("s")).distinct()
    found = sources.agg(F.count(F.lit(1)).alias("sources_found")).first().sources_found
    gates = {}

    def look(name: str) -> None:
        gates[name] = ledger.has_new_data(files, ledger.read_ledger(spark, at.ledger))

    look("open_before")
    load_new_files(spark, at.raw, at.lake, at.ledger, files=files)
    look("open_after_load")
    fresh = stored_listing(ledger.unpublished_batches(ledger.read_ledger(spark, at.ledger)))
    mark_published(spark, at.ledger, fresh)
    look("open_after_publish")
    left = ledger.new_files(files, ledger.read_ledger(spark, at.ledger))
    return left.agg(
        F.lit(found).cast("bigint").alias("sources_found"),
        *[F.lit(is_open).alias(name) for name, is_open in gates.items()],
        F.count(F.lit(1)).alias("files_left"),
    )


def indexed_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three walks by an index, each with a load of what it finds: over some folders, over those, one of
    them grown, and new ones, and with nothing changed."""
    at, index = _places(spark), scratch_path(spark, "index")
    odd = F.substring_index("trip_id", "-", 1).cast("bigint") % 2 == 1
    first = (F.col("source") < 2) | ((F.col("source") == 2) & odd)
    results = []
    for step, part in enumerate((first, ~first, None), 1):
        if part is not None:
            _write_raw_csv(spark, sf_dir, at.raw, part)
        walk = walk_folders(spark, at.raw, index, settles=timedelta(0))
        whole = ledger.list_files(spark, at.raw)
        unlike = whole.exceptAll(walk.files).unionByName(walk.files.exceptAll(whole)).count()
        load_new_files(spark, at.raw, at.lake, at.ledger, files=walk.files)
        trips = lake.read_lake(spark, at.lake, ledger=ledger.read_ledger(spark, at.ledger)).count()
        results.append((step, walk.folders, walk.listed, unlike, trips))
    return spark.createDataFrame(results, "step bigint, folders bigint, listed bigint, unlike bigint, trips bigint")


def _loaded(spark: SparkSession, sf_dir: str) -> Folders:
    """The raw folder loaded twice, in small batches."""
    at = _places(spark)
    _write_raw_csv(spark, sf_dir, at.raw)
    for _ in range(2):
        load_new_files(spark, at.raw, at.lake, at.ledger, files_per_batch=20)
    return at


def ledger_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lake contents after loading the same raw folder twice, in small batches."""
    at = _loaded(spark, sf_dir)
    rows = lake.read_lake(spark, at.lake, ledger=ledger.read_ledger(spark, at.ledger))
    return unzoned(rows).select(*RAW_COLUMNS, "year", "month")


def _in_rounds(spark: SparkSession, sf_dir: str) -> Folders:
    """Three rounds of loading, reporting and compaction; merged batches go."""
    at = _places(spark)
    _write_raw_csv(spark, sf_dir, at.raw)
    files = ledger.list_files(spark, at.raw)
    for k in range(3):
        part = files.where(F.pmod(F.xxhash64("path"), F.lit(3)) == k)
        load_new_files(spark, at.raw, at.lake, at.ledger, files=part, files_per_batch=15)
        book = ledger.read_ledger(spark, at.ledger)
        fresh = stored_listing(ledger.unpublished_batches(book))
        add_batch_sums(spark, at.lake, book, at.sums)
        mark_published(spark, at.ledger, fresh)
        compact_lake(spark, at.lake, at.ledger, at.sums, fan_in=2)
        remove_merged(spark, at.lake, at.ledger)
    return at


def compacted_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lake contents after three rounds of loading and compaction."""
    at = _in_rounds(spark, sf_dir)
    rows = lake.read_lake(spark, at.lake, ledger=ledger.read_ledger(spark, at.ledger))
    return unzoned(rows).select(*RAW_COLUMNS, "year", "month")


def compacted_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report after those rounds, from sums that compaction carried over."""
    at = _in_rounds(spark, sf_dir)
    return unzoned(merge_batch_sums(spark, ledger.read_ledger(spark, at.ledger), at.sums, at.report, load_time()))


def concurrent_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lake contents after two loads at once, each with a listing of its own, and then two compactions."""
    at = _places(spark)
    _write_raw_csv(spark, sf_dir, at.raw)
    files = ledger.list_files(spark, at.raw)
    shares = [F.pmod(F.xxhash64("path"), F.lit(3)) != k for k in range(2)]

    def load(share: Column) -> None:
        load_new_files(spark, at.raw, at.lake, at.ledger, files=files.where(share), files_per_batch=30)

    def compact(_: Column) -> None:
        compact_lake(spark, at.lake, at.ledger, fan_in=2)

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(load, shares))
        list(pool.map(compact, shares))
    rows = lake.read_lake(spark, at.lake, ledger=ledger.read_ledger(spark, at.ledger))
    return unzoned(rows).select(*RAW_COLUMNS, "year", "month")


def followed_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of a stream over the ledger: before and after a batch that is recorded late,
    after a compaction the stream has not seen, and after the stream has seen it."""
    at, checkpoint = _places(spark), scratch_path(spark, "checkpoint")
    _write_raw_csv(spark, sf_dir, at.raw)
    files = ledger.list_files(spark, at.raw)
    source = F.regexp_extract("path", "source=([^/]+)", 1).cast("int")
    load_new_files(spark, at.raw, at.lake, at.ledger, files=files.where(source <= 2), files_per_batch=20)
    late = stored_listing(files.where(source > 2))
    rows = lake_rows(read_trip_csv(spark, [row.path for row in late.collect()]))
    lake.write_lake(rows, f"{at.lake}/batch_id=b-late", "overwrite")
    reports = []

    def look(step: str, follow: bool = True) -> None:
        if follow:
            follow_ledger(spark, at.lake, at.ledger, at.sums, checkpoint, files_per_trigger=2).awaitTermination()
        path = scratch_path(spark, "followed")
        followed_report(spark, at.ledger, at.sums).drop("calculated_at").write.parquet(path)
        reports.append(spark.read.parquet(path).withColumn("step", F.lit(step)))

    look("first")
    ledger.record(at.ledger, late, "b-late", "loaded", datetime(2024, 1, 1, tzinfo=timezone.utc))
    look("late")
    compact_lake(spark, at.lake, at.ledger, fan_in=2)
    remove_merged(spark, at.lake, at.ledger)
    look("compacted", follow=False)
    look("followed")
    return unzoned(reduce(DataFrame.unionByName, reports))


def dead_batch_hidden(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What batch and stream readers see of a lake in which a dead run left a batch."""
    at = _loaded(spark, sf_dir)
    book = ledger.read_ledger(spark, at.ledger)
    seen = lake.read_lake(spark, at.lake, ledger=book)
    lake.write_lake(seen, f"{at.lake}/batch_id=b-dead", "overwrite")
    again = lake.read_lake(spark, at.lake, ledger=book)
    path = scratch_path(spark, "seen")
    checkpoint = scratch_path(spark, "checkpoint")
    streamed = stream_lake(spark, at.lake, BATCH_LAKE_COLUMNS, ledger=book, checkpoint=checkpoint)
    sink = streamed.writeStream.format("parquet").option("path", path).trigger(availableNow=True)
    sink.option("checkpointLocation", checkpoint).start().awaitTermination()
    shown = [*RAW_COLUMNS, "year", "month"]
    both = [(again, "batch"), (spark.read.parquet(path), "stream")]
    one, two = (unzoned(rows).select(*shown, F.lit(via).alias("via")) for rows, via in both)
    return one.unionByName(two)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lake contents after streaming the same raw folder twice, in several micro-batches."""
    at, checkpoint = _places(spark), scratch_path(spark, "checkpoint")
    _write_raw_csv(spark, sf_dir, at.raw)
    files = ledger.list_files(spark, at.raw).count()
    for _ in range(2):
        stream = stream_trip_csv(spark, at.raw, files_per_trigger=-(-files // 3))
        stream_to_lake(stream, at.lake, at.ledger, checkpoint, load_time()).awaitTermination()
    rows = lake.read_lake(spark, at.lake, ledger=ledger.read_ledger(spark, at.ledger))
    return unzoned(rows).select(*RAW_COLUMNS, "year", "month")


def announced_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lake contents after files came in two parts, were announced, one part twice, and loaded by a stream."""
    at, arrivals, checkpoint = _places(spark), scratch_path(spark, "arrivals"), scratch_path(spark, "checkpoint")
    early = F.col("source") < 3
    for part in (early, ~early):
        _write_raw_csv(spark, sf_dir, at.raw, part)
        files = walk_folders(spark, at.raw, scratch_path(spark, "index")).files
        for _ in range(2 if part is early else 1):
            announce(files, at.ledger, arrivals)
        load_arrivals(spark, arrivals, at.lake, at.ledger, checkpoint).awaitTermination()
    rows = lake.read_lake(spark, at.lake, ledger=ledger.read_ledger(spark, at.ledger))
    return unzoned(rows).select(*RAW_COLUMNS, "year", "month")


def _lake_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int | None) -> DataFrame:
    root = scratch_path(spark, "lake")
    rows = _enriched(spark, sf_dir)
    lake.write_lake(rows, root)
    return stream_lake(spark, root, rows.schema, files_per_trigger=files_per_trigger)


def stream_daily_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily statistics merged from a stream's micro-batches, which come in no order of time."""
    path = scratch_path(spark, "sums")
    stream = _lake_stream(spark, sf_dir, files_per_trigger=25)
    keep_daily_sums(stream, path, scratch_path(spark, "checkpoint")).awaitTermination()
    return unzoned(streamed_report(spark, path).drop("calculated_at"))


def stream_closed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days a watermark has closed; a dropped row would be an error."""
    path = scratch_path(spark, "days")
    stream = _lake_stream(spark, sf_dir, files_per_trigger=None)
    finish(append_closed_days(stream, path, scratch_path(spark, "checkpoint")))
    return unzoned(spark.read.parquet(path).drop("calculated_at"))


def incremental_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report after three loads, each summed by itself and merged."""
    at = _places(spark)
    _write_raw_csv(spark, sf_dir, at.raw)
    files = ledger.list_files(spark, at.raw)
    for k in range(3):
        load_new_files(
            spark, at.raw, at.lake, at.ledger, files=files.where(F.pmod(F.xxhash64("path"), F.lit(3)) == k)
        )
        book = ledger.read_ledger(spark, at.ledger)
        fresh = stored_listing(ledger.unpublished_batches(book))
        add_batch_sums(spark, at.lake, book, at.sums)
        report = merge_batch_sums(spark, book, at.sums, at.report, load_time())
        mark_published(spark, at.ledger, fresh)
    return unzoned(report)


def updated_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report after each of three loads, the even years, the odd ones and some trips of any: how many
    days it has, how many of them were merged anew, and its trips."""
    at = _places(spark)
    order = F.substring_index("trip_id", "-", 1).cast("bigint")
    year = F.coalesce(F.year("tpep_pickup_datetime") % 2, F.lit(0))
    rows = _raw_trips(spark, sf_dir).withColumn("source", F.when(order % 17 == 0, 3).otherwise(year + 1))
    rows.drop("trip_id").write.options(header=True, **PACKED).partitionBy("source").csv(at.raw)
    files = ledger.list_files(spark, at.raw)
    results = []
    for step in (1, 2, 3):
        load_new_files(spark, at.raw, at.lake, at.ledger, files=files.where(F.col("path").contains(f"source={step}/")))
        book = ledger.read_ledger(spark, at.ledger)
        fresh = stored_listing(ledger.unpublished_batches(book))
        add_batch_sums(spark, at.lake, book, at.sums)
        report, rewritten = update_report(spark, at.ledger, at.sums, at.report, fresh)
        mark_published(spark, at.ledger, fresh)
        found = report.agg(F.count(F.lit(1)).alias("days"), F.sum("total_trips").alias("trips")).first()
        results.append((step, found.days, rewritten, found.trips))
    return spark.createDataFrame(results, "step bigint, days bigint, rewritten bigint, trips bigint")


def daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain over raw CSV files, one of which cannot be read, and then once more."""
    at = _places(spark)
    _write_raw_csv(spark, sf_dir, at.raw)
    wrong = spark.range(0, 1, 1, 1).select(*[F.lit("x").alias(c) for c in reversed(RAW_COLUMNS)])
    wrong.write.option("header", True).csv(f"{at.raw}/source=wrong")
    first, second = (run_daily(spark, at, match_header=True, strict=False) for _ in range(2))
    quality = first.training.quality
    return first.report.agg(
        F.count(F.lit(1)).alias("days"),
        F.sum("total_trips").alias("trips"),
        round_stable(F.sum("total_revenue"), 2).alias("revenue"),
        F.lit(first.load.failed).cast("bigint").alias("files_failed"),
        F.lit(first.open_before).alias("open_before"),
        F.lit(first.open_after_load).alias("open_after_load"),
        F.lit(first.open_after_publish).alias("open_after_publish"),
        F.lit(second.report is None and second.load.loaded == 0).alias("second_run_idle"),
        F.lit(quality.n > 0 and quality.rmse > 0).alias("model_tested"),
    )


def queries() -> dict[str, Query]:
    return {
        "daily_stats": daily_stats,
        "daily_stats_full": daily_stats_full,
        "first_days": first_days,
        "monthly_counts": monthly_counts,
        "fare_correlation": fare_correlation,
        "dataset_counts": dataset_counts,
        "enrich_trips": enrich_trips,
        "trip_duration": trip_duration,
        "valid_trips": valid_trips,
        "normalize_columns": normalize_columns,
        "trip_sample": trip_sample,
        "training_set": training_set,
        "training_set_fallback_label": training_set_fallback_label,
        "training_features": training_features,
        "train_test_split": train_test_split,
        "random_split": random_split,
        "fare_model": fare_model,
        "fare_model_ols": fare_model_ols,
        "model_summary": model_summary,
        "model_summary_ols": model_summary_ols,
        "score_trips": partial(_score_trips, overrides={}),
        "score_trips_ols": partial(_score_trips, overrides=PLAIN),
        "model_metrics": partial(_model_metrics, overrides={}),
        "model_metrics_ols": partial(_model_metrics, overrides=PLAIN),
        "score_cases": partial(_score_cases, overrides={}),
        "score_cases_ols": partial(_score_cases, overrides=PLAIN),
        "fare_curve": partial(_fare_curve, overrides={}),
        "fare_curve_ols": partial(_fare_curve, overrides=PLAIN),
        "model_roundtrip": model_roundtrip,
        "csv_strict_scan": csv_strict_scan,
        "load_account": load_account,
        "load_clock": load_clock,
        "trained_fares": trained_fares,
        "lake_scan": lake_scan,
        "lake_write_roundtrip": lake_write_roundtrip,
        "stats_write_roundtrip": stats_write_roundtrip,
        "new_files": new_files,
        "absent_files": absent_files,
        "new_data_gate": new_data_gate,
        "indexed_listing": indexed_listing,
        "ledger_append": ledger_append,
        "stream_ingest": stream_ingest,
        "announced_stream": announced_stream,
        "stream_daily_stats": stream_daily_stats,
        "stream_closed_days": stream_closed_days,
        "compacted_lake": compacted_lake,
        "compacted_report": compacted_report,
        "concurrent_loads": concurrent_loads,
        "followed_ledger": followed_ledger,
        "dead_batch_hidden": dead_batch_hidden,
        "incremental_report": incremental_report,
        "updated_report": updated_report,
        "daily_run": daily_run,
    }
