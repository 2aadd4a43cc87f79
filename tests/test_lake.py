"""Layout and plans: what is pruned, pushed down, split and kept off the driver."""

from contextlib import contextmanager
from datetime import datetime
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fareflow.operators import fares
from fareflow.operators.stats import daily_stats, daily_stats_full, monthly_counts
from fareflow.operators.trips import enrich_trips
from fareflow.plans.report import refresh_daily_report
from fareflow.schema import DAILY_REPORT
from fareflow.session import object_store_conf, scale_conf, scratch_path, scratch_root
from fareflow.sources.lake import read_lake, read_report, write_lake
from fareflow.sources.tables import trips_from_tables
from tests.helpers import plan_of


@contextmanager
def conf(spark, **settings):
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def settings(spark, **pairs):
    return conf(spark, **{"spark.sql." + k.replace("__", "."): v for k, v in pairs.items()})


def files(root):
    return sorted(Path(root).rglob("*.parquet"))


@pytest.fixture(scope="module")
def trips(spark, sf_dir):
    return trips_from_tables(spark, sf_dir)


@pytest.fixture(scope="module")
def root(spark, trips, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake") / "l")
    write_lake(enrich_trips(trips, datetime(2024, 1, 1)), root)
    return root


def test_partition_columns_come_back_as_int(spark, root):
    kinds = dict(read_lake(spark, root).dtypes)
    assert (kinds["year"], kinds["month"]) == ("int", "int")


def test_month_range_prunes_partitions(spark, root):
    some = read_lake(spark, root, since=(1996, 11), until=(1997, 2))
    assert "PartitionFilters: [(" in plan_of(some) and "year" in plan_of(some)
    got = [tuple(r)[:2] for r in monthly_counts(some).collect()]
    assert got == [(1996, 11), (1996, 12), (1997, 1), (1997, 2)]


def test_monthly_counts_read_no_data_column(spark, root):
    assert "ReadSchema: struct<>" in plan_of(monthly_counts(read_lake(spark, root)))


def test_report_reads_and_tests_only_what_it_needs(spark, root):
    plan = plan_of(daily_stats_full(read_lake(spark, root)))
    assert "GreaterThan(trip_distance,0.0)" in plan and "GreaterThan(total_amount,0.0)" in plan
    schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "passenger_count" not in schema and "vendorid" not in schema
    assert plan.count("Exchange") == 1 and "partial_sum" in plan


def test_training_filters_reach_the_scan(spark, root):
    train, _ = fares.stable_split(fares.training_set(read_lake(spark, root), ["trip_id"]), ["trip_id"])
    plan = plan_of(train)
    assert "LessThanOrEqual(trip_distance,100.0)" in plan and "LessThan(fare_amount,200.0)" in plan
    assert "Exchange" not in plan and "Python" not in plan


def test_first_rows_are_a_top_k(spark, root):
    plan = plan_of(daily_stats(read_lake(spark, root)).limit(3))
    assert "TakeOrderedAndProject" in plan


def test_pickup_times_carry_statistics(root):
    meta = pq.ParquetFile(files(root)[0]).metadata
    column = [meta.row_group(0).column(i) for i in range(meta.num_columns)]
    pickup = next(c for c in column if c.path_in_schema == "tpep_pickup_datetime")
    assert pickup.physical_type == "INT64" and pickup.statistics.has_min_max


def test_hot_month_is_written_by_several_tasks(spark, tmp_path):
    """One month holds nearly all rows; it must not end up in one task."""
    rows = spark.range(0, 400_000, numPartitions=8).select(
        F.when(F.col("id") % 50 == 0, 2).otherwise(1).alias("month"),
        F.lit(2020).alias("year"),
        F.uuid().alias("payload"),
    )
    with settings(
        spark,
        adaptive__advisoryPartitionSizeInBytes="2MB",
        adaptive__coalescePartitions__minPartitionSize="1MB",
    ):
        write_lake(rows, str(tmp_path / "l"), sort_by=None)
    hot = files(tmp_path / "l/year=2020/month=1")
    assert len(hot) >= 4
    assert spark.read.parquet(str(tmp_path / "l")).count() == 400_000


def test_hot_month_is_spread_without_adaptive_execution(spark, tmp_path):
    rows = spark.range(10_000).select(
        F.lit(2020).alias("year"), F.lit(1).alias("month"), F.col("id").alias("payload")
    )
    with settings(spark, adaptive__enabled="false", shuffle__partitions="8"):
        write_lake(rows, str(tmp_path / "l"), sort_by=None)
    assert len(files(tmp_path / "l")) > 2
    assert spark.read.parquet(str(tmp_path / "l")).distinct().count() == 10_000


def test_small_months_share_tasks_and_get_one_file_each(spark, root):
    months = {f.parent for f in files(root)}
    assert len(files(root)) == len(months)


def test_file_size_limit(spark, trips, tmp_path):
    write_lake(enrich_trips(trips).where("year = 1996"), str(tmp_path / "l"), rows_per_file=20)
    assert all(pq.ParquetFile(f).metadata.num_rows <= 20 for f in files(tmp_path / "l"))


@pytest.mark.parametrize("one_file", [True, False])
def test_refreshed_report_is_sorted_and_replaces_the_last(spark, trips, tmp_path, one_file):
    path = str(tmp_path / "report")
    for _ in range(2):
        report = refresh_daily_report(trips, path, one_file=one_file)
    assert len(list(Path(path).glob("version=*"))) == 1
    days = [d for f in files(path) for d in pq.read_table(f).column("date").to_pylist()]
    assert days == sorted(days) and len(days) == daily_stats(trips).count()
    assert report.columns == list(DAILY_REPORT) and (len(files(path)) == 1 or not one_file)


def test_report_that_died_on_the_way_leaves_the_last(spark, trips, tmp_path):
    path = str(tmp_path / "report")
    want = refresh_daily_report(trips, path).count()
    (tmp_path / "report" / "version=99999999999999999999-dead").mkdir()
    assert read_report(spark, path).count() == want
    with pytest.raises(FileNotFoundError):
        read_report(spark, str(tmp_path / "none"))


def test_single_file_report_keeps_the_aggregation_parallel(spark, trips):
    plan = plan_of(daily_stats_full(trips).repartition(1))
    assert "SinglePartition" in plan and "hashpartitioning" in plan
    assert "rangepartitioning" not in plan


def test_hot_order_is_split_in_the_join(spark, tmp_path):
    """An order with most line items: AQE must cut its partition, not feed one task."""
    item = spark.range(0, 300_000, numPartitions=8).select(
        F.when(F.col("id") % 3 != 0, 7).otherwise(F.col("id")).alias("l_orderkey"),
        F.col("id").alias("l_partkey"),
        F.lit(1).cast("bigint").alias("l_suppkey"),
        (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"),
        F.lit(20.0).alias("l_quantity"),
        F.lit(1.0).alias("l_extendedprice"),
        F.lit(0.1).alias("l_discount"),
        F.lit(0.1).alias("l_tax"),
        F.lit("A").alias("l_returnflag"),
        F.lit("O").alias("l_linestatus"),
    )
    item.write.parquet(str(tmp_path / "lineitem.parquet"))
    order = spark.range(300_000).select(
        F.col("id").alias("o_orderkey"),
        F.expr("timestamp_ntz'1996-01-01' + make_interval(0, 0, 0, int(id % 900))").alias("o_orderdate"),
    )
    order.write.parquet(str(tmp_path / "orders.parquet"))
    with settings(
        spark,
        autoBroadcastJoinThreshold="-1",
        shuffle__partitions="8",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__advisoryPartitionSizeInBytes="256KB",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="512KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
    ):
        stats = daily_stats_full(trips_from_tables(spark, str(tmp_path)))
        assert sum(r.total_trips for r in stats.collect()) > 290_000
        assert "SortMergeJoin(skew=true)" in plan_of(stats)


def test_object_store_conf():
    plain = object_store_conf("http://store:9000", "k", "s")
    assert plain["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert plain["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert plain["spark.hadoop.fs.s3a.secret.key"] == "s"
    secure = object_store_conf("https://store", path_style=False)
    assert secure["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true"
    assert "spark.hadoop.fs.s3a.access.key" not in secure


def test_scale_conf_grows_with_the_shuffle():
    start = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert scale_conf(1)[start] == "1"
    assert int(scale_conf(10**17)[start]) > 100_000
    assert int(scale_conf(4 * 10**12)[start]) > 20_000


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", "")
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != two and one.startswith(shared)


def test_scratch_on_a_machines_own_disk_is_refused_on_a_cluster(spark, monkeypatch):
    shared = scratch_root(spark)
    monkeypatch.setattr(spark.sparkContext, "master", "yarn")
    assert scratch_root(spark) == shared
    plain = type(spark.conf).get
    without = lambda self, key, *rest: "" if key == "spark.checkpoint.dir" else plain(self, key, *rest)
    monkeypatch.setattr(type(spark.conf), "get", without)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(spark)
    monkeypatch.setattr(spark.sparkContext, "master", "local[4]")
    assert scratch_root(spark)
