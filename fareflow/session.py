"""Session settings handed to the caller, and the shared scratch folder.

Nothing here creates a session. The functions return plain dicts of settings so
they can go into ``spark-submit --conf`` or ``SparkSession.builder.config(map=...)``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

MIB = 1024 * 1024

# Days and months are cut in UTC. Parquet times are INT64, which carry statistics.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings the library counts on to a running session."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting that holds for the block only."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def object_store_conf(
    endpoint: str,
    access_key: str | None = None,
    secret_key: str | None = None,
    path_style: bool = True,
) -> dict[str, str]:
    """Settings for an S3-compatible store reached through the S3A connector.

    TLS follows the endpoint's scheme. Leave the keys out to use the cluster's
    own credential chain.
    """
    conf = {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(
            not endpoint.startswith("http://")
        ).lower(),
    }
    if access_key is not None and secret_key is not None:
        conf["spark.hadoop.fs.s3a.access.key"] = access_key
        conf["spark.hadoop.fs.s3a.secret.key"] = secret_key
    return conf


def scale_conf(shuffle_bytes: int, partition_bytes: int = 128 * MIB) -> dict[str, str]:
    """Settings for a job whose widest shuffle moves about ``shuffle_bytes``.

    AQE starts from enough partitions for each to fit in memory and merges the
    ones that turn out small, so an over-estimate costs little.
    """
    start = max(-(-shuffle_bytes // partition_bytes), 1)
    return {
        **SESSION_CONF,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(start),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }


def scratch_root(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``, else below the warehouse.

    The driver and all executors must share it. A warehouse on this machine's own disk, Spark's
    default, is shared in local mode only; on a cluster that is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", "")
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir")
        if _is_local_disk(spark, shared) and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{shared.rstrip('/')}/fareflow/{spark.sparkContext.applicationId}"


def _is_local_disk(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getScheme() == "file"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below ``scratch_root``."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application left in its scratch folder, through Spark's file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
