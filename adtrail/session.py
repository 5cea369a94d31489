"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

STATE_PARTITIONS = "spark.adtrail.statePartitions"
BATCH_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}
# State on RocksDB can outgrow executor memory; changelog checkpoints upload
# the changes of a batch and not the whole state. Version 3 of the state of joins has one
# store per join and task in place of four; streams that began before keep theirs. A count of
# all rows of a state would need a lookup before each of its writes; progress says 0 instead.
STREAM_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.join.stateFormatVersion": "3",
}
ICEBERG_CONF = {
    "spark.sql.extensions": "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions",
    "spark.sql.catalog.local": "org.apache.iceberg.spark.SparkCatalog",
    "spark.sql.catalog.local.type": "hadoop",
}


def session(
    app_name: str = "adtrail",
    iceberg_warehouse: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build or fetch a session. Master and memory belong to the deployment.

    ``iceberg_warehouse`` turns on the Iceberg catalog, whose runtime jar must
    be on the class path.
    """
    settings = {**BATCH_CONF, **STREAM_CONF}
    if iceberg_warehouse is not None:
        settings |= ICEBERG_CONF
        settings["spark.sql.catalog.local.warehouse"] = iceberg_warehouse
    settings |= conf or {}
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Apply runtime settings and put the old ones back.

    A streaming query copies its session when it starts, so the settings only
    have to hold around ``start()``.
    """
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def state_partitions(spark: SparkSession) -> int:
    """Width of stateful operators, fixed in a checkpoint at the first start.

    ``spark.adtrail.statePartitions`` if it is set, else the session's shuffle
    width. The cores at the start say nothing: with dynamic allocation a cluster
    begins with few. Each partition is one state store per operator, opened in
    every micro-batch, so a small stream wants few.
    """
    width = spark.conf.get(STATE_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions")
    return max(1, int(width))


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared checkpoint folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return f"{shared.rstrip('/')}/adtrail/{name}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return os.path.join(tempfile.mkdtemp(prefix="adtrail-"), name)
