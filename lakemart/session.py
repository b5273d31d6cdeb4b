"""Session settings the jobs rely on, and the shared folder for scratch tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Keys that are looked up by value go to the scan as a list of so many at most, each of them tried on
# the statistics and Bloom filters of row groups; more keys are a join.
MOST_LISTED = 256

# The adaptive settings are Spark's defaults, named because the joins count on them to split
# a partition that one key has made too large. Partition values are strings: without type
# inference a table is listed once, not twice.
JOB_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.parquet.filterPushdown.inFilterThreshold": str(MOST_LISTED),
}
# A side of a join is broadcast by its size as measured in a shuffle. The size of its files, which the
# first of these goes by, says nothing: Parquet files of a few MB may hold millions of keys, and all of
# them would go through the driver.
BY_FILES = "spark.sql.autoBroadcastJoinThreshold"
AS_MEASURED = "spark.sql.adaptive.autoBroadcastJoinThreshold"


@contextmanager
def job_settings(spark: SparkSession) -> Iterator[None]:
    """The settings of a job while it runs; the session gets its own back afterwards."""
    settings = JOB_SETTINGS | {AS_MEASURED: spark.conf.get(AS_MEASURED, None) or spark.conf.get(BY_FILES), BY_FILES: "-1"}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see; a local temporary one only on a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.gettempdir()
    raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below one folder per application, which goes when the session's process ends."""
    root = f"{shared_dir(spark)}/lakemart-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    file_system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    file_system.mkdirs(path)
    file_system.deleteOnExit(path)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"
