"""Date-partitioned Parquet tables: scan, first write, and file-level helpers."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.schemas import DATE_PARTITIONS
from lakemart.session import scratch_path

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def file_system(spark: SparkSession, path: str):
    """Hadoop file system and path object, for whatever scheme the path has."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = file_system(spark, path)
    return fs.exists(hadoop_path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """A folder without the success marker is a write that never finished."""
    return exists(spark, f"{path}/_SUCCESS")


def read_table(
    spark: SparkSession, path: str, partitions: Sequence[str] = DATE_PARTITIONS
) -> DataFrame:
    """Scan a table; partition values stay the strings they are ('01', not 1).

    A table that has gained columns has its schema beside its files: files from before lack some.
    """
    schema = stored_schema(spark, path)
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    df = spark.read.parquet(path)
    if all(isinstance(df.schema[name].dataType, T.StringType) for name in partitions):
        return df
    schema = T.StructType(
        [
            T.StructField(field.name, T.StringType()) if field.name in partitions else field
            for field in df.schema
        ]
    )
    return spark.read.schema(schema).parquet(path)


def write_table(
    df: DataFrame,
    path: str,
    partitions: Sequence[str] = DATE_PARTITIONS,
    mode: str = "overwrite",
    sort_by: str | None = None,
) -> None:
    """Write few, evenly sized files: rows gather by partition, a large one is split.

    sort_by: a key column that rows are looked up by. Files are sorted by it, so the statistics of
    row groups and pages tell where a value may be, and its Bloom filters tell which row groups
    have it; these take as many bytes as the group has values. Its order changes no row.
    """
    options = {}
    if sort_by is not None:
        # Named as the folder will be: a partition column that may be null is rewritten by the
        # writer, which then sorts again, by the partitions alone.
        named = {
            name: F.coalesce(F.nullif(F.col(name), F.lit("")), F.lit(NULL_PARTITION))
            for name in partitions
            if isinstance(df.schema[name].dataType, T.StringType)
        }
        df = df.withColumns(named)
    rows = df.hint("rebalance", *partitions)
    if sort_by is not None:
        rows = rows.sortWithinPartitions(*partitions, sort_by)
        options = {
            f"parquet.bloom.filter.enabled#{sort_by}": "true",
            "parquet.bloom.filter.adaptive.enabled": "true",
        }
    rows.write.mode(mode).options(**options).partitionBy(*partitions).parquet(path)


SCHEMA_FILE = "_schema.json"


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    text = read_file(spark, f"{path}/{SCHEMA_FILE}")
    return None if text is None else T.StructType.fromJson(json.loads(text))


def read_file(spark: SparkSession, path: str) -> str | None:
    """A small file, or None where it is not there."""
    if not exists(spark, path):
        return None
    fs, hadoop_path = file_system(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_file(spark: SparkSession, path: str, text: str) -> None:
    """A small file, in one step where the store closes files in one step."""
    fs, hadoop_path = file_system(spark, path)
    stream = fs.create(hadoop_path, True)
    stream.write(text.encode())
    stream.close()


def list_files(spark: SparkSession, path: str) -> list[str]:
    """The files directly below a folder; none where it is not there."""
    return list(file_sizes(spark, path))


def file_sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """The same with their bytes."""
    fs, hadoop_path = file_system(spark, path)
    if not fs.exists(hadoop_path):
        return {}
    return {str(s.getPath().getName()): s.getLen() for s in fs.listStatus(hadoop_path) if s.isFile()}


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders directly below a folder; none where it is not there."""
    fs, hadoop_path = file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return [str(s.getPath().getName()) for s in fs.listStatus(hadoop_path) if s.isDirectory()]


def delete_paths(spark: SparkSession, paths: Sequence[str]) -> None:
    for path in paths:
        fs, hadoop_path = file_system(spark, path)
        fs.delete(hadoop_path, True)


@contextmanager
def scratch_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A fresh folder in shared storage that goes when the block ends, however it ends."""
    path = scratch_path(spark, name)
    try:
        yield path
    finally:
        fs, hadoop_path = file_system(spark, path)
        fs.delete(hadoop_path, True)


def partition_path(row, partitions: Sequence[str]) -> str:
    """`a=1/b=2` as Spark names the folder; only values that need no escaping are allowed."""
    parts = []
    for name in partitions:
        value = NULL_PARTITION if row[name] is None else str(row[name])
        if not re.fullmatch(r"[\w.-]+", value):
            raise ValueError(f"partition value {value!r} of {name} is not a plain word")
        parts.append(f"{name}={value}")
    return "/".join(parts)


def partition_folder(partitions: Sequence[str] = DATE_PARTITIONS):
    """The same folder name as a column; on a scan it prunes directories."""
    parts = []
    for name in partitions:
        parts += [F.lit(f"{name}="), F.coalesce(F.col(name), F.lit(NULL_PARTITION)), F.lit("/")]
    return F.concat(*parts[:-1])


def table_files(df: DataFrame, partitions: Sequence[str] = DATE_PARTITIONS) -> DataFrame:
    """Files, rows and bytes per partition of a scanned table."""
    per_file = df.groupBy(
        *partitions,
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("file_bytes"),
    ).agg(F.count(F.lit(1)).alias("file_rows"))
    return per_file.groupBy(*partitions).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("file_rows").alias("row_count"),
        F.sum("file_bytes").alias("bytes"),
    )
