"""Landing source files as they arrive: each file is read once, whatever the intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.functions.dates import with_date_partitions
from lakemart.functions.typing import accepted, rejected
from lakemart.operators.upsert import joint_schema, nullable
from lakemart.schemas import DATASETS, DATE_PARTITIONS, Dataset
from lakemart.sources.files import read_text, required
from lakemart.sources.tables import SCHEMA_FILE, exists, read_table, write_file

# Files of one date and micro-batch, at most: enough tasks for a large day, few files for a small one.
FILES_PER_DATE = 8


def land_new_files(
    spark: SparkSession,
    dataset: Dataset | str,
    source: str,
    path: str,
    rejected_path: str | None = None,
    **options,
) -> DataFrame:
    """Append the typed rows of the files not seen before to a date-partitioned landing table.

    Returns the whole landing table, which the interval jobs take in place of a source path
    and read only the days of. A streaming query over everything available keeps track of
    the files and commits each exactly once; a run that is cut short is taken up by the next. The
    rows that cannot be taken are appended, with the reasons, at `rejected_path`. Fields that are
    not declared lie in `extra`, so those that come with later files need no new column. The table
    keeps its schema beside its files: files that an older version has landed may lack columns.
    """
    dataset = DATASETS[dataset] if isinstance(dataset, str) else dataset
    text = read_text(spark, dataset, source, stream=True, **options)
    if not text.isStreaming:
        # CSV files without so much as a header: no columns, nothing to land
        return with_date_partitions(accepted(text, dataset.schema, required(dataset)), dataset.time)
    typed = with_date_partitions(
        accepted(text, dataset.schema, required(dataset)), dataset.time
    )
    columns = typed.schema
    if exists(spark, path):
        columns = joint_schema(read_table(spark, path).schema, typed.schema)
    write_file(spark, f"{path}/{SCHEMA_FILE}", nullable(columns).json())
    share = F.pmod(F.xxhash64(*dataset.keys), F.lit(FILES_PER_DATE))
    _append(typed.repartition(*DATE_PARTITIONS, share), path, DATE_PARTITIONS)
    if rejected_path is not None:
        _append(rejected(text, dataset.schema, required(dataset)), rejected_path)
    return read_table(spark, path)


def _append(rows: DataFrame, path: str, partitions=()) -> None:
    writer = rows.writeStream.format("parquet").partitionBy(*partitions)
    writer = writer.option("checkpointLocation", f"{path}__progress").trigger(availableNow=True)
    writer.start(path).awaitTermination()
