"""Update-or-insert by key into a date-partitioned Parquet table.

Plain files have no MERGE. The touched partitions are written anew as additional files into the
folders of the table, by the executors; then the files they replace are deleted. A small record
beside the table, stored before anything is written, lists the old files; a second one, stored
when the new files are complete, says that they hold. Nothing is moved, and every step can be
repeated: a run that stops before the second record is undone by deleting what it wrote, one that
stops after it is finished by deleting what is old. One writer per table; a reader may see old and
new files of a partition together until the old ones are gone.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators.quality import QualityError, require_keys
from lakemart.schemas import DATE_PARTITIONS
from lakemart.sources.tables import (
    SCHEMA_FILE,
    exists,
    file_system,
    list_files,
    partition_folder,
    partition_path,
    read_file,
    read_table,
    table_exists,
    write_file,
    write_table,
)


def _by_keys(df: DataFrame, of: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join of `df` with the keys of `of`; null matches null.

    A key may be a nested field such as item.sequence. Nothing sits between the shuffles
    and this join, so the adaptive skew split can work on a key with many rows in `df`.
    """
    same = F.lit(True)
    for i, key in enumerate(keys):
        same = same & F.col(key).eqNullSafe(F.col(f"_key_{i}"))
    listed = of.select(*(F.col(key).alias(f"_key_{i}") for i, key in enumerate(keys)))
    return df.join(listed, same, how)


def _not_older(batch: DataFrame, target: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """The batch rows for whose key the target holds nothing newer."""
    newer = F.col("_time") > F.col(time)
    for i, key in enumerate(keys):
        newer = newer & F.col(key).eqNullSafe(F.col(f"_key_{i}"))
    held = target.select(
        F.col(time).alias("_time"), *(F.col(key).alias(f"_key_{i}") for i, key in enumerate(keys))
    )
    return batch.join(held, newer, "left_anti")


def merged(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    replaced: DataFrame | None = None,
) -> DataFrame:
    """The target after the upsert: target rows whose key is not replaced, and the source rows.

    `replaced` names the keys whose old rows go; by default those of the source. Nulls in
    a key match each other. A column that only one side has is null in the other's rows.
    """
    gone = source if replaced is None else replaced
    return _by_keys(target, gone, keys, "left_anti").unionByName(source, allowMissingColumns=True)


def joint_schema(table: T.StructType, batch: T.StructType) -> T.StructType:
    """The table's columns, then those that only the batch has."""
    types = {field.name: field.dataType for field in table}
    differing = [f.name for f in batch if types.get(f.name, f.dataType) != f.dataType]
    if differing:
        raise QualityError(f"table and batch differ in the types of columns: {differing}")
    return T.StructType([*table, *(f for f in batch if f.name not in types)])


@dataclass(frozen=True)
class _Run:
    """The records of one upsert, and scratch tables, in a folder beside the table."""

    spark: SparkSession
    table: str

    @property
    def root(self) -> str:
        return f"{self.table}__staging"

    @property
    def source(self) -> str:
        return f"{self.root}/source"

    @property
    def kept(self) -> str:
        return f"{self.root}/kept"

    @property
    def replaced(self) -> str:
        return f"{self.root}/replaced"

    @property
    def begun(self) -> str:
        return f"{self.root}/begun.json"

    @property
    def holds(self) -> str:
        return f"{self.root}/holds.json"

    def _fs(self):
        return file_system(self.spark, self.root)[0]

    def delete(self, path: str) -> None:
        """The only step that takes anything away; done already if the path is not there."""
        self._fs().delete(self.spark._jvm.org.apache.hadoop.fs.Path(path), True)

    def save(self, path: str, record: dict) -> None:
        """A record counts only with its last character, so a torn one is no record."""
        write_file(self.spark, path, json.dumps(record) + "\n")

    def load(self, path: str) -> dict | None:
        text = read_file(self.spark, path)
        return json.loads(text) if text is not None and text.endswith("\n") else None

    def files(self, folders: Iterable[str]) -> dict[str, list[str]]:
        with ThreadPoolExecutor(max_workers=16) as pool:
            paths = {folder: f"{self.table}/{folder}" for folder in folders}
            found = pool.map(lambda path: list_files(self.spark, path), paths.values())
            return dict(zip(paths, found, strict=True))

    def delete_all(self, paths: Iterable[str]) -> None:
        with ThreadPoolExecutor(max_workers=16) as pool:
            list(pool.map(self.delete, paths))

    def undo(self, record: dict) -> None:
        """Take away what the run wrote: whatever was not there before."""
        if record["create"]:
            self.delete(self.table)
            return
        self.delete(f"{self.table}/_temporary")
        now = self.files(record["old"])
        self.delete_all(
            f"{self.table}/{folder}/{name}"
            for folder, names in now.items()
            for name in names
            if name not in set(record["old"][folder])
        )
        self.remove_empty(record)

    def finish(self, record: dict) -> None:
        """Take away what the run replaced."""
        self.delete_all(
            f"{self.table}/{folder}/{name}"
            for folder, names in record["old"].items()
            for name in names
        )
        self.remove_empty(record)

    def remove_empty(self, record: dict) -> None:
        left = self.files(record["old"])
        self.delete_all(f"{self.table}/{folder}" for folder, names in left.items() if not names)

    def drop(self) -> None:
        """The record that the run holds goes last: without it a repeated undo would take the new
        files for leftovers, so the list of old files goes first."""
        self.delete(self.begun)
        self.delete(self.root)


def recover(spark: SparkSession, path: str) -> None:
    """Finish an interrupted upsert whose new files are complete; undo one that got less far."""
    run = _Run(spark, path)
    if not exists(spark, run.root):
        return
    record = run.load(run.begun)
    if record is not None:
        if run.load(run.holds) is None:
            run.undo(record)
        else:
            run.finish(record)
        spark.catalog.refreshByPath(path)
    run.drop()


def _write(
    run: _Run, rows: DataFrame, record: dict, partitions: Sequence[str], keys: Sequence[str]
) -> None:
    """Record, write, record, delete; each can be repeated. Files are sorted by the first key."""
    run.save(run.begun, record)
    types = {field.name: field.dataType for field in rows.schema}
    looked_up = isinstance(types.get(keys[0]), (T.StringType, T.IntegerType, T.LongType))
    sort_by = keys[0] if looked_up and keys[0] not in partitions else None
    write_table(rows, run.table, partitions, mode="append", sort_by=sort_by)
    if record.get("schema"):
        write_file(run.spark, f"{run.table}/{SCHEMA_FILE}", record["schema"])
    run.save(run.holds, {"holds": True})
    run.finish(record)
    run.spark.catalog.refreshByPath(run.table)


def upsert(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    partitions: Sequence[str] = DATE_PARTITIONS,
    replaced: DataFrame | None = None,
    replaced_keys: Sequence[str] | None = None,
    key_fixes_partition: bool = False,
    newest_by: str | None = None,
    candidates: DataFrame | None = None,
    not_null: Sequence[str] = (),
    stored_rows: int | None = None,
) -> None:
    """Create the table from the source, or update it by key.

    keys                 unique in the source, may name nested fields
    partitions           partition columns of the table
    replaced             frame of keys whose old rows go (default: those of the source)
    replaced_keys        the key columns of `replaced`, when fewer than `keys` (no nested fields)
    key_fixes_partition  a key never changes partition, so the table need not be searched
    newest_by            time column; a row does not replace one that is newer in the table
    candidates           frame of partition values outside which no old row of a replaced key can
                         stand; only those partitions are searched
    not_null             columns that must not be null in the source
    stored_rows          the rows of a source that is a scan of files which stay while this runs, and
                         whose keys have been found unique: it is neither written nor counted again

    An empty source leaves the table alone. Running the same upsert again changes nothing. Columns
    that the table lacks are added to it; those that the source lacks are null in its rows. The
    source is checked before anything of the table changes.
    """
    recover(spark, path)
    run = _Run(spark, path)
    match = list(replaced_keys or keys)
    if stored_rows is not None and not_null:
        raise ValueError("a stored source is not checked again, so not for nulls either")
    if newest_by is not None and (replaced is not None or match != list(keys)):
        raise ValueError("newest_by compares rows of one key, so it takes no replaced keys")
    try:
        _upsert(
            run, source, list(keys), match, list(partitions), replaced, key_fixes_partition,
            newest_by, candidates, not_null, stored_rows,
        )
    except QualityError:
        run.drop()
        raise
    run.drop()


def _upsert(
    run: _Run,
    source: DataFrame,
    keys: list[str],
    match: list[str],
    partitions: list[str],
    replaced: DataFrame | None,
    key_fixes_partition: bool,
    newest_by: str | None,
    candidates: DataFrame | None,
    not_null: Sequence[str],
    stored_rows: int | None,
) -> None:
    spark = run.spark
    batch, rows = source, stored_rows
    if rows is None:
        # The batch is written once and read back: it is used several times below, and what
        # was written survives the loss of any executor.
        source.write.mode("overwrite").parquet(run.source)
        batch = spark.read.schema(source.schema).parquet(run.source)
        rows = require_keys(batch, unique=keys, not_null=not_null)
    if not table_exists(spark, run.table):
        if rows:
            _folders(batch, partitions)
            _write(run, batch, {"create": True, "old": {}}, partitions, keys)
        return
    gone = batch
    if replaced is not None or match != keys:
        # Fewer key columns than the unique ones repeat; one row per key is kept on disk.
        ids = (batch if replaced is None else replaced).select(*match).distinct()
        ids.write.mode("overwrite").parquet(run.replaced)
        gone = spark.read.schema(ids.schema).parquet(run.replaced)
    if rows == 0 and (replaced is None or gone.isEmpty()):
        return

    target = read_table(spark, run.table, partitions)
    schema = joint_schema(target.schema, batch.schema)
    searched = target
    if candidates is not None:
        listed = _folders(candidates, partitions)
        searched = target.where(partition_folder(partitions).isin(listed))
    if newest_by is not None:
        _not_older(batch, searched, keys, newest_by).write.mode("overwrite").parquet(run.kept)
        gone = batch = spark.read.schema(source.schema).parquet(run.kept)
        if batch.isEmpty():
            return
    touched = batch.select(*partitions)
    if not (key_fixes_partition and replaced is None):
        hit = _by_keys(searched, gone, match, "left_semi")
        touched = touched.unionByName(hit.select(*partitions))
    folders = _folders(touched, partitions)
    kept_side = target.where(partition_folder(partitions).isin(folders))
    record = {"create": False, "old": run.files(folders)}
    if schema != target.schema:
        record["schema"] = nullable(schema).json()
    result = merged(kept_side, batch, match, gone)
    _write(run, result.select(*schema.names), record, partitions, keys)


def nullable(schema: T.StructType) -> T.StructType:
    """A schema to read files of any age with: every column may be missing."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def _folders(rows: DataFrame, partitions: Sequence[str]) -> list[str]:
    """The partition folders of some rows: at most one per folder of the table, a list the scan
    itself plans with."""
    found = rows.select(*partitions).distinct().collect()
    return sorted(partition_path(row, partitions) for row in found)
