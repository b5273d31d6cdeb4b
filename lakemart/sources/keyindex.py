"""Which partition folders hold rows of a key: a bucketed table beside a raw table, kept by its ingest.

A row is (kind, key, folder), the kind being the column the key is of. The table may name a folder
that has no row of the key (any more), never lack one that has: pairs are added before the rows are
published. Its files are bucketed by key, so looking keys up moves the keys asked for, not the index.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.schemas import DATE_PARTITIONS
from lakemart.sources.tables import (
    delete_paths,
    file_sizes,
    list_folders,
    partition_folder,
    read_file,
    write_file,
)

STATE = "_index.json"
PAIRS_PER_BUCKET = 2_000_000
LEAST_BUCKETS = 4
# Pairs are counted once the files have so many bytes a bucket: a pair takes half a byte at least.
SMALL_BUCKET = PAIRS_PER_BUCKET
# Each ingest adds up to one file per bucket; after so many per bucket the index is built anew.
FILES_PER_BUCKET = 32


class KeyIndex:
    """The index of some columns of a date-partitioned table."""

    def __init__(self, spark: SparkSession, path: str, columns: Sequence[str]):
        self.spark, self.path, self.columns = spark, path, list(columns)

    def _state(self) -> dict | None:
        text = read_file(self.spark, f"{self.path}/{STATE}")
        state = None if text is None else json.loads(text)
        return state if state and state["columns"] == self.columns else None

    def exists(self) -> bool:
        return self._state() is not None

    def pairs_of(self, rows: DataFrame) -> DataFrame:
        """The distinct (kind, key, folder) of some rows; a null key is in none."""
        kinds = [F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("key")) for c in self.columns]
        pairs = rows.select(F.explode(F.array(*kinds)).alias("k"), partition_folder().alias("folder"))
        return pairs.select("k.kind", "k.key", "folder").where("key IS NOT NULL").distinct()

    def _table(self, state: dict) -> str:
        """The files as a bucketed table of this session; they hold all there is to it."""
        folder = f"{self.path}/{state['generation']}"
        name = f"lakemart_index_{hashlib.sha256(folder.encode()).hexdigest()[:16]}"
        place = folder.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (kind STRING, key STRING, folder STRING) USING parquet"
            f" CLUSTERED BY (key) SORTED BY (key) INTO {state['buckets']} BUCKETS LOCATION '{place}'"
        )
        return name

    def _append(self, state: dict, pairs: DataFrame) -> None:
        name = self._table(state)
        pairs.repartition(state["buckets"], "key").write.insertInto(name)
        self.spark.catalog.refreshTable(name)

    def pairs(self) -> DataFrame:
        return self.spark.table(self._table(self._state()))

    def rebuild(self, table: DataFrame) -> None:
        """Take all pairs from the table, a scan of its keys and partitions alone. The state file says
        which files count, so a rebuild that stops leaves what was there."""
        pairs = self.pairs_of(table)
        buckets = max(LEAST_BUCKETS, -(-pairs.count() // PAIRS_PER_BUCKET))
        state = {"generation": f"pairs-{uuid.uuid4().hex[:12]}", "buckets": buckets, "columns": self.columns}
        before = list_folders(self.spark, self.path)
        self._append(state, pairs)
        write_file(self.spark, f"{self.path}/{STATE}", json.dumps(state))
        delete_paths(self.spark, [f"{self.path}/{folder}" for folder in before])

    def add(self, rows: DataFrame) -> None:
        """Add the pairs of some rows that the index does not have; before the rows are published.

        They are compared with the pairs of their folders alone: files of other folders are passed over
        by their statistics."""
        state = self._state()
        name = self._table(state)
        found = rows.select(*DATE_PARTITIONS).distinct().select(partition_folder().alias("folder")).collect()
        known = self.spark.table(name).where(F.col("folder").isin([row["folder"] for row in found]))
        same = [F.col(f"new.{c}") == F.col(f"known.{c}") for c in ("key", "kind", "folder")]
        new = self.pairs_of(rows).alias("new").join(known.alias("known"), same, "left_anti")
        self._append(state, new)

    def crowded(self) -> bool:
        """Whether so many files or pairs have come together that the index should be built anew, with
        more buckets where the pairs ask for them."""
        state = self._state()
        sizes = file_sizes(self.spark, f"{self.path}/{state['generation']}")
        parts = [size for name, size in sizes.items() if name.startswith("part-")]
        if len(parts) > FILES_PER_BUCKET * state["buckets"]:
            return True
        return sum(parts) > SMALL_BUCKET * state["buckets"] and (
            self.pairs().count() > 2 * PAIRS_PER_BUCKET * state["buckets"]
        )

    def places(self, kind: str, keys: DataFrame) -> DataFrame:
        """(key, folder) of the keys asked for, a frame of one column."""
        asked = keys.select(F.col(keys.columns[0]).cast("string").alias("key")).distinct()
        return self.pairs().where(F.col("kind") == kind).join(asked, "key", "left_semi").select("key", "folder")

    def folders(self, kind: str, keys: DataFrame) -> list[str]:
        """The partition folders that may hold rows of the keys: at most all folders of the table."""
        return self.found(kind, keys, 0)[0]

    def found(self, kind: str, keys: DataFrame, most: int) -> tuple[list[str], list[str] | None]:
        """The same, and those of the keys that may have rows where they are so many at most."""
        places = self.places(kind, keys)
        per_folder = places.groupBy("folder").count().collect()
        folders = sorted(row["folder"] for row in per_folder)
        if any(row["count"] > most for row in per_folder):
            return folders, None
        few = places.select("key").distinct().limit(most + 1).collect()
        return folders, [row["key"] for row in few] if len(few) <= most else None


def in_folders(table: DataFrame, folders: Sequence[str]) -> DataFrame:
    """The rows of some partition folders; the scan lists and reads no others."""
    return table.where(partition_folder(DATE_PARTITIONS).isin(list(folders)))
