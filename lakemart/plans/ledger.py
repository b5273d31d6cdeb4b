"""What a backfill has finished: for each interval, a fingerprint of the source rows it was built from."""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.sources.tables import delete_paths, list_files, read_file, write_file

NAME = "%Y%m%dT%H%M%S%f"


def row_hash(df: DataFrame) -> Column:
    """64 bits of a row, whatever the order of its fields in a variant."""
    return F.xxhash64(
        *(F.to_json(f.name) if isinstance(f.dataType, T.VariantType) else F.col(f"`{f.name}`") for f in df.schema)
    )


def fingerprints(frames: Mapping[str, DataFrame]) -> dict[str, list[str]]:
    """For each frame its number of rows, and the sum and the exclusive-or of their hashes: the same
    for the same rows in any order and any files, combined in the tasks, in one job for all frames.

    Two different sets of rows have the same one with a probability of about 2^-64.
    """
    parts = []
    for name, df in frames.items():
        hashed = df.select(row_hash(df).alias("h"))
        parts.append(
            hashed.agg(
                F.count(F.lit(1)).cast("string").alias("n"),
                F.coalesce(F.sum(F.col("h").cast("decimal(38,0)")), F.lit(0)).cast("string").alias("total"),
                F.coalesce(F.bit_xor("h"), F.lit(0)).cast("string").alias("mixed"),
            ).select(F.lit(name).alias("name"), "n", "total", "mixed")
        )
    if not parts:
        return {}
    return {r["name"]: [r["n"], r["total"], r["mixed"]] for r in reduce(DataFrame.unionAll, parts).collect()}


class Ledger:
    """One small file per finished interval, in a folder of the lake."""

    def __init__(self, spark: SparkSession, lake: str):
        self.spark, self.folder = spark, f"{lake}/ledger"

    def _file(self, start: datetime, end: datetime) -> str:
        return f"{self.folder}/{start.strftime(NAME)}-{end.strftime(NAME)}.json"

    def holds(self, start: datetime, end: datetime, entry: Mapping) -> bool:
        """Whether the interval was finished from exactly this."""
        text = read_file(self.spark, self._file(start, end))
        return text is not None and json.loads(text) == json.loads(json.dumps(entry))

    def note(self, start: datetime, end: datetime, entry: Mapping) -> None:
        write_file(self.spark, self._file(start, end), json.dumps(entry))

    def forget(self, start: datetime, end: datetime) -> None:
        """Before rows of a span are published: what was finished of it is so no longer."""
        gone = []
        for name in list_files(self.spark, self.folder):
            if name.endswith(".json"):
                first, last = (datetime.strptime(x, NAME) for x in name.removesuffix(".json").split("-"))
                if first < end and start < last:
                    gone.append(f"{self.folder}/{name}")
        delete_paths(self.spark, gone)
