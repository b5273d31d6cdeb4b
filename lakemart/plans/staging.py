"""A source read once: the rows that are taken, those that are not, and how many of each."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions.dates import with_date_partitions
from lakemart.functions.typing import CORRUPT, REASONS, accepted, reject_reasons, typed
from lakemart.schemas import DATE_PARTITIONS, Dataset
from lakemart.sources.files import read_text, required

LINE = "_line_as_read"
REFUSED = "refused_line"
TYPED = "_typed_{}"


@dataclass(frozen=True)
class Staged:
    """What one scan of a source has written.

    taken: typed rows; stored: the same as they lie in the files, which of rows by date has nested
    columns as text; rejected: rows as text, with the reasons; read, refused: the counts, as the
    scan itself has observed them.
    """

    taken: DataFrame
    stored: DataFrame
    rejected: DataFrame
    read: int
    refused: int


def stage(
    spark: SparkSession, dataset: Dataset, source: str, path: str, by_date: bool = False, **options
) -> Staged:
    """Read the source files once and write every line to one table at `path`: typed columns, and
    for a line that cannot be taken its text and the reasons. by_date: with date partitions, the rows
    gathered by them on their way, and the refused lines apart.

    The counts come with the write, in the tasks that write; of a task that is run again only one
    result counts.
    """
    text = read_text(spark, dataset, source, **options)
    late = [f for f in dataset.schema if by_date and isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))]
    rows = text.withColumns(
        {TYPED.format(f.name): F.col(f.name) if f in late else typed(F.col(f.name), f.dataType) for f in dataset.schema}
    )
    reasons = reject_reasons(text, dataset.schema, required(dataset), typed_as=TYPED)
    rows = rows.withColumn(REASONS, reasons)
    line = F.when(F.col(REASONS) != "", F.struct(*text.columns, REASONS))
    others = [name for name in text.columns if name not in {*dataset.schema.names, CORRUPT}]
    values = [F.col(TYPED.format(name)).alias(name) for name in dataset.schema.names]
    rows = rows.select(*values, *others, line.alias(LINE))
    refused, partitions = F.col(LINE).isNotNull(), []
    if by_date:
        rows = with_date_partitions(rows, dataset.time).withColumn(REFUSED, refused.cast("string"))
        refused, partitions = F.col(REFUSED) == "true", [REFUSED, *DATE_PARTITIONS]
        rows = rows.hint("rebalance", *partitions)
    observed = Observation()
    rows = rows.observe(observed, F.count(F.lit(1)).alias("read"), F.count_if(refused).alias("refused"))
    rows.write.partitionBy(*partitions).parquet(path)
    counts = observed.get
    written = spark.read.schema(rows.schema).parquet(path)
    stored = written.where(~refused).drop(LINE, REFUSED)
    return Staged(
        stored.withColumns({f.name: typed(F.col(f.name), f.dataType) for f in late}) if late else stored,
        stored,
        # Only the text of refused lines is read, which is next to nothing where there are few.
        written.where(refused).select(f"{LINE}.*"),
        counts["read"],
        counts["refused"],
    )


class Watched:
    """The typed rows of a source, which count themselves in whatever action reads them all.

    Both counts go with the same scan: of all lines, and of the rows that are taken by the way
    `accepted` takes them.
    """

    def __init__(self, spark: SparkSession, dataset: Dataset, source: str, **options):
        self._read, self._taken = Observation(), Observation()
        # Other fields have no say in what is taken.
        text = read_text(spark, dataset, source, **options | {"undeclared": False})
        text = text.observe(self._read, F.count(F.lit(1)).alias("read"))
        rows = accepted(text, dataset.schema, required(dataset))
        self.rows = rows.observe(self._taken, F.count(F.lit(1)).alias("accepted"))

    def counts(self) -> dict[str, int]:
        """After an action on the rows."""
        return self._read.get | self._taken.get
