"""Reading JSON-lines and CSV sources: declared columns as text, all other fields in one VARIANT."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions.typing import CORRUPT, EXTRA, accepted, reject_reasons, rejected
from lakemart.schemas import Dataset

BLANKS = " \t\r\n\f\v"
# The text of a line whose other fields no variant can hold, say with a key twice in one object.
WHOLE_LINE = "_line"
# No number in so short a line has more digits than the parser takes, a thousand.
PLAIN_LENGTH = 1000


def _text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in [*names, CORRUPT]])


def _spread_gzip(df: DataFrame) -> DataFrame:
    """A gzip file is read by one task; hand its rows to all of them before any work."""
    files = df.inputFiles()
    return df.hint("rebalance") if any(name.endswith(".gz") for name in files) else df


def _with_other_fields(lines: DataFrame, declared: Sequence[str]) -> DataFrame:
    """JSON lines with the fields that are not declared as a VARIANT object, null if there are none.

    Keys are taken as they are, dots and all; of a key that comes twice the last value counts. Each
    step is a column of its own, so a line is taken apart once. A line whose keys are all declared
    has none, and no variant is made of it where any could hold it: no key can come twice in an object
    within, and no number is too long.
    """
    inner = F.substring("value", 2, PLAIN_LENGTH)
    nested = [inner.contains("{" + after) for after in ('"', "'", " ", "\t")]
    undeclared = F.array_except(F.json_object_keys("value"), F.array(*map(F.lit, declared)))
    plain = (F.length("value") <= PLAIN_LENGTH) & ~reduce(Column.__or__, nested) & (F.size(undeclared) == 0)
    lines = lines.withColumn("_plain", F.coalesce(plain, F.lit(False)))
    lines = lines.withColumn("_all", F.when(~F.col("_plain"), F.from_json("value", "map<string,variant>")))
    lines = lines.withColumn("_others", F.map_filter("_all", lambda key, _: ~key.isin(*declared)))
    lines = lines.withColumn("_names", F.map_keys("_others"))

    def last_of_key(entry, place):
        from_behind = F.array_position(F.reverse("_names"), entry["key"])
        return from_behind == F.size("_names") - place

    single = F.size(F.array_distinct("_names")) == F.size("_names")
    last = F.map_from_entries(F.filter(F.map_entries("_others"), last_of_key))
    whole = F.map_from_arrays(F.array(F.lit(WHOLE_LINE)), F.array("value"))
    unheld = ~F.col("_plain") & F.col("_all").isNull() & F.col(f"fields.{CORRUPT}").isNull()
    extra = F.when(unheld, F.to_variant_object(whole)).when(
        F.size("_names") > 0,
        F.when(single, F.to_variant_object("_others")).otherwise(F.to_variant_object(last)),
    )
    return lines.withColumn(EXTRA, extra).drop("_plain", "_all", "_others", "_names")


def _json_text(reader, dataset: Dataset, path: str, undeclared: bool, stream: bool) -> DataFrame:
    lines = reader.text(path)
    lines = lines if stream else _spread_gzip(lines)
    # A line of blanks alone ends at its first other character; trimming both ends would walk them all.
    lines = lines.where(F.ltrim("value", F.lit(BLANKS)) != "")
    declared = dataset.schema.names
    parsed = F.from_json("value", _text_schema(declared), {"columnNameOfCorruptRecord": CORRUPT})
    lines = lines.withColumn("fields", parsed)
    if undeclared:
        lines = _with_other_fields(lines, declared)
    columns = [F.col(f"fields.{name}").alias(name) for name in declared]
    columns += [EXTRA] if undeclared else []
    return lines.select(*columns, F.col(f"fields.{CORRUPT}").alias(CORRUPT))


def csv_header(spark: SparkSession, path: str, options: dict[str, str]) -> list[str]:
    """The names in the first line of a file; none where there is no line at all."""
    first = spark.read.options(**options, header="false").csv(path).first()
    return [] if first is None else [name or "" for name in first]


def _csv_text(
    spark: SparkSession, reader, dataset: Dataset, path: str, undeclared: bool, multiline: bool, stream: bool
) -> DataFrame:
    options = {"escape": '"', "multiLine": str(multiline).lower()}
    names = csv_header(spark, path, options)
    declared = dataset.schema.names
    if not names:
        empty = spark.createDataFrame([], _text_schema(declared))
        return empty.withColumn(EXTRA, F.lit(None).cast("variant")) if undeclared else empty
    # A parser that skips columns would not see that a line has too many or too few.
    options |= {"columnPruning": "false", "columnNameOfCorruptRecord": CORRUPT}
    places = [f"_c{i}" for i in range(len(names))]
    lower = {name.lower() for name in [*names, CORRUPT]}
    if "" not in lower and len(lower) == len(names) + 1:
        # Every file has to prove that its header is the same as that of the first.
        options |= {"header": "true", "enforceSchema": "false"}
        text = reader.schema(_text_schema(names)).options(**options).csv(path).toDF(*places, CORRUPT)
    else:
        # Names that no schema can hold side by side: columns go by place, header lines by their text.
        if stream:
            raise ValueError(f"names of the header clash, so files cannot be landed one by one: {names}")
        text = reader.schema(_text_schema(places)).options(**options, header="false").csv(path)
        is_header = reduce(
            Column.__and__, [F.col(c).eqNullSafe(F.lit(n or None)) for c, n in zip(places, names, strict=True)]
        )
        per_file = text.groupBy("_metadata.file_path").agg(F.count_if(is_header).alias("headers"))
        without = per_file.where("headers = 0").count()
        if without:
            raise ValueError(f"{without} files do not have the header {names}")
        text = text.where(~is_header)
    text = text if stream else _spread_gzip(text)
    by_name: dict[str, list[str]] = {}
    for place, name in zip(places, names, strict=True):
        by_name.setdefault(name or place, []).append(place)
    columns = [F.col(by_name[name].pop(0)).alias(name) for name in declared if name in by_name]
    others = {name: found for name, found in by_name.items() if found}
    if undeclared:
        extra = F.lit(None).cast("variant")
        if others:
            # Of a name that comes twice the last value counts; an empty cell is no field.
            values = [F.coalesce(*(F.col(c) for c in reversed(found))) for found in others.values()]
            fields = F.map_from_arrays(F.array(*map(F.lit, others)), F.array(*values))
            fields = F.map_filter(fields, lambda _, value: value.isNotNull())
            extra = F.when(F.size(fields) > 0, F.to_variant_object(fields))
        columns.append(extra.alias(EXTRA))
    return text.select(*columns, CORRUPT)


def read_text(
    spark: SparkSession,
    dataset: Dataset,
    path: str,
    undeclared: bool = True,
    multiline: bool = False,
    stream: bool = False,
) -> DataFrame:
    """The declared columns as text, the other fields, and the raw line where it could not be split.

    Fields that are not declared lie in the VARIANT column `extra`, under their own names whatever
    these are: `variant_get(extra, "$['utm.source']", 'string')`. It is null where a line has none;
    `undeclared=False` leaves it out. Values of CSV files are text, those of JSON what JSON says.
    A line is read once and no names are searched for; of a CSV source the first line is. With
    `stream` the rows of files not seen before, to be run by a streaming query.
    """
    reader = spark.readStream if stream else spark.read
    if dataset.format == "json":
        return _json_text(reader, dataset, path, undeclared, stream)
    if dataset.format == "csv":
        return _csv_text(spark, reader, dataset, path, undeclared, multiline, stream)
    raise ValueError(f"unknown source format {dataset.format!r}")


def required(dataset: Dataset) -> list[str]:
    return list(dict.fromkeys([*dataset.keys, dataset.time]))


def read_source(spark: SparkSession, dataset: Dataset, path: str, **options) -> DataFrame:
    """Typed rows whose keys and time could be read."""
    return accepted(read_text(spark, dataset, path, **options), dataset.schema, required(dataset))


def source_counts(spark: SparkSession, dataset: Dataset, path: str, **options) -> dict[str, int]:
    """Lines of the source and how many are rejected, in one scan; how many are accepted, in one
    more, by the way that takes them."""
    text = read_text(spark, dataset, path, **options)
    needed = required(dataset)
    wrong = reject_reasons(text, dataset.schema, needed) != ""
    row = text.agg(F.count("*").alias("read"), F.count_if(wrong).alias("rejected")).first()
    return row.asDict() | {"accepted": accepted(text, dataset.schema, needed).count()}


def read_rejected(spark: SparkSession, dataset: Dataset, path: str, **options) -> DataFrame:
    """The source rows `read_source` leaves out, as text, with the reasons."""
    return rejected(read_text(spark, dataset, path, **options), dataset.schema, required(dataset))
