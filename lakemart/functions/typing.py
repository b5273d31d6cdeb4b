"""Declared types on text columns, and the rows that do not fit them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.functions.dates import parse_utc

CORRUPT = "_corrupt_record"
EXTRA = "extra"
REASONS = "reject_reasons"


def typed(value: Column, dtype: T.DataType) -> Column:
    """Text to a declared type; text that does not fit becomes null instead of failing."""
    if isinstance(dtype, T.StringType):
        return value
    if isinstance(dtype, (T.ArrayType, T.StructType, T.MapType)):
        return F.from_json(value, dtype)
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        return parse_utc(value).cast(dtype)
    if isinstance(dtype, T.IntegralType):
        # '-23.56' reads as -23, as a cast of text to a whole number always did.
        return value.try_cast("decimal(38,18)").try_cast(dtype)
    return value.try_cast(dtype)


def enforce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Give every declared column its type; other columns pass through."""
    missing = [name for name in schema.names if name not in df.columns]
    if missing:
        raise ValueError(f"declared columns missing from the source: {missing}")
    return df.drop(CORRUPT).withColumns(
        {field.name: typed(F.col(field.name), field.dataType) for field in schema}
    )


def reject_reasons(
    df: DataFrame, schema: T.StructType, required: Iterable[str], typed_as: str | None = None
) -> Column:
    """Comma-separated names of what is wrong with a text row; empty text when it is good.

    typed_as: where the typed values are columns already, their names with `{}` for the column's.
    A line that could not be split into its columns is wrong as a whole: its parts may stand under
    each other's names.
    """
    types = {field.name: field.dataType for field in schema}
    reasons = []
    if CORRUPT in df.columns:
        reasons.append(F.when(F.col(CORRUPT).isNotNull(), "line:malformed"))
    for name in required:
        value = F.col(name)
        as_type = typed(value, types[name]) if typed_as is None else F.col(typed_as.format(name))
        reasons.append(
            F.when(value.isNull(), f"{name}:null").when(as_type.isNull(), f"{name}:unreadable")
        )
    return F.concat_ws(",", *reasons)


def accepted(df: DataFrame, schema: T.StructType, required: Iterable[str]) -> DataFrame:
    """Typed rows of sound lines in which every required column could be read."""
    sound = df.where(F.col(CORRUPT).isNull()) if CORRUPT in df.columns else df
    good = enforce(sound, schema)
    for name in required:
        good = good.where(F.col(name).isNotNull())
    return good


def rejected(df: DataFrame, schema: T.StructType, required: Iterable[str]) -> DataFrame:
    """The rows `accepted` leaves out, as they came (a corrupt line too), with the reasons."""
    return df.withColumn(REASONS, reject_reasons(df, schema, required)).where(
        F.col(REASONS) != ""
    )
