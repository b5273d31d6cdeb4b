"""Masking of sensitive columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def masked(value: Column, salt: str | None = None) -> Column:
    """Hex SHA-1 of the hex MD5 of the value as text; null stays null.

    Without a salt, short ids can be found again by hashing every possible id. With a
    salt the result is the hex SHA-256 of salt and text instead.
    """
    text = value.cast("string")
    if salt is None:
        return F.sha1(F.md5(text))
    return F.sha2(F.concat(F.lit(salt), text), 256)


def mask(df: DataFrame, columns: Iterable[str], salt: str | None = None) -> DataFrame:
    """Replace each named column that the frame has; the columns stay in place."""
    return df.withColumns(
        {name: masked(F.col(name), salt) for name in columns if name in df.columns}
    )
