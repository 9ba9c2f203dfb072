"""Row predicates: nulls, sentinel values, dates."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date, datetime, time
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.columns import combine


def is_null(cols: Iterable[str], how: str = "all") -> Column:
    return combine([F.col(c).isNull() for c in cols], how)


def has_value(
    values: Mapping[str, Any], how: str = "all", *, as_type: str | None = None
) -> Column:
    """True where the columns hold the given values; never NULL."""
    read = lambda c: F.col(c).try_cast(as_type) if as_type else F.col(c)
    return combine([read(c).eqNullSafe(F.lit(v)) for c, v in values.items()], how)


def where_null(df: DataFrame, cols: Iterable[str], how: str = "all") -> DataFrame:
    return df.where(is_null(cols, how))


def where_not_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.where(combine([F.col(c).isNotNull() for c in cols], "all"))


def where_value(df: DataFrame, values: Mapping[str, Any], how: str = "all") -> DataFrame:
    return df.where(has_value(values, how))


def drop_nulls(df: DataFrame, cols: Iterable[str], how: str = "any") -> DataFrame:
    """Drop rows with a null in any (or all) of ``cols``."""
    return df.na.drop(how=how, subset=list(cols))


def drop_values(df: DataFrame, cols: Iterable[str], value: Any) -> DataFrame:
    """Keep rows in which every column differs from ``value``; nulls are dropped too."""
    return df.where(combine([F.col(c) != F.lit(value) for c in cols], "all"))


def where_since(df: DataFrame, col: str, day: date) -> DataFrame:
    """Rows from the start of ``day`` on.

    Compares the raw column with a constant rather than ``to_date(col)``, so
    the filter reaches the scan.
    """
    kind = df.schema[col].dataType.simpleString()
    if kind in ("timestamp", "timestamp_ntz"):
        start = F.lit(datetime.combine(day, time.min).isoformat(sep=" ")).cast(kind)
    elif kind == "string":
        # ISO text sorts by date.
        start = F.lit(day.isoformat())
    else:
        start = F.lit(day)
    return df.where(F.col(col) >= start)
