"""Counts, null counts, numeric summaries; each is one pass over the data."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.columns import columns_of_type


def count_by(
    df: DataFrame,
    keys: Iterable[str | Column],
    *,
    name: str = "count",
    order: str | None = None,
) -> DataFrame:
    """Rows per key; ``order`` may be ``"keys"`` or ``"count"`` (descending)."""
    keys = list(keys)
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    if order == "keys":
        return out.orderBy(*out.columns[: len(keys)])
    if order == "count":
        return out.orderBy(F.desc(name), *out.columns[: len(keys)])
    return out


def null_profile(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """One row: number of nulls in every column."""
    return df.select(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols or df.columns])


def numeric_profile(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """count, mean, stddev, min and max of each numeric column, one row per column."""
    cols = list(cols if cols is not None else columns_of_type(df))
    stats = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("stddev"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in cols
        ]
    )
    return stats.select(F.inline(F.array(*[F.col(c) for c in cols])))


def row_count(df: DataFrame) -> int:
    return df.count()


def distinct_by(df: DataFrame, cols: Iterable[str | Column]) -> DataFrame:
    return df.select(*cols).distinct()
