"""Sort, first rows, union."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def order(df: DataFrame, keys: Iterable[str], descending: Iterable[str] = ()) -> DataFrame:
    """Global sort; columns in ``descending`` run downwards, nulls last there."""
    down = set(descending)
    return df.orderBy(*[F.col(k).desc() if k in down else F.col(k).asc() for k in keys])


def head_n(df: DataFrame, n: int, keys: Iterable[str], descending: Iterable[str] = ()) -> DataFrame:
    """First ``n`` rows in order; each task keeps only its own first ``n``."""
    return order(df, keys, descending).limit(n)


def union_all(a: DataFrame, b: DataFrame, *, by_name: bool = True) -> DataFrame:
    return a.unionByName(b) if by_name else a.union(b)
