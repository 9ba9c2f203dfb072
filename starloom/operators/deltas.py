"""Keep derived tables up to date from what changed, without reading all of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.columns import all_of


def signed_counts(added: DataFrame, removed: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """How many rows more (or less) there are of each combination of ``keys``."""
    plus = added.select(*keys, F.lit(1).cast("bigint").alias(name))
    minus = removed.select(*keys, F.lit(-1).cast("bigint").alias(name))
    return plus.unionByName(minus).groupBy(*keys).agg(F.sum(name).alias(name)).where(F.col(name) != 0)


def merge_counts(stored: DataFrame, delta: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Stored counts with a delta added; combinations that no row has any more go.

    Both sides have a row per combination at most, so what meets is as large as
    the roll-up and never as large as what it counts. NULL keys count as equal.
    """
    both = stored.select(*keys, name).unionByName(delta.select(*keys, name))
    return both.groupBy(*keys).agg(F.sum(name).alias(name)).where(F.col(name) > 0)


def zones(df: DataFrame, partition: str, key: str) -> DataFrame:
    """Per partition the least and the largest key, ``(partition, lo, hi)``."""
    return df.groupBy(partition).agg(F.min(key).alias("lo"), F.max(key).alias("hi"))


def partitions_with(keys: DataFrame, zoned: DataFrame, partition: str) -> list:
    """The partitions that may hold one of ``keys`` (one column), by their zones.

    Zones are a row per partition, as few as the partitions a driver lists.
    """
    key = F.col(keys.columns[0])
    within = (key >= F.col("lo")) & (key <= F.col("hi"))
    near = keys.join(F.broadcast(zoned), within).select(partition).distinct()
    return [r[0] for r in near.collect()]


def in_partitions(df: DataFrame, partition: str, values: Sequence) -> DataFrame:
    """Rows of these partitions; as constants the values prune the scan."""
    some = [v for v in values if v is not None]
    return df.where(F.col(partition).isin(some) | (F.col(partition).isNull() & F.lit(None in values)))


def without_keys(df: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` under none of the keys of ``gone``."""
    names = [f"_gone_{k}" for k in keys]
    marked = gone.select(*[F.col(k).alias(n) for k, n in zip(keys, names)]).distinct()
    match = all_of(F.col(k) == F.col(n) for k, n in zip(keys, names))
    return df.join(marked, match, "left_anti")
