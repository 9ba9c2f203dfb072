"""First row per group and surrogate keys."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.columns import column
from starloom.session import reliable_checkpoint

# monotonically_increasing_id() keeps the row's place in the low 33 bits.
_LOCAL_BITS = 33


def first_per_group(
    df: DataFrame, keys: Iterable[str | Column], order: Iterable[str | Column]
) -> DataFrame:
    """The first row of each group in ``order``; give a total order to be repeatable.

    Each task drops all but its own first row of a group before the shuffle
    (WindowGroupLimit), so a huge group costs one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def dedupe(
    df: DataFrame, keys: Iterable[str], order: Iterable[str | Column] | None = None
) -> DataFrame:
    """One row per key; which one is arbitrary unless ``order`` is given."""
    keys = list(keys)
    return df.dropDuplicates(keys) if order is None else first_per_group(df, keys, order)


def max_key(df: DataFrame, key: str) -> DataFrame:
    """One row ``max_key``: the largest key so far, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(key), F.lit(0)).cast("bigint").alias("max_key"))


def with_scalar(df: DataFrame, scalar: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row."""
    return df.crossJoin(F.broadcast(scalar))


def assign_keys(
    df: DataFrame,
    order: Iterable[str | Column],
    *,
    start: DataFrame | int = 0,
    name: str = "surrogate_key",
) -> DataFrame:
    """Number the rows ``start + 1 …`` in ``order`` without gathering them in one task.

    A range sort gives each task one slice of the order.  The slice number and
    the place within it are stored with the rows in the shared folder, so a
    recomputed task cannot renumber them.  Only one count per slice is summed
    up centrally.  ``start`` is a number or the one-row result of ``max_key``.

    Rows that tie in ``order`` are told apart by their other columns, so that
    they are numbered alike every time and need not share a slice.
    """
    ties = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    placed = df.orderBy(*[column(o) for o in order], *ties).withColumn(
        "_place", F.monotonically_increasing_id()
    )
    placed = reliable_checkpoint(placed)
    part = F.shiftright("_place", _LOCAL_BITS)
    local = F.col("_place").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    # One row per task of the sort, so this window and broadcast stay small.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    if isinstance(start, DataFrame):
        offsets = with_scalar(offsets, start.select(F.col(start.columns[0]).alias("_start")))
    else:
        offsets = offsets.withColumn("_start", F.lit(start).cast("bigint"))
    keyed = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return keyed.select(
        (F.col("_start") + F.col("_offset") + local + 1).cast("bigint").alias(name),
        *[F.col(c) for c in df.columns],
    )
