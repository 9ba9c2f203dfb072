"""Repeated keys and the rows behind them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.columns import all_of
from starloom.operators.joins import keys_match
from starloom.session import reliable_checkpoint


def duplicate_keys(df: DataFrame, keys: Iterable[str], *, name: str = "count") -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)


def duplicate_rows(df: DataFrame, keys: Iterable[str], *, null_safe: bool = True) -> DataFrame:
    """All rows whose key occurs more than once.

    With ``null_safe`` two NULLs count as equal, as GROUP BY treats them;
    without it a key holding a NULL yields no row.

    Copies are counted within the tasks before the shuffle.  The repeated keys are
    stored, so that their size is known before the rows are read for the join: if
    they are few they are broadcast and the rows are not shuffled, else AQE is free
    to split a key that many rows share.
    """
    keys = list(keys)
    repeated = duplicate_keys(df, keys, name="_copies")
    if not null_safe:
        repeated = repeated.where(all_of(F.col(k).isNotNull() for k in keys))
    repeated = reliable_checkpoint(repeated.select(*[F.col(k).alias(f"_dup_{k}") for k in keys]))
    match = keys_match(df, [(k, f"_dup_{k}") for k in keys], null_safe=null_safe)
    return df.join(repeated, match, "left_semi")
