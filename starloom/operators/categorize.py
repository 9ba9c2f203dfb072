"""Group free text into categories by value lists."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.columns import column
from starloom.operators.joins import keys_match
from starloom.operators.keys import first_per_group


def category_column(
    col: Column | str,
    lists: Mapping[str, Iterable[str]],
    *,
    normalize: Callable[[Column], Column] | None = None,
    default: str = "Uncategorized",
) -> Column:
    """Category of a value; the first list naming it wins.

    Each list becomes one hash-set test inside the projection: no join.
    """
    value = column(col)
    if normalize is not None:
        value = normalize(value)
    chosen = F.lit(default)
    for category, values in reversed(list(lists.items())):
        chosen = F.when(value.isin(*values), F.lit(category)).otherwise(chosen)
    return chosen


def categorize(
    df: DataFrame,
    col: str,
    mapping: Mapping[str, Iterable[str]] | DataFrame,
    *,
    out: str = "category",
    normalize: Callable[[Column], Column] | None = None,
    default: str = "Uncategorized",
) -> DataFrame:
    """Add the category of ``col``.

    ``mapping`` is either ``{category: values}`` in order of precedence, or a
    table ``(value, category, rank)`` whose lowest rank wins; Spark broadcasts
    the table when it is small and shuffles otherwise.
    """
    if not isinstance(mapping, DataFrame):
        return df.withColumn(
            out, category_column(col, mapping, normalize=normalize, default=default)
        )
    value = F.col(col) if normalize is None else normalize(F.col(col))
    ranked = first_per_group(mapping, ["value"], ["rank", "category"]).select(
        F.col("value").alias("_value"), F.col("category").alias("_category")
    )
    keyed = df.withColumn("_text", value)
    match = keys_match(keyed, [("_text", "_value")])
    return keyed.join(ranked, match, "left").select(
        *[F.col(c) for c in df.columns],
        F.coalesce("_category", F.lit(default)).alias(out),
    )
