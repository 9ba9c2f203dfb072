"""Reference points out of nested feature collections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.columns import column

FEATURE_COLLECTION = """
    features array<struct<
        properties: struct<borough: string>,
        geometry: struct<coordinates: array<array<array<double>>>>>>
"""


def first_vertex(coordinates: Column | str) -> Column:
    """First point of a polygon's outer ring as ``[lon, lat]``, NULL if absent."""
    return F.get(F.get(column(coordinates), F.lit(0)), F.lit(0))


def flatten_features(
    df: DataFrame,
    prop: str = "borough",
    features: str = "features",
    label: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per feature: its label and the first vertex of its polygon."""
    point = first_vertex(F.col("feature.geometry.coordinates"))
    return df.select(*keep, F.explode(features).alias("feature")).select(
        *keep,
        F.col(f"feature.properties.{prop}").alias(label or prop),
        F.get(point, F.lit(0)).alias("longitude"),
        F.get(point, F.lit(1)).alias("latitude"),
    )
