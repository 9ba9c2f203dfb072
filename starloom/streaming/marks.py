"""High-water marks: how far each source has been loaded.

The state is a table ``(table_name, last_watermark, updated_at)`` with one row
per source.  These are batch load marks, not event-time watermarks.
"""

from __future__ import annotations

from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.sources.readers import mark_value

MARK_SCHEMA = "table_name string, last_watermark timestamp, updated_at timestamp"
# Fixed value: where loading starts when a source has no mark yet.
DEFAULT_MARK = datetime(2023, 1, 1)


def empty_marks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], MARK_SCHEMA)


def get_mark(marks: DataFrame, source: str, default: Any = DEFAULT_MARK) -> Any:
    """The source's mark, or ``default``; only this one value reaches the driver."""
    found = marks.where(F.col("table_name") == source).agg(F.max("last_watermark")).first()[0]
    return default if found is None else found


def _mark_row(df: DataFrame, value: Column, source: str | Column, now: datetime) -> DataFrame:
    if isinstance(source, Column):
        marks = df.groupBy(source.alias("table_name")).agg(value.alias("last_watermark"))
    else:
        marks = df.agg(value.alias("last_watermark")).withColumn("table_name", F.lit(source))
    return marks.select("table_name", "last_watermark", F.lit(now).alias("updated_at"))


def seed_mark(df: DataFrame, col: str, source: str | Column, now: datetime) -> DataFrame:
    """A first mark from data already loaded: midnight of its last day.

    ``source`` is the source's name, or a column that tells the rows of many
    sources apart, each of which gets a mark in one pass.
    """
    return _mark_row(df, F.max(mark_value(df, col)).cast("date").cast("timestamp"), source, now)


def next_mark(batch: DataFrame, col: str, source: str | Column, now: datetime) -> DataFrame:
    """The mark after a batch, its largest value; ``source`` as in ``seed_mark``."""
    return _mark_row(batch, F.max(mark_value(batch, col)).cast("timestamp"), source, now)


def upsert_mark(marks: DataFrame, new: DataFrame) -> DataFrame:
    """``marks`` with the rows of ``new`` in place of those of the same source."""
    return marks.join(new.select("table_name"), "table_name", "left_anti").unionByName(
        new.select(*marks.columns)
    )
