"""Sources: tables, files, literal rows, and the newer part of a source."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, datetime, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by name, or a parquet path (anything holding a ``/``)."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def read_json(
    spark: SparkSession, path: str, schema: T.StructType | str, *, multiline: bool = True
) -> DataFrame:
    """JSON documents under an explicit schema.

    A multi-line file is parsed by one task; line-delimited files split.
    """
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def records_to_df(
    spark: SparkSession, source: str | Sequence[Any], schema: T.StructType | str
) -> DataFrame:
    """Source records under an explicit schema; missing fields are NULL.

    ``source`` is a folder of landed line-delimited JSON, or a handful of
    literal rows.
    """
    if isinstance(source, str):
        return read_json(spark, source, schema, multiline=False)
    return spark.createDataFrame(source, schema)


def mark_value(df: DataFrame, col: str) -> Column:
    """A mark column as something with an order: ISO text becomes a timestamp."""
    is_text = isinstance(df.schema[col].dataType, T.StringType)
    return F.col(col).try_cast("timestamp") if is_text else F.col(col)


def mark_literal(df: DataFrame, col: str, value: Any) -> Column:
    """``value`` as a constant of the mark's own type, so filters push down."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.StringType):
        kind = T.TimestampType()
    if isinstance(kind, T.TimestampType) and isinstance(value, datetime):
        return F.lit(value)
    text = value.isoformat() if isinstance(value, (date, datetime)) else value
    return F.lit(text).cast(kind)


def incremental_read(
    df: DataFrame,
    mark_col: str,
    last: Any,
    columns: Iterable[str] | None = None,
    *,
    lookback: timedelta | None = None,
) -> DataFrame:
    """Rows strictly newer than ``last``, chosen columns only.

    Text marks are compared as what they parse to, however they are spelled.
    Rows without a readable mark are not newer; ``unmarked`` has them.

    ``lookback`` reaches further back to catch late rows of the last period;
    the caller then has to drop rows it holds already.
    """
    if isinstance(last, str):
        last = datetime.fromisoformat(last)
    if lookback is not None:
        last = last - lookback
    newer = df.where(mark_value(df, mark_col) > mark_literal(df, mark_col, last))
    return newer if columns is None else newer.select(*columns)


def unmarked(df: DataFrame, mark_col: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Rows that no incremental read returns: their mark is NULL or unreadable."""
    out = df.where(mark_value(df, mark_col).isNull())
    return out if columns is None else out.select(*columns)


def stamp_batch(
    df: DataFrame, ts: datetime | str, *, name: str = "extraction_timestamp"
) -> DataFrame:
    """Mark every row of a batch with the one extraction time, as ISO text."""
    text = ts.isoformat() if isinstance(ts, datetime) else ts
    return df.withColumn(name, F.lit(text))
