"""Column-shaping operators: project, annotate, cast, fill, coalesce."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.columns import any_of

Cast = str | Callable[[str], Column]

NUMERIC = (T.IntegerType, T.LongType, T.DoubleType, T.FloatType, T.DecimalType)


def project(
    df: DataFrame,
    keep: Iterable[str] | None = None,
    drop: Iterable[str] = (),
    rename: Mapping[str, str] | None = None,
) -> DataFrame:
    """Choose, leave out and rename columns in one select."""
    rename = rename or {}
    leave = set(drop)
    names = [c for c in (keep if keep is not None else df.columns) if c not in leave]
    return df.select(*[F.col(c).alias(rename.get(c, c)) for c in names])


def annotate(df: DataFrame, constants: Mapping[str, Any]) -> DataFrame:
    """Add constant columns; a Column value is used as it is."""
    return df.withColumns(
        {k: v if isinstance(v, Column) else F.lit(v) for k, v in constants.items()}
    )


def _converted(name: str, how: Cast) -> Column:
    return F.col(name).try_cast(how) if isinstance(how, str) else how(name)


def cast_schema(df: DataFrame, spec: Mapping[str, Cast]) -> DataFrame:
    """Convert columns by type name or by parser; malformed values become NULL."""
    return df.withColumns({c: _converted(c, how) for c, how in spec.items()})


def cast_failures(df: DataFrame, spec: Mapping[str, Cast]) -> DataFrame:
    """Rows holding a value that ``cast_schema`` turns into NULL, as they came."""
    return df.where(
        any_of(F.col(c).isNotNull() & _converted(c, how).isNull() for c, how in spec.items())
    )


def fill(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    return df.fillna(dict(defaults))


def coalesce_into(df: DataFrame, out: str, *cols: str) -> DataFrame:
    """First non-null of ``cols`` as ``out``."""
    return df.withColumn(out, F.coalesce(*[F.col(c) for c in cols]))


def columns_of_type(df: DataFrame, types: tuple[type, ...] = NUMERIC) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def normalize_case(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Title-case text; only spaces start a new word."""
    return df.withColumns({c: F.initcap(F.col(c)) for c in cols})
