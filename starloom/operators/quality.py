"""Data-quality rules: log failing rows once, drop them, roll the log up."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.columns import any_of, hash_identifier, text_identifier
from starloom.operators.duplicates import duplicate_rows
from starloom.operators.joins import not_in
from starloom.operators.keys import dedupe
from starloom.operators.predicates import has_value, is_null

LOG_KEY = ("row_identifier", "columns_checked", "error_type")
LOG_COLUMNS = (
    "table_name",
    "error_timestamp",
    "error_type",
    "severity",
    "columns_checked",
    "row_identifier",
    "error_description",
)


@dataclass(frozen=True, kw_only=True)
class Rule:
    """What a failing row is logged as, and how its identity is built.

    ``identity`` names the columns that identify a row; all columns if unset.
    """

    error_type: str
    columns_checked: str
    severity: str
    description: str
    identity: tuple[str, ...] | None = None

    def labels(self) -> list[Column]:
        return [
            F.lit(self.error_type).alias("error_type"),
            F.lit(self.severity).alias("severity"),
            F.lit(self.columns_checked).alias("columns_checked"),
            F.lit(self.description).alias("error_description"),
        ]


@dataclass(frozen=True, kw_only=True)
class NullRule(Rule):
    """Fails where ``columns`` are null, all of them or any."""

    columns: tuple[str, ...]
    how: str = "all"

    def failing(self) -> Column:
        return is_null(self.columns, self.how)


@dataclass(frozen=True, kw_only=True)
class ValueRule(Rule):
    """Fails where the columns hold a value that stands for "missing".

    ``as_type`` reads text columns under another type before comparing.
    """

    values: Mapping[str, Any]
    how: str = "all"
    as_type: str | None = None

    def failing(self) -> Column:
        return has_value(self.values, self.how, as_type=self.as_type)


@dataclass(frozen=True, kw_only=True)
class DuplicateRule(Rule):
    """Fails for every row whose ``keys`` occur more than once."""

    keys: tuple[str, ...]
    null_safe: bool = True


RowRule = NullRule | ValueRule


def _identifier(kind: str, cols: Sequence[str]) -> Column:
    if kind not in ("hash", "text"):
        raise ValueError(f"identifier must be 'hash' or 'text', not {kind!r}")
    return hash_identifier(cols) if kind == "hash" else text_identifier(cols)


def find_errors(
    df: DataFrame,
    rules: Iterable[Rule],
    *,
    table_name: str,
    now: datetime | Column,
    keep: Iterable[str] = (),
    identifier: str = "hash",
) -> DataFrame:
    """One row per failing row and rule.

    All null and value rules share a single scan: each row carries the array of
    rules it fails.  Every duplicate rule adds one grouping of its keys.
    ``identifier="text"`` joins the values with ``-`` instead of hashing them.
    """
    rules, keep = list(rules), list(keep)
    row_rules = [r for r in rules if isinstance(r, RowRule)]
    parts = []
    if row_rules:
        failures = F.array(
            *[
                F.when(
                    r.failing(),
                    F.struct(
                        *r.labels(),
                        _identifier(identifier, r.identity or df.columns).alias("row_identifier"),
                    ),
                )
                for r in row_rules
            ]
        )
        parts.append(
            df.where(any_of(r.failing() for r in row_rules))
            .select(*keep, F.explode(failures).alias("_failed"))
            .where("_failed is not null")
            .select(*keep, "_failed.*")
        )
    for r in rules:
        if isinstance(r, DuplicateRule):
            parts.append(
                duplicate_rows(df, r.keys, null_safe=r.null_safe).select(
                    *keep,
                    *r.labels(),
                    _identifier(identifier, r.identity or r.keys).alias("row_identifier"),
                )
            )
    stamp = now if isinstance(now, Column) else F.lit(now)
    return (
        reduce(DataFrame.unionByName, parts)
        .withColumns({"table_name": F.lit(table_name), "error_timestamp": stamp})
        .select(*LOG_COLUMNS, *keep)
    )


def log_errors(
    df: DataFrame,
    rules: Iterable[Rule],
    log: DataFrame,
    *,
    table_name: str,
    now: datetime | Column,
    keep: Iterable[str] = (),
    identifier: str = "hash",
) -> DataFrame:
    """Errors of ``df`` that ``log`` does not hold yet, ready to append.

    A log may be shared: only what it holds of the same table counts as known.
    """
    rules = list(rules)
    errors = find_errors(
        df, rules, table_name=table_name, now=now, keep=keep, identifier=identifier
    )
    logged = log.where(
        (F.col("table_name") == table_name)
        & F.col("error_type").isin(*{r.error_type for r in rules})
    )
    return not_in(errors, logged, LOG_KEY)


def drop_failing(
    df: DataFrame, rules: Iterable[Rule], *, order: Iterable[str | Column] | None = None
) -> DataFrame:
    """Rows failing no null or value rule, one row kept per duplicate key.

    The same rule objects feed ``log_errors``, so what is dropped is what is
    logged.
    """
    rules = list(rules)
    failing = [r.failing() for r in rules if isinstance(r, RowRule)]
    out = df.where(~any_of(failing)) if failing else df
    for r in rules:
        if isinstance(r, DuplicateRule):
            out = dedupe(out, r.keys, order)
    return out


def error_counts(
    log: DataFrame, *, batch_col: str = "extraction_timestamp", normalize: bool = True
) -> DataFrame:
    """Errors per timestamp, type, columns, severity and extraction day.

    Types that differ only in case fall together; ``normalize=False`` keeps
    them in separate rows although they print alike.
    """
    titled = F.initcap("error_type")
    out = log.groupBy(
        "error_timestamp",
        (titled if normalize else F.col("error_type")).alias("error_type"),
        "columns_checked",
        "severity",
        F.col(batch_col).try_cast("date").alias("extraction_date"),
    ).agg(F.count(F.lit(1)).alias("count"))
    return out if normalize else out.withColumn("error_type", titled)
