"""Joins on natural, computed and optional keys.

No side is broadcast by hint here: Catalyst and AQE broadcast a side whose
measured size is under the session's threshold and shuffle it otherwise.

A left key holding a third of all rows is split by AQE's skew join, which cuts
a reducer by the map tasks that fed it: the cut is the same after a retry and
works for identical copies too, where a salt computed from the row would not.
AQE does so for inner, left, semi and anti joins whose sides come straight from
a shuffle; ``keys_match`` sees to that where a side was just aggregated.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.columns import all_of, column
from starloom.operators.keys import dedupe


def keys_match(
    left: DataFrame, pairs: Iterable[tuple[str, str]], *, null_safe: bool = False
) -> Column:
    """Equality of key columns, for a right side with one row per key.

    The extra hash is implied by the equality.  As a join key it keeps the
    right side from lending the join the partitioning of its aggregation, with
    which AQE could not split the left side's hot keys; what is shuffled once
    more is one row per key.
    """
    pairs = list(pairs)
    kinds = {f.name: f.dataType for f in left.schema.fields}
    equal = [
        F.col(a).eqNullSafe(F.col(b)) if null_safe else F.col(a) == F.col(b) for a, b in pairs
    ]
    same_hash = F.xxhash64(*[F.col(a) for a, _ in pairs]) == F.xxhash64(
        *[F.col(b).try_cast(kinds[a]) for a, b in pairs]
    )
    return all_of([*equal, same_hash])


def not_in(
    new: DataFrame, known: DataFrame, keys: Iterable[str], *, null_safe: bool = False
) -> DataFrame:
    """Rows of ``new`` whose keys ``known`` lacks; only distinct keys are joined."""
    keys = list(keys)
    seen = known.select(*[F.col(k).alias(f"_known_{k}") for k in keys]).distinct()
    match = keys_match(new, [(k, f"_known_{k}") for k in keys], null_safe=null_safe)
    return new.join(seen, match, "left_anti")


@dataclass(frozen=True)
class Lookup:
    """How a fact finds its row in a dimension.

    ``pairs`` lists ``(fact expression, dimension expression)``; equal pairs
    match.  ``take`` maps output names to dimension columns.  With
    ``current_only`` only rows flagged ``is_current = 1`` take part.
    """

    dim: DataFrame
    pairs: Sequence[tuple[Column | str, Column | str]]
    take: dict[str, str] = field(default_factory=dict)
    current_only: bool = True

    @property
    def reads(self) -> list[Column | str]:
        """What the lookup needs of a fact."""
        return [f for f, _ in self.pairs]

    def prepared(self, tag: str) -> tuple[DataFrame, Column]:
        """The dimension under collision-free names, and the join condition."""
        dim = self.dim.where("is_current = 1") if self.current_only else self.dim
        dim = dim.select(
            *[column(d).alias(f"_{tag}_{i}") for i, (_, d) in enumerate(self.pairs)],
            *[F.col(src).alias(out) for out, src in self.take.items()],
        )
        match = all_of(
            column(f) == F.col(f"_{tag}_{i}") for i, (f, _) in enumerate(self.pairs)
        )
        return dim, match

    def attach(self, fact: DataFrame, tag: str, how: str) -> DataFrame:
        """``fact`` with what the lookup takes."""
        dim, match = self.prepared(tag)
        return fact.join(dim, match, how)


def star_join(fact: DataFrame, lookups: Sequence[Lookup], how: str = "inner") -> DataFrame:
    """Join a fact with its dimensions, keeping fact columns and what each lookup takes."""
    out, names = fact, list(fact.columns)
    for i, lookup in enumerate(lookups):
        names += lookup.take
        out = lookup.attach(out, f"dim{i}", how)
    return out.select(*names)


def resolve_keys(fact: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Add surrogate keys; a fact without a dimension row keeps NULL there."""
    return star_join(fact, lookups, "left")


def lookup_default(
    df: DataFrame,
    ref: DataFrame,
    key: str,
    col: str,
    default: Any,
    *,
    order: Iterable[str | Column] | None = None,
    out: str | None = None,
) -> DataFrame:
    """Bring ``col`` over from ``ref`` by key, or ``default``.

    ``ref`` is cut to one row per key first, so no row of ``df`` multiplies;
    ``order`` decides which one.
    """
    one = dedupe(ref, [key], order).select(F.col(key).alias("_key"), F.col(col).alias("_value"))
    return df.join(one, keys_match(df, [(key, "_key")]), "left").select(
        *[F.col(c) for c in df.columns],
        F.coalesce("_value", F.lit(default)).alias(out or col),
    )


def orphan_rows(fact: DataFrame, dim: DataFrame, fk: str, key: str) -> DataFrame:
    """Fact rows whose foreign key is null or missing from the dimension."""
    known = dim.select(F.col(key).alias("_key")).distinct()
    return fact.join(known, keys_match(fact, [(fk, "_key")]), "left_anti")


def orphan_report(fact: DataFrame, dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Missing foreign-key values and their number of rows, per foreign key.

    Rows are counted per key value before the join, so a value shared by a
    third of the facts is one row there.
    """
    reports = []
    for fk, (dim, key) in dims.items():
        per_key = fact.groupBy(fk).agg(F.count(F.lit(1)).alias("rows"))
        reports.append(
            orphan_rows(per_key, dim, fk, key).select(
                F.lit(fk).alias("foreign_key"), F.col(fk).cast("string").alias("value"), "rows"
            )
        )
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out
