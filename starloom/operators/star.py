"""Dimension members, star reports and the curated star model."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.columns import column
from starloom.operators.joins import Lookup, star_join
from starloom.operators.keys import first_per_group


def dimension_members(
    df: DataFrame,
    keys: Sequence[str],
    attrs: Mapping[str, Column | str],
    order: Sequence[str | Column],
    *,
    key_expr: Callable[[Column], Column] = lambda c: c,
) -> DataFrame:
    """One row per (normalised) key with its attributes, keys not null.

    ``order`` picks the surviving spelling and must be total to be repeatable.
    Distinct rows are taken first, so a frequent member is already reduced to a
    few rows per task when the window runs.
    """
    named = {name: column(c) for name, c in attrs.items()}
    rows = (
        df.where(" and ".join(f"`{k}` is not null" for k in keys))
        .select(*keys, *[c.alias(n) for n, c in named.items() if n not in keys])
        .distinct()
    )
    return first_per_group(rows, [key_expr(F.col(k)) for k in keys], order)


#: Facts per key combination from which grouping before a join pays.
REDUCTION = 8


def worth_grouping(fact: DataFrame, keys: Sequence[str], factor: int = REDUCTION) -> bool:
    """Whether there are at least ``factor`` facts per combination of ``keys``, by an
    approximate distinct count; one pass over these columns, one row to the driver."""
    n, groups = fact.agg(
        F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(*keys), 0.05)
    ).first()
    return n >= factor * max(groups, 1)


def star_report(
    fact: DataFrame,
    lookups: Sequence[Lookup],
    by: Sequence[str],
    *,
    large: Sequence[Lookup] = (),
    name: str = "rows",
    order: bool = False,
) -> DataFrame:
    """Fact rows counted by dimension columns.

    Dimensions named in ``large`` may be too big to broadcast.  Before they are
    joined the facts are counted per remaining key if that makes them much
    fewer (see ``worth_grouping``): then what is shuffled is a row per key
    combination.  Otherwise facts are joined as they are, hot keys being left
    to the skew join.
    """
    out = star_join(fact, lookups)
    if large:
        taken = {t for lookup in large for t in lookup.take}
        # Bare fact columns the large lookups match on.
        keys = [f if isinstance(f, str) else None for lookup in large for f in lookup.reads]
        if None in keys:
            raise ValueError("a large lookup must match on plain fact columns")
        kept = list(dict.fromkeys([c for c in by if c not in taken] + keys))
        if worth_grouping(out, kept):
            out = out.groupBy(*kept).agg(F.count(F.lit(1)).alias("_rows"))
        else:
            out = out.select(*kept).withColumn("_rows", F.lit(1).cast("long"))
        out = star_join(out, large).groupBy(*by).agg(F.sum("_rows").alias(name))
    else:
        out = out.groupBy(*by).agg(F.count(F.lit(1)).alias(name))
    return out.orderBy(F.desc(name), *by) if order else out


def label_report(
    fact: DataFrame, dim: DataFrame, fact_label: str, dim_label: str, *, name: str = "rows"
) -> DataFrame:
    """Rows of ``fact ⋈ dim`` on a label that repeats on both sides, per label.

    The join would hold every pair of rows sharing a label.  Both sides are
    counted first and the counts multiplied, which gives the same numbers.
    """
    left = fact.groupBy(F.col(fact_label).alias("_label")).agg(F.count(F.lit(1)).alias("_l"))
    right = dim.groupBy(F.col(dim_label).alias("_label")).agg(F.count(F.lit(1)).alias("_r"))
    return left.join(right, "_label").select(
        F.col("_label").alias(fact_label), (F.col("_l") * F.col("_r")).alias(name)
    )


@dataclass(frozen=True)
class ModelDim:
    """A dimension of the model: which columns show, under which name.

    ``fact_key = dim_key`` is a many-to-one relationship.  ``columns`` maps
    shown names to source columns; ``hidden`` names stay usable in joins but
    are left out of ``StarModel.frame``.
    """

    frame: DataFrame
    fact_key: str
    dim_key: str
    columns: Mapping[str, str]
    hidden: frozenset[str] = frozenset()


@dataclass(frozen=True)
class StarModel:
    """A fact, its dimensions and the default sums over it."""

    fact: DataFrame
    dims: Mapping[str, ModelDim]
    measures: Mapping[str, str] = field(default_factory=dict)
    fact_columns: Mapping[str, str] | None = None

    def _dims_of(self, names: Iterable[str]) -> list[str]:
        wanted = set(names)
        return [d for d, m in self.dims.items() if wanted & set(m.columns)]

    def _joined(self, fact: DataFrame, dims: Iterable[str]) -> DataFrame:
        out = fact
        for d in dims:
            m = self.dims[d]
            shown = m.frame.select(
                F.col(m.dim_key).alias(f"_{d}_key"),
                *[
                    F.col(src).alias(name, metadata={"dimension": d, "source": src})
                    for name, src in m.columns.items()
                ],
            )
            out = out.join(shown, F.col(m.fact_key) == F.col(f"_{d}_key"), "left").drop(f"_{d}_key")
        return out

    def frame(self, dims: Iterable[str] | None = None) -> DataFrame:
        """Facts with the shown columns of ``dims`` (all by default)."""
        dims = list(self.dims if dims is None else dims)
        out = self._joined(self.fact, dims)
        hidden = {c for d in dims for c in self.dims[d].hidden}
        return out.drop(*hidden)

    def report(self, by: Sequence[str], measures: Sequence[str] | None = None) -> DataFrame:
        """Sums by model columns; only the dimensions named in ``by`` are joined.

        The facts are summed per foreign key before the joins where that makes
        them much fewer, see ``worth_grouping``.
        """
        measures = list(measures or self.measures)
        dims = self._dims_of(by)
        of_dims = {c for d in dims for c in self.dims[d].columns}
        fact_by = [c for c in by if c not in of_dims]
        keys = list(dict.fromkeys(fact_by + [self.dims[d].fact_key for d in dims]))
        sums = [F.sum(self.measures[m]).alias(m) for m in measures]
        if dims and not worth_grouping(self.fact, keys):
            facts = self.fact.select(*keys, *[F.col(self.measures[m]).alias(m) for m in measures])
        else:
            facts = self.fact.groupBy(*keys).agg(*sums)
        out = self._joined(facts, dims)
        return out.groupBy(*by).agg(*[F.sum(m).alias(m) for m in measures])
