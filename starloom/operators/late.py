"""Facts that arrive before their dimension members: they wait, or get a stand-in."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.columns import all_of
from starloom.operators.joins import Lookup, keys_match, not_in, resolve_keys
from starloom.operators.keys import assign_keys, max_key
from starloom.operators.merge import require_unique
from starloom.session import reliable_checkpoint
from starloom.sources.sinks import append, ensure_table, replace_table

INFERRED = "is_inferred"


def resolve_or_wait(facts: DataFrame, lookups: Sequence[Lookup]) -> tuple[DataFrame, DataFrame]:
    """Facts with all their keys, and, as they came, those that lack a member."""
    taken = [name for lookup in lookups for name in lookup.take]
    resolved = reliable_checkpoint(resolve_keys(facts, lookups))
    whole = all_of(F.col(name).isNotNull() for name in taken)
    return resolved.where(whole), resolved.where(~whole).select(*facts.columns)


def load_or_wait(
    facts: DataFrame, lookups: Sequence[Lookup], table: str, waiting: str, keys: Sequence[str]
) -> int:
    """Append facts whose members are there; keep the others in ``waiting`` and try
    them again with the next load. Tells how many wait.

    ``keys`` identify a fact and are not NULL. Of a fact that waits and comes again
    the new row counts. What ``table`` holds already is not added again, so a load
    that broke off after the append, before ``waiting`` was replaced, is repeated
    without harm: no fact is lost and none comes twice.
    """
    spark = facts.sparkSession
    every = require_unique(facts, keys)
    if spark.catalog.tableExists(waiting):
        again = not_in(spark.table(waiting), facts, keys)
        every = every.unionByName(again)
    ready, late = resolve_or_wait(every, lookups)
    if spark.catalog.tableExists(table):
        held = spark.table(table)
        ready, late = not_in(ready, held, keys), not_in(late, held, keys)
    # Both are fixed before the first write: the table is read by the second.
    ready, late = reliable_checkpoint(ready), reliable_checkpoint(late)
    ensure_table(spark, table, ready.schema)
    append(ready, table)
    replace_table(late, waiting)
    return late.count()


def infer_members(
    dim: DataFrame,
    facts: DataFrame,
    fact_key: Column | str,
    key: str,
    now: datetime,
    defaults: Mapping[str, Any],
    *,
    surrogate: str = "surrogate_key",
) -> DataFrame:
    """``dim`` with a stand-in for every key that facts name and no current row has.

    A stand-in has the ``defaults`` for its attributes, a surrogate key of its own,
    and ``is_inferred`` 1; facts can point at it at once. ``dim`` has this column,
    and the columns of a versioned dimension. NULL keys get none.
    """
    types = {f.name: f.dataType for f in dim.schema.fields}
    named = facts.select((F.col(fact_key) if isinstance(fact_key, str) else fact_key).cast(types[key]).alias(key))
    named = named.where(F.col(key).isNotNull()).distinct()
    missing = not_in(named, dim.where("is_current = 1"), [key])
    added = assign_keys(missing, [key], start=max_key(dim, surrogate), name=surrogate)
    values = {
        **{a: F.lit(v) for a, v in defaults.items()},
        "effective_date": F.lit(now),
        "end_date": F.lit(None),
        "is_current": F.lit(1),
        INFERRED: F.lit(1),
    }
    shaped = [values.get(c, F.col(c) if c in added.columns else F.lit(None)) for c in dim.columns]
    return dim.unionByName(added.select(*[v.cast(types[c]).alias(c) for v, c in zip(shaped, dim.columns)]))


def adopt_members(dim: DataFrame, source: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """``dim`` with stand-ins turned into the members that have arrived.

    They keep their surrogate keys, so facts that point at them need no change.
    Other rows, and stand-ins that ``source`` (a row per key) lacks, stay as they
    are; new and changed members are the matter of ``scd2_merge`` afterwards.
    """
    types = {f.name: f.dataType for f in dim.schema.fields}
    waits = (F.col(INFERRED) == 1) & (F.col("is_current") == 1)
    standing, others = dim.where(waits), dim.where(~F.coalesce(waits, F.lit(False)))
    new = require_unique(source.select(key, *attrs), [key]).select(
        F.col(key).alias("_key"), F.lit(True).alias("_came"), *[F.col(a).alias(f"_new_{a}") for a in attrs]
    )
    met = standing.join(new, keys_match(standing, [(key, "_key")]), "left")
    came = F.col("_came").isNotNull()

    def value(c: str) -> Column:
        if c in attrs:
            return F.when(came, F.col(f"_new_{c}").cast(types[c])).otherwise(F.col(c))
        if c == INFERRED:
            return F.when(came, F.lit(0)).otherwise(F.col(c)).cast(types[c])
        return F.col(c)

    return others.unionByName(met.select(*[value(c).alias(c) for c in dim.columns]))
