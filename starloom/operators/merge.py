"""Slowly-changing dimensions and upserts as joins.

Plain parquet tables have no MERGE, so each operator returns the table's next
state; ``sources.sinks`` swaps it in.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.columns import all_of, any_of
from starloom.operators.keys import assign_keys, max_key

SCD_COLUMNS = ("effective_date", "end_date", "is_current")


def _same(c: Column) -> Column:
    return c


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` unchanged; the job fails when a non-null key repeats.

    The check runs inside the plan on the hash layout a following join on the
    same keys needs anyway: no extra job, no extra shuffle.
    """
    window = Window.partitionBy(*keys).orderBy(*keys)
    message = F.lit(f"source rows repeat a merge key ({', '.join(keys)})")
    single = F.when(
        (F.col("_seen") > 1) & all_of(F.col(k).isNotNull() for k in keys),
        F.raise_error(message).cast("boolean"),
    ).otherwise(F.lit(True))
    return df.withColumn("_seen", F.row_number().over(window)).where(single).drop("_seen")


def _changed(cols: Iterable[str], old: str, new: str, null_safe: bool) -> Column:
    """Whether any column differs; without ``null_safe`` a NULL never differs."""
    tests = []
    for c in cols:
        o, n = F.col(f"{old}{c}"), F.col(f"{new}{c}")
        tests.append(~o.eqNullSafe(n) if null_safe else F.coalesce(o != n, F.lit(False)))
    return any_of(tests)


def scd2_merge(
    dim: DataFrame,
    source: DataFrame,
    key: str,
    attrs: Sequence[str],
    now: datetime | Column,
    *,
    key_expr: Callable[[Column], Column] = _same,
    null_safe: bool = True,
    reopen: str = "same_run",
    surrogate: str = "surrogate_key",
) -> DataFrame:
    """Next state of a versioned dimension.

    ``dim`` holds the surrogate, ``key``, ``attrs`` and the columns
    ``effective_date, end_date, is_current``; ``source`` holds one row per key.
    A member whose attributes changed is closed at ``now``; unknown members
    are added.  ``key_expr`` is applied to the key on both sides.

    ``reopen="same_run"`` adds the new version of a closed member at once and
    numbers only added rows.  ``reopen="next_run"`` behaves like a two-branch
    MERGE: the new version appears in the following run, and every source
    member takes a number, so surrogate keys have gaps.

    Closed history is passed through untouched; the added rows are written
    once and their size decides how the rows they close are found.
    """
    if reopen not in ("same_run", "next_run"):
        raise ValueError(f"reopen must be 'same_run' or 'next_run', not {reopen!r}")
    stamp = now if isinstance(now, Column) else F.lit(now)
    types = {f.name: f.dataType for f in dim.schema.fields}
    columns = [key, *attrs]

    current = dim.where("is_current = 1")
    history = dim.where("not (is_current <=> 1)")
    old = current.select(
        key_expr(F.col(key)).alias("_old_key"),
        F.lit(True).alias("_old"),
        *[F.col(a).alias(f"_old_{a}") for a in attrs],
    )
    members = source.select(*columns).withColumn("_match", key_expr(F.col(key)))
    members = require_unique(members, ["_match"])
    start, by = max_key(dim, surrogate), ["_match", key]

    def compared(frame: DataFrame) -> DataFrame:
        return frame.join(old, F.col("_match") == F.col("_old_key"), "left").withColumn(
            "_changed", F.col("_old").isNotNull() & _changed(attrs, "_old_", "", null_safe)
        )

    if reopen == "same_run":
        differing = compared(members).where(F.col("_old").isNull() | F.col("_changed"))
        added = assign_keys(
            differing.select("_match", "_changed", *columns), by, start=start, name=surrogate
        )
        closing = added.where("_changed").select("_match")
    else:
        numbered = compared(assign_keys(members, by, start=start, name=surrogate))
        added = numbered.where(F.col("_old").isNull())
        closing = numbered.where("_changed").select("_match")

    closing = closing.select(F.col("_match").alias("_closing"))
    kept = current.join(closing, key_expr(F.col(key)) == F.col("_closing"), "left")
    closed = F.col("_closing").isNotNull()
    kept = kept.withColumns(
        {
            "end_date": F.when(closed, stamp.cast(types["end_date"])).otherwise(F.col("end_date")),
            "is_current": F.when(closed, F.lit(0)).otherwise(F.col("is_current")).cast(
                types["is_current"]
            ),
        }
    )
    fresh = added.withColumns(
        {
            "effective_date": stamp.cast(types["effective_date"]),
            "end_date": F.lit(None).cast(types["end_date"]),
            "is_current": F.lit(1).cast(types["is_current"]),
        }
    )
    shaped = fresh.select(*[F.col(c).cast(types[c]).alias(c) for c in dim.columns])
    return history.unionByName(kept.select(*dim.columns)).unionByName(shaped)


def empty_dim(
    spark, key: str, attrs: dict[str, str], *, surrogate: str = "surrogate_key", surrogate_type="bigint"
) -> DataFrame:
    """An empty versioned dimension to merge the first members into."""
    fields = [f"{surrogate} {surrogate_type}", f"{key} string"]
    fields += [f"{a} {t}" for a, t in attrs.items()]
    fields += ["effective_date timestamp", "end_date timestamp", "is_current int"]
    return spark.createDataFrame([], ", ".join(fields))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    *,
    null_safe: bool = True,
    null_keys: str = "match",
) -> DataFrame:
    """Next state of ``target``: matched rows that differ take the source values,
    unmatched source rows are added.

    Without ``null_safe`` the change test is plain ``!=``: a NULL on either
    side never counts as a change, so a NULL is never repaired.  A repeated
    source key fails the job.

    Rows with a NULL key can match nothing by key.  They skip the join, which
    would otherwise send all of them to one task.  By default one is added only
    if the target has no equal row without a key (as often), so that a repeated
    upsert changes nothing; ``null_keys="append"`` adds them every time.
    """
    keys, cols = list(keys), list(cols)
    source = source.select(*keys, *cols)
    keyed = all_of(F.col(k).isNotNull() for k in keys)
    types = {f.name: f.dataType for f in target.schema.fields}

    new = require_unique(source.where(keyed), keys).select(
        *[F.col(c).alias(f"_new_{c}") for c in keys + cols], F.lit(True).alias("_new")
    )
    old = target.where(keyed).withColumn("_old", F.lit(True))
    both = old.join(new, all_of(F.col(k) == F.col(f"_new_{k}") for k in keys), "full_outer")
    take = F.col("_new").isNotNull()
    if not null_safe:
        take &= F.col("_old").isNull() | _changed(cols, "", "_new_", null_safe=False)

    def value(c: str) -> Column:
        if c in keys:
            out = F.coalesce(F.col(c), F.col(f"_new_{c}").cast(types[c]))
        elif c in cols:
            out = F.when(take, F.col(f"_new_{c}").cast(types[c])).otherwise(F.col(c))
        else:
            out = F.col(c)
        return out.alias(c)

    def shaped(frame: DataFrame) -> DataFrame:
        return frame.select(
            *[
                (F.col(c) if c in frame.columns else F.lit(None)).cast(types[c]).alias(c)
                for c in target.columns
            ]
        )

    return (
        both.select(*[value(c) for c in target.columns])
        .unionByName(target.where(~keyed))
        .unionByName(shaped(_unkeyed(target, source, keyed, [*keys, *cols], null_keys)))
    )


def _unkeyed(
    target: DataFrame, source: DataFrame, keyed: Column, cols: Sequence[str], null_keys: str
) -> DataFrame:
    """Source rows without a key that are to be added."""
    if null_keys not in ("match", "append"):
        raise ValueError(f"null_keys must be 'match' or 'append', not {null_keys!r}")
    new = source.where(~keyed).select(*cols)
    if null_keys == "append":
        return new
    kinds = {f.name: f.dataType for f in target.schema.fields}
    typed = new.select(*[F.col(c).cast(kinds[c]).alias(c) for c in cols])
    return typed.exceptAll(target.where(~keyed).select(*cols))


def changed_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    *,
    null_safe: bool = True,
    was: Sequence[str] = (),
    null_keys: str = "match",
) -> DataFrame:
    """The source rows an ``upsert`` would add or take over.

    ``was`` columns carry the target's old values as ``_was_<name>``: a change
    may move a row to another partition, and both have to be rewritten.
    """
    keys, cols = list(keys), list(cols)
    source = source.select(*keys, *cols)
    keyed = all_of(F.col(k).isNotNull() for k in keys)
    carried = [F.col(f"_old_{c}").alias(f"_was_{c}") for c in was]
    kinds = {f.name: f.dataType for f in target.schema.fields}

    old = target.select(*[F.col(c).alias(f"_old_{c}") for c in dict.fromkeys([*keys, *cols, *was])])
    old = old.withColumn("_old", F.lit(True))
    new = require_unique(source.where(keyed), keys)
    both = new.join(old, all_of(F.col(k) == F.col(f"_old_{k}") for k in keys), "left")
    changed = both.where(F.col("_old").isNull() | _changed(cols, "_old_", "", null_safe)).select(
        *keys, *cols, *carried
    )
    # As in upsert, rows with a NULL key match nothing and skip the join.
    unkeyed = _unkeyed(target, source, keyed, [*keys, *cols], null_keys).withColumns(
        {f"_was_{c}": F.lit(None).cast(kinds[c]) for c in was}
    )
    return changed.unionByName(unkeyed)


def apply_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` with the rows of ``changes`` in place of those under the same keys.

    A key that the target held twice, as an interrupted write may leave it, is
    among the changes twice and comes out once.
    """
    replaced = changes.select(*[F.col(k).alias(f"_new_{k}") for k in keys])
    kept = target.join(replaced, all_of(F.col(k) == F.col(f"_new_{k}") for k in keys), "left_anti")
    types = {f.name: f.dataType for f in target.schema.fields}
    keyed = all_of(F.col(k).isNotNull() for k in keys)
    new = changes.select(*[F.col(c).cast(types[c]).alias(c) for c in target.columns])
    return kept.unionByName(new.where(keyed).dropDuplicates(list(keys))).unionByName(new.where(~keyed))
