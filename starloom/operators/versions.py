"""Point-in-time lookups: facts find the version of a member valid on their day."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.columns import all_of, column
from starloom.operators.joins import Lookup, keys_match


@dataclass(frozen=True)
class VersionLookup(Lookup):
    """How a fact finds the version of its dimension row that held on ``day``.

    That is the version that began last among those with ``start <= day``, if it
    has not ended by then (``day < end``; no end: still open).  A member's versions
    are taken not to overlap.  Facts older than the member's first version find
    none, or with ``early="first"`` that one.  ``current_only`` has no meaning here.

    The join is on the key and a stretch of ``bucket_days`` days.  Each stretch
    that some fact asks for gets the versions that begin in it and the one carried
    in from before, so a fact meets these few and not all versions of its member.
    A member that holds a third of all facts has one row per stretch on the small
    side, and AQE can split its facts as in any other lookup.
    """

    day: Column | str = ""
    start: str = "effective_date"
    end: str = "end_date"
    early: str = "none"
    bucket_days: int = 32

    @property
    def reads(self) -> list[Column | str]:
        return [*super().reads, self.day]

    def attach(self, fact: DataFrame, tag: str, how: str) -> DataFrame:
        if self.early not in ("none", "first"):
            raise ValueError(f"early must be 'none' or 'first', not {self.early!r}")
        kind = self.dim.schema[self.start].dataType
        keys = [f"_{tag}_{i}" for i in range(len(self.pairs))]
        day, bucket = F.col(f"_{tag}_day"), f"_{tag}_bucket"

        def stretch(c: Column) -> Column:
            return F.floor(F.unix_date(c.cast("date")) / F.lit(self.bucket_days))

        asking = fact.withColumns({k: column(f) for k, (f, _) in zip(keys, self.pairs)})
        asking = asking.withColumn(f"_{tag}_day", column(self.day).cast(kind))
        asking = asking.withColumn(bucket, stretch(day))
        asked = asking.where(all_of(F.col(c).isNotNull() for c in [*keys, bucket]))
        asked = asked.select(*keys, bucket).distinct().withColumn("asked", F.lit(True))

        begins = F.coalesce(F.col(self.start), F.lit("0001-01-01").cast(kind))
        ends = F.coalesce(F.col(self.end), F.lit("9999-12-31").cast(kind))
        version = F.struct(
            begins.alias("begins"),
            ends.alias("ends"),
            *[F.col(src).alias(f"take_{out}") for out, src in self.take.items()],
        )
        versions = self.dim.select(
            *[column(d).alias(k) for k, (_, d) in zip(keys, self.pairs)], version.alias("version")
        ).where(all_of(F.col(k).isNotNull() for k in keys))
        inside = (
            versions.withColumn(bucket, stretch(F.col("version.begins")))
            .groupBy(*keys, bucket)
            .agg(F.sort_array(F.collect_list("version")).alias("inside"))
        )
        # One row per member and stretch, whatever the number of its facts.
        line = asked.join(inside, [*keys, bucket], "full_outer")
        order = Window.partitionBy(*keys).orderBy(bucket)
        latest, earliest = F.element_at("inside", -1), F.get("inside", F.lit(0))
        line = line.select(
            *[F.col(c) for c in [*keys, bucket]],
            "asked",
            "inside",
            F.last(latest, ignorenulls=True)
            .over(order.rowsBetween(Window.unboundedPreceding, -1))
            .alias("carried"),
            F.first(earliest, ignorenulls=True)
            .over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
            .alias("first"),
        ).where("asked")
        offered = line.select(
            *[F.col(c).alias(f"{c}_of") for c in [*keys, bucket]],
            F.filter(
                F.concat(F.array("carried"), F.coalesce("inside", F.array(F.lit(None)))),
                lambda v: v.isNotNull(),
            ).alias(f"_{tag}_offered"),
            F.col("first").alias(f"_{tag}_first"),
        )
        met = asking.join(
            offered, keys_match(asking, [(c, f"{c}_of") for c in [*keys, bucket]]), "left"
        )
        begun = F.filter(F.col(f"_{tag}_offered"), lambda v: v["begins"] <= day)
        last = F.when(F.size(begun) > 0, F.element_at(begun, -1))
        if self.early == "first":
            first = F.col(f"_{tag}_first")
            last = F.coalesce(last, F.when(day < first["begins"], first))
            holds = (last["ends"] > day) | (day < first["begins"])
        else:
            holds = last["ends"] > day
        met = met.withColumn(f"_{tag}_held", F.when(holds, last))
        if how == "inner":
            met = met.where(F.col(f"_{tag}_held").isNotNull())
        return met.select(
            *fact.columns,
            *[F.col(f"_{tag}_held.take_{out}").alias(out) for out in self.take],
        )
