"""The crash warehouse kept up to date from its new batches alone.

A run finds the batches (partitions of the source table) that are not in the
ledger yet and writes down their change set: the silver rows that come in and
those they replace. Every later stage takes its work from it:

* log: the new batches, and stored ones that share days with them, for
  duplicates; the log's roll-up is counted again from its last run on only;
* silver: the months of the change set; which months hold an older row of a
  collision is told by each month's range of numbers;
* dimensions: distinct members with their number of rows, kept by adding and
  taking away; a member goes when its last row does;
* fact: the years of the change set, and those of facts whose member was closed.

The change set is a table, each stage can be repeated with it, and its batches
enter the ledger at the end: a run that breaks off is taken up by the next.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.deltas import (
    in_partitions,
    merge_counts,
    partitions_with,
    signed_counts,
    without_keys,
    zones,
)
from starloom.operators.joins import not_in, resolve_keys
from starloom.operators.quality import LOG_KEY, DuplicateRule, error_counts, find_errors
from starloom.plans.crashes import BATCH, FACT_COLUMNS, FACT_SCHEMA, CrashWarehouse
from starloom.plans.warehouse import (
    calendar_days,
    crash_lookups,
    dimensions,
    effective_rules,
    extract,
    rejected,
    run_pipeline,
    silver_crashes,
)
from starloom.session import drop_intermediates, intermediates, reliable_checkpoint
from starloom.sources.readers import mark_value
from starloom.sources.sinks import (
    append,
    ensure_table,
    partition_values,
    replace_partitions,
    replace_table,
)
from starloom.streaming.marks import get_mark

MONTH, YEAR = "crash_month", "year"
MEMBER = ["kind", "latitude", "longitude", "label"]
LEDGER_SCHEMA = "batch string, first_day timestamp, last_day timestamp, done_at timestamp"
#: A row that says what a table holds, not a row of data.
_NOTE = "#"


def run_changes(crashes: DataFrame, cfg: CrashWarehouse, now: datetime) -> bool:
    """Bring the warehouse up to date; tells whether anything new came in.

    The tables are those of ``run_pipeline`` afterwards. The first run is one, and
    writes down what later ones need. Street variants are not part of it. There is
    no ``parity``: its rules look at all records in every run.
    """
    if cfg.parity:
        raise ValueError("parity has no change propagation")
    spark = crashes.sparkSession
    before = intermediates()
    if not spark.catalog.tableExists(cfg.ledger):
        loaded = run_pipeline(crashes, cfg, now)
        _write_down(spark, cfg, now)
    else:
        if _unfinished(spark, cfg):
            _apply(spark, cfg, now)
        loaded = extract(crashes, cfg, now, held=_near(spark, cfg))
        _record(spark, cfg, _pending(spark, cfg))
        _apply(spark, cfg, now)
    drop_intermediates(spark, since=before)
    return loaded


def _pending(spark: SparkSession, cfg: CrashWarehouse) -> list[str]:
    """The batches of the source table that are not in the ledger."""
    done = {r[0] for r in spark.table(cfg.ledger).select("batch").collect()}
    return [b for b in partition_values(spark, cfg.bronze) if b not in done]


def _near(spark: SparkSession, cfg: CrashWarehouse) -> DataFrame:
    """Stored records of the days that a load looks at again."""
    mark = get_mark(spark.table(cfg.marks), cfg.bronze) if spark.catalog.tableExists(cfg.marks) else None
    ledger = spark.table(cfg.ledger)
    if mark is not None:
        ledger = ledger.where(F.col("last_day") >= F.lit(mark - timedelta(days=1)))
    known = [r[0] for r in ledger.select("batch").collect()]
    return in_partitions(spark.table(cfg.bronze), BATCH, [*known, *_pending(spark, cfg)])


def _days(bronze: DataFrame) -> DataFrame:
    day = mark_value(bronze, "crash_date").cast("timestamp")
    return bronze.groupBy(F.col(BATCH).alias("batch")).agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def _member_rows(silver: DataFrame) -> DataFrame:
    """The members that each silver row names."""
    none = F.lit(None).cast("float")
    named = {
        "location": (F.col("latitude"), F.col("longitude"), F.col("borough")),
        "vehicle": (none, none, F.col("vehicle_type_code1")),
        "factor": (none, none, F.col("contributing_factor_vehicle_1")),
    }
    each = [
        F.struct(F.lit(kind).alias("kind"), a.alias("latitude"), b.alias("longitude"), c.alias("label"))
        for kind, (a, b, c) in named.items()
    ]
    return silver.select(F.inline(F.array(*each)))


def _members(counted: DataFrame) -> DataFrame:
    """Counted members in the columns that silver has them in."""

    def of(kind: str) -> Column:
        return F.when(F.col("kind") == kind, F.col("label"))

    return counted.where(F.col("kind") != _NOTE).select(
        "latitude",
        "longitude",
        of("location").alias("borough"),
        of("vehicle").alias("vehicle_type_code1"),
        of("factor").alias("contributing_factor_vehicle_1"),
    )


def _note(spark: SparkSession, label: str | None) -> DataFrame:
    rows = [(_NOTE, None, None, label, 1)]
    return spark.createDataFrame(rows, "kind string, latitude float, longitude float, label string, n bigint")


def _write_down(spark: SparkSession, cfg: CrashWarehouse, now: datetime) -> None:
    """What later runs need, from tables that are up to date; the ledger comes last."""
    silver = spark.table(cfg.silver)
    replace_table(zones(silver, MONTH, "collision_id"), cfg.zones)
    counted = _member_rows(silver).groupBy(*MEMBER).agg(F.count(F.lit(1)).alias("n"))
    replace_table(counted.unionByName(_note(spark, None)), cfg.members)
    ensure_table(spark, cfg.ledger, LEDGER_SCHEMA)
    append(_days(spark.table(cfg.bronze)).withColumn("done_at", F.lit(now)), cfg.ledger)


def _record(spark: SparkSession, cfg: CrashWarehouse, batches: list[str]) -> None:
    """Store the change set of ``batches``; without any it is empty."""
    new = silver_crashes(in_partitions(spark.table(cfg.bronze), BATCH, batches), cfg)
    new = reliable_checkpoint(new)
    ids = new.select("collision_id")
    silver = spark.table(cfg.silver)
    months = partitions_with(ids, spark.table(cfg.zones), MONTH) if batches else []
    old = in_partitions(silver, MONTH, months).join(ids.withColumnRenamed("collision_id", "_id"), F.col("collision_id") == F.col("_id"), "left_semi")
    covered = spark.createDataFrame([(b, _NOTE) for b in batches], "collision_id string, _op string")
    changes = new.withColumn("_op", F.lit("+")).unionByName(old.withColumn("_op", F.lit("-")))
    replace_table(changes.unionByName(covered, allowMissingColumns=True), cfg.changes)


def _covered(spark: SparkSession, cfg: CrashWarehouse) -> list[str]:
    """The batches of the stored change set."""
    notes = spark.table(cfg.changes).where(F.col("_op") == _NOTE)
    return sorted(r[0] for r in notes.select("collision_id").collect())


def _unfinished(spark: SparkSession, cfg: CrashWarehouse) -> bool:
    if not spark.catalog.tableExists(cfg.changes):
        return False
    return bool(set(_covered(spark, cfg)) & set(_pending(spark, cfg)))


def _apply(spark: SparkSession, cfg: CrashWarehouse, now: datetime) -> None:
    """Take the stored change set through all stages."""
    batches = _covered(spark, cfg)
    changes = spark.table(cfg.changes)
    silver_columns = [c for c in changes.columns if c != "_op"]
    added = changes.where("_op = '+'").select(*silver_columns)
    removed = changes.where("_op = '-'").select(*silver_columns)
    _log(spark, cfg, now, batches)
    _reject(spark, cfg, batches)
    if batches:
        _silver(spark, cfg, added, removed)
        _count_members(spark, cfg, added, removed, batches[-1])
    span = spark.table(cfg.zones).select(F.col(MONTH).alias("crash_date"))
    dimensions(spark, cfg, now, members=_members(spark.table(cfg.members)), days=calendar_days(span, cfg))
    _fact(spark, cfg, added, removed)
    if batches:
        done = _days(in_partitions(spark.table(cfg.bronze), BATCH, batches))
        append(done.withColumn("done_at", F.lit(now)), cfg.ledger)


def _log(spark: SparkSession, cfg: CrashWarehouse, now: datetime, batches: list[str]) -> None:
    """Append the errors of ``batches``, and merge the log's end into its roll-up."""
    bronze = spark.table(cfg.bronze)
    batch = in_partitions(bronze, BATCH, batches)
    if batches:
        span = _days(batch).agg(F.min("first_day"), F.max("last_day")).first()
        ledger = spark.table(cfg.ledger).where((F.col("last_day") >= F.lit(span[0])) & (F.col("first_day") <= F.lit(span[1])))
        shared = sorted({*batches, *(r[0] for r in ledger.select("batch").collect())})
        rules = effective_rules(cfg)
        options = {
            "table_name": cfg.bronze,
            "now": now,
            "keep": ("collision_id", BATCH),
            "identifier": "hash",
        }
        alone = [r for r in rules if not isinstance(r, DuplicateRule)]
        twice = [r for r in rules if isinstance(r, DuplicateRule)]
        found = [find_errors(batch, alone, **options)] if alone else []
        found += [find_errors(in_partitions(bronze, BATCH, shared), twice, **options)] if twice else []
        errors = found[0] if len(found) == 1 else found[0].unionByName(found[1])
        logged = in_partitions(spark.table(cfg.log), BATCH, shared).where(F.col("table_name") == cfg.bronze)
        append(reliable_checkpoint(not_in(errors, logged, LOG_KEY)), cfg.log)
    counts = spark.table(cfg.log_counts)
    last = counts.agg(F.max("error_timestamp")).first()[0]
    log = spark.table(cfg.log)
    if last is not None:
        log, counts = log.where(F.col("error_timestamp") >= F.lit(last)), counts.where(F.col("error_timestamp") < F.lit(last))
    replace_table(counts.unionByName(error_counts(log)), cfg.log_counts)


def _reject(spark: SparkSession, cfg: CrashWarehouse, batches: list[str]) -> None:
    """Append what ``batches`` have to reject; unreadable days are those of this run."""
    unread = spark.table(cfg.unmarked)
    batch = in_partitions(spark.table(cfg.bronze), BATCH, batches)
    if batches and in_partitions(spark.table(cfg.rejects), BATCH, batches).isEmpty():
        append(rejected(batch, unread.limit(0)), cfg.rejects)
    days = rejected(batch.limit(0), unread)
    replace_partitions(days, cfg.rejects, spark.createDataFrame([("unreadable day",)], "reason string"))


def _silver(spark: SparkSession, cfg: CrashWarehouse, added: DataFrame, removed: DataFrame) -> None:
    """Rewrite the months of the change set, and their ranges of numbers."""
    silver = spark.table(cfg.silver)
    touched = added.select(MONTH).union(removed.select(MONTH)).distinct()
    months = [r[0] for r in touched.collect()]
    if not months:
        return
    kept = without_keys(in_partitions(silver, MONTH, months), added, ["collision_id"])
    replace_partitions(kept.unionByName(added.select(*silver.columns)), cfg.silver, touched)
    zoned = spark.table(cfg.zones)
    others = zoned.where(~F.coalesce(F.col(MONTH).isin([m for m in months if m is not None]), F.lit(None in months)))
    fresh = zones(in_partitions(spark.table(cfg.silver), MONTH, months), MONTH, "collision_id")
    replace_table(others.unionByName(fresh), cfg.zones)


def _count_members(
    spark: SparkSession, cfg: CrashWarehouse, added: DataFrame, removed: DataFrame, label: str
) -> None:
    """Add the change set to the counted members, once: a note in the table says so."""
    stored = spark.table(cfg.members)
    if not stored.where((F.col("kind") == _NOTE) & (F.col("label") == label)).isEmpty():
        return
    delta = signed_counts(_member_rows(added), _member_rows(removed), MEMBER)
    counted = merge_counts(stored.where(F.col("kind") != _NOTE), delta, MEMBER)
    replace_table(counted.unionByName(_note(spark, label)), cfg.members)


def _fact(spark: SparkSession, cfg: CrashWarehouse, added: DataFrame, removed: DataFrame) -> None:
    """Rewrite the years of the change set, and those with facts of closed members."""
    ensure_table(spark, cfg.fact, FACT_SCHEMA, [YEAR])
    stored = spark.table(cfg.fact)
    lookups = crash_lookups(spark, cfg)
    fresh = reliable_checkpoint(resolve_keys(added, lookups).select("collision_id", *FACT_COLUMNS))
    moved = _moved_keys(spark, cfg)
    years = {r[0] for r in fresh.select(YEAR).distinct().collect()}
    years |= {r[0] for r in removed.select(F.year("crash_date")).distinct().collect()}
    for column, keys in moved.items():
        pointing = stored.join(keys, (F.col(column) == F.col("_was")) & (F.col("date_key") >= F.col("_since")), "left_semi")
        years |= {r[0] for r in pointing.select(YEAR).distinct().collect()}
    if not years:
        return
    kept = without_keys(in_partitions(stored, YEAR, list(years)), fresh, ["collision_id"])
    for column, keys in moved.items():
        meets = (F.col(column) == F.col("_was")) & (F.col("date_key") >= F.col("_since"))
        kept = kept.join(keys, meets, "left").withColumn(column, F.coalesce("_now", column)).select(*stored.columns)
    types = {f.name: f.dataType for f in stored.schema.fields}
    shaped = fresh.select(*[F.col(c).cast(types[c]).alias(c) for c in stored.columns])
    touched = spark.createDataFrame([(y,) for y in years], "year int")
    replace_partitions(kept.unionByName(shaped), cfg.fact, touched)


def _moved_keys(spark: SparkSession, cfg: CrashWarehouse) -> dict[str, DataFrame]:
    """Per key column of the fact ``(_was, _now, _since)``: versions closed since the last
    run that ended, the member's current one, and the day from which it counts.

    Facts point at the current version, or with ``on_day`` at that of their day, so
    there only facts from the closing day on move.
    """
    last = spark.table(cfg.ledger).agg(F.max("done_at")).first()[0]
    out = {}
    for column, name, key in (
        ("factor_key", cfg.dim_factor, "factor"),
        ("vehicle_key", cfg.dim_vehicle, "vehicle_type"),
        ("location_key", cfg.dim_location, "log_lat"),
    ):
        dim = spark.table(name)
        match = F.trim(F.lower(F.col(key)))
        closed = dim.where((F.col("is_current") == 0) & (F.col("end_date") >= F.lit(last))).select(
            match.alias("_key"), F.col("surrogate_key").cast("bigint").alias("_was"), "end_date"
        )
        if closed.isEmpty():
            continue
        current = dim.where("is_current = 1").select(match.alias("_key"), F.col("surrogate_key").cast("bigint").alias("_now"))
        since = F.lit(0)
        if cfg.fact_versions == "on_day":
            midnight = F.col("end_date").cast("date").cast("timestamp") == F.col("end_date")
            first = F.when(midnight, F.col("end_date").cast("date")).otherwise(F.date_add(F.col("end_date").cast("date"), 1))
            since = F.date_format(first, "yyyyMMdd")
        out[column] = closed.join(current, "_key").select("_was", "_now", since.cast("bigint").alias("_since"))
    return out
