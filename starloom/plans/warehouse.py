"""The crash warehouse from extract to fact, stage by stage.

Stages hand over through tables only.  A stage raises on failure, so the next
one runs only after success, and every stage can be run again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timedelta
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.columns import concat_key, month_start, normalise_text
from starloom.operators.areas import fill_from_areas
from starloom.operators.categorize import categorize
from starloom.operators.clean import CleanSpec, clean
from starloom.operators.columns import cast_failures, normalize_case
from starloom.operators.dates import date_dim
from starloom.operators.fuzzy import fuzzy_categorize
from starloom.operators.joins import Lookup, lookup_default, resolve_keys, star_join
from starloom.operators.merge import apply_changes, changed_rows, scd2_merge
from starloom.operators.nearest import Axis, fill_from_nearest
from starloom.operators.predicates import where_since
from starloom.operators.quality import (
    DuplicateRule,
    NullRule,
    Rule,
    ValueRule,
    drop_failing,
    error_counts,
    log_errors,
)
from starloom.operators.star import ModelDim, StarModel, dimension_members, star_report
from starloom.operators.versions import VersionLookup
from starloom.plans.crashes import (
    BATCH,
    BRONZE_SCHEMA,
    CRASH_COLUMNS,
    FACT_COLUMNS,
    FACT_SCHEMA,
    FACTOR_SCHEMA,
    LATITUDE_RADIUS,
    LOCATION_SCHEMA,
    LOG_SCHEMA,
    LONGITUDE_RADIUS,
    SILVER_CASTS,
    STREET_COLUMNS,
    STREET_LOCATION_SCHEMA,
    UNKNOWN,
    VEHICLE_SCHEMA,
    CrashWarehouse,
    quality_rules,
    vehicle_map,
)
from starloom.session import drop_intermediates, intermediates, reliable_checkpoint
from starloom.sources.readers import unmarked
from starloom.sources.run_log import RunLog
from starloom.sources.sinks import append, ensure_table, replace_partitions, replace_table
from starloom.streaming.incremental import incremental_load
from starloom.streaming.marks import empty_marks, seed_mark, upsert_mark


def _logged(
    spark: SparkSession, cfg: CrashWarehouse, now: datetime, stage: str, df: DataFrame, writer: Callable
) -> None:
    """Write ``df`` by ``writer``; where runs are logged, with its number of rows."""
    if cfg.runs is None:
        writer(df)
    else:
        RunLog(spark, cfg.runs, now.isoformat()).write(stage, df, writer)


def seed_marks(spark: SparkSession, cfg: CrashWarehouse, now: datetime) -> bool:
    """Give the crash source a mark from data already loaded, if it has none."""
    if not spark.catalog.tableExists(cfg.bronze):
        return False
    known = spark.catalog.tableExists(cfg.marks)
    marks = spark.table(cfg.marks) if known else empty_marks(spark)
    if not marks.where(F.col("table_name") == cfg.bronze).isEmpty():
        return False
    seed = seed_mark(spark.table(cfg.bronze), "crash_date", cfg.bronze, now)
    replace_table(upsert_mark(marks, seed), cfg.marks)
    return True


def extract(
    crashes: DataFrame,
    cfg: CrashWarehouse,
    now: datetime,
    streets: DataFrame | None = None,
    held: DataFrame | None = None,
) -> bool:
    """Append source records above the mark; tells whether crashes came in.

    Marks are days.  The last day loaded is looked at again, and records that
    are there already are skipped, so what is published late is not lost.
    Records whose day cannot be read are kept aside, see ``rejected``.  ``held``
    are the stored records that the new ones may repeat, if that is known.
    """
    spark = crashes.sparkSession
    seed_marks(spark, cfg, now)

    def again(columns):
        return {} if cfg.parity else {"lookback": timedelta(days=1), "key": columns}

    loaded = incremental_load(
        crashes,
        cfg.bronze,
        cfg.marks,
        mark_col="crash_date",
        columns=CRASH_COLUMNS,
        batch_ts=now,
        partition_by=[BATCH],
        held=held,
        write=lambda df, name, by: _logged(spark, cfg, now, "extract", df, lambda d: append(d, name, by)),
        **again(CRASH_COLUMNS),
    )
    replace_table(unmarked(crashes, "crash_date", CRASH_COLUMNS), cfg.unmarked)
    if streets is not None:
        incremental_load(
            streets,
            cfg.streets,
            cfg.street_marks,
            mark_col="crash_date",
            columns=STREET_COLUMNS,
            batch_ts=now,
            **again(STREET_COLUMNS),
        )
    return loaded


def effective_rules(cfg: CrashWarehouse) -> list[Rule]:
    """The rules as they are applied.

    By default the identity of a record leaves out the extraction time, so a
    record extracted twice is logged once, and keys with a NULL count as
    duplicates.  ``cfg.parity`` identifies records by all their columns and
    passes over duplicate keys with a NULL.
    """
    out = []
    rules = cfg.rules
    if rules is None:
        rules = quality_rules("all" if cfg.parity else "any")
    for r in rules:
        if isinstance(r, DuplicateRule):
            out.append(replace(r, null_safe=False) if cfg.parity else r)
        else:
            out.append(r if cfg.parity or r.identity else replace(r, identity=CRASH_COLUMNS))
    return out


def log_quality(spark: SparkSession, cfg: CrashWarehouse, now: datetime) -> None:
    """Append rule violations the log lacks, then rebuild its roll-up."""
    ensure_table(spark, cfg.log, LOG_SCHEMA)
    errors = log_errors(
        spark.table(cfg.bronze),
        effective_rules(cfg),
        spark.table(cfg.log),
        table_name=cfg.bronze,
        now=now,
        keep=("collision_id", "extraction_timestamp"),
        identifier="text" if cfg.parity else "hash",
    )
    _logged(spark, cfg, now, "log", errors, lambda df: append(df, cfg.log))
    counts = error_counts(spark.table(cfg.log), normalize=not cfg.parity)
    replace_table(counts, cfg.log_counts)


def dropping_rules() -> list[Rule]:
    """The rules whose failing rows silver leaves out: those on coordinates."""
    return [
        r
        for r in quality_rules("any")
        if isinstance(r, (NullRule, ValueRule)) and r.columns_checked == "log$lat"
    ]


def rejected(bronze: DataFrame, unread: DataFrame) -> DataFrame:
    """Records with a value that cannot be used, and why, as they came.

    A record may have several reasons.  Those without a collision number or a
    readable day go no further; the others lose the value only.
    """
    reasons = {
        "unreadable value": cast_failures(bronze, SILVER_CASTS),
        "no collision_id": bronze.where("collision_id is null"),
        "unreadable day": unread.withColumn("extraction_timestamp", F.lit(None).cast("string")),
    }
    parts = [df.withColumn("reason", F.lit(why)) for why, df in reasons.items()]
    return reduce(DataFrame.unionByName, parts)


def silver_crashes(bronze: DataFrame, cfg: CrashWarehouse) -> DataFrame:
    """Typed, cleaned crashes, one per collision, with a borough and a month.

    The collision number is part of the duplicate key, so keeping the latest
    row per collision leaves no duplicates either: one shuffle does both.
    Rows without a number are rejects, but for ``parity``, which keeps one.
    """
    usable = bronze if cfg.parity else bronze.where("collision_id is not null")
    cleaned = clean(
        drop_failing(usable, dropping_rules()),
        CleanSpec(
            casts=SILVER_CASTS,
            required=("latitude", "longitude"),
            sentinels={"latitude": 0.0, "longitude": 0.0},
            defaults={"contributing_factor_vehicle_1": UNKNOWN, "vehicle_type_code1": UNKNOWN},
        ),
    )
    if cfg.borough_areas is not None:
        place = ("borough", "longitude", "latitude")
        cleaned = fill_from_areas(cleaned, cfg.borough_areas, *place, cfg.area_cell)
    points = cfg.boroughs.where("longitude is not null and latitude is not null").select(
        "borough", "longitude", "latitude"
    )
    filled = fill_from_nearest(
        cleaned,
        points.toDF("br_borough", "br_longitude", "br_latitude"),
        "borough",
        Axis("latitude", "br_latitude", LATITUDE_RADIUS),
        Axis("longitude", "br_longitude", LONGITUDE_RADIUS),
        ref_label="br_borough",
        tie="br_borough",
        default=UNKNOWN,
        one_per=("collision_id",),
        order=(F.desc("extraction_timestamp"), *CRASH_COLUMNS),
    )
    titled = normalize_case(
        filled, ("borough", "contributing_factor_vehicle_1", "vehicle_type_code1")
    )
    return titled.withColumn("crash_month", month_start("crash_date"))


def transform(spark: SparkSession, cfg: CrashWarehouse, now: datetime) -> None:
    """Log quality errors and unreadable values, then rebuild silver by month."""
    log_quality(spark, cfg, now)
    bronze = spark.table(cfg.bronze)
    if spark.catalog.tableExists(cfg.unmarked):
        unread = spark.table(cfg.unmarked)
    else:
        unread = bronze.select(*CRASH_COLUMNS).limit(0)
    replace_table(rejected(bronze, unread), cfg.rejects, ["reason"])
    silver = silver_crashes(spark.table(cfg.bronze), cfg)
    _logged(spark, cfg, now, "silver", silver, lambda df: replace_table(df, cfg.silver, ["crash_month"]))


def with_streets(silver: DataFrame, streets: DataFrame) -> DataFrame:
    """Silver crashes with a street name, one per collision."""
    named = silver.where("collision_id is not null")
    return lookup_default(
        named,
        streets,
        "collision_id",
        "on_street_name",
        UNKNOWN,
        order=(F.desc("extraction_timestamp"), F.asc_nulls_last("on_street_name")),
        out="street_name",
    )


def location_members(silver: DataFrame, street: bool = False) -> DataFrame:
    """One row per coordinate pair; the choice among its rows is a total order."""
    attrs = {"borough": "borough"} | ({"street_name": "street_name"} if street else {})
    members = dimension_members(silver, ["latitude", "longitude"], attrs, list(attrs))
    return members.withColumn("log_lat", concat_key("latitude", "longitude"))


def vehicle_members(silver: DataFrame, cfg: CrashWarehouse) -> DataFrame:
    """One spelling per vehicle type with its category."""
    members = dimension_members(
        silver.select(F.col("vehicle_type_code1").alias("vehicle_type")),
        ["vehicle_type"],
        {},
        ["vehicle_type"],
        key_expr=normalise_text,
    )
    spellings = cfg.vehicle_spellings
    mapping = vehicle_map(spellings) if isinstance(spellings, DataFrame) else spellings
    sorted_in = fuzzy_categorize if cfg.typing_errors else categorize
    return sorted_in(members, "vehicle_type", mapping, normalize=normalise_text)


def factor_members(silver: DataFrame, cfg: CrashWarehouse) -> DataFrame:
    members = dimension_members(
        silver.select(F.col("contributing_factor_vehicle_1").alias("factor")),
        ["factor"],
        {},
        ["factor"],
        key_expr=normalise_text,
    )
    return categorize(members, "factor", cfg.factor_categories)


def calendar_days(silver: DataFrame, cfg: CrashWarehouse) -> tuple[date, date]:
    """First and last day of the calendar: ``cfg.calendar``, stretched by whole
    years to hold every crash (not under ``parity``), so that no report loses one.
    """
    first, last = cfg.calendar
    day = F.col("crash_date").cast("date")
    low, high = (None, None) if cfg.parity else silver.agg(F.min(day), F.max(day)).first()
    if low is not None:
        first, last = min(first, date(low.year, 1, 1)), max(last, date(high.year, 12, 31))
    return first, last


def dimensions(
    spark: SparkSession,
    cfg: CrashWarehouse,
    now: datetime,
    street: bool = False,
    members: DataFrame | None = None,
    days: tuple[date, date] | None = None,
) -> None:
    """Bring the calendar and all versioned dimensions up to date.

    They need silver's distinct members and its span of days only, which a job
    that keeps count of them hands over as ``members`` and ``days``.
    """
    silver = spark.table(cfg.silver) if members is None else members
    replace_table(date_dim(spark, *(days or calendar_days(silver, cfg))), cfg.dim_date)
    mode = "next_run" if cfg.parity else "same_run"
    safe = not cfg.parity

    def merge(name, schema, source, key, attrs, **options):
        ensure_table(spark, name, schema)
        replace_table(
            scd2_merge(spark.table(name), source, key, attrs, now, reopen=mode, **options), name
        )

    text = {"key_expr": normalise_text, "null_safe": safe}
    place = ["latitude", "longitude", "borough"]
    merge(cfg.dim_location, LOCATION_SCHEMA, location_members(silver), "log_lat", place)
    merge(
        cfg.dim_vehicle,
        VEHICLE_SCHEMA,
        vehicle_members(silver, cfg),
        "vehicle_type",
        ["category"],
        **text,
    )
    merge(
        cfg.dim_factor, FACTOR_SCHEMA, factor_members(silver, cfg), "factor", ["category"], **text
    )
    if street:
        replace_table(
            with_streets(silver, spark.table(cfg.streets)), cfg.silver_street, ["crash_month"]
        )
        merge(
            cfg.dim_location_street,
            STREET_LOCATION_SCHEMA,
            location_members(spark.table(cfg.silver_street), street=True),
            "log_lat",
            [*place, "street_name"],
        )


def crash_lookups(spark: SparkSession, cfg: CrashWarehouse, street: bool = False) -> list[Lookup]:
    """How a crash finds its calendar, factor, vehicle and location rows."""
    location = cfg.dim_location_street if street else cfg.dim_location
    if cfg.fact_versions not in ("current", "on_day"):
        raise ValueError(f"fact_versions must be 'current' or 'on_day', not {cfg.fact_versions!r}")
    if cfg.fact_versions == "on_day":
        member = partial(VersionLookup, day="crash_date", early="first")
    else:
        member = Lookup
    return [
        Lookup(
            spark.table(cfg.dim_date),
            [(F.col("crash_date").cast("date"), F.col("full_date").cast("date"))],
            {"date_key": "date_key", "year": "year"},
            current_only=False,
        ),
        member(
            spark.table(cfg.dim_factor),
            [(normalise_text("contributing_factor_vehicle_1"), normalise_text("factor"))],
            {"factor_key": "surrogate_key"},
        ),
        member(
            spark.table(cfg.dim_vehicle),
            [(normalise_text("vehicle_type_code1"), normalise_text("vehicle_type"))],
            {"vehicle_key": "surrogate_key"},
        ),
        member(
            spark.table(location),
            [(concat_key("latitude", "longitude"), "log_lat")],
            {"location_key": "surrogate_key"},
        ),
    ]


def load_fact(
    spark: SparkSession, cfg: CrashWarehouse, street: bool = False, now: datetime | None = None
) -> None:
    """Resolve the four keys and upsert; the street variant is stored by month.

    Only partitions holding a new or changed fact are rewritten. With ``now`` the
    write can be logged as part of that run.
    """
    name, by = (cfg.fact_street, "crash_month") if street else (cfg.fact, "year")
    ensure_table(spark, name, FACT_SCHEMA, [by])
    silver = spark.table(cfg.silver_street if street else cfg.silver)
    resolved = resolve_keys(silver, crash_lookups(spark, cfg, street)).select(
        "collision_id", *FACT_COLUMNS
    )
    stored = spark.table(name)
    changes = reliable_checkpoint(
        changed_rows(
            stored,
            resolved,
            ["collision_id"],
            FACT_COLUMNS,
            null_safe=not cfg.parity,
            was=[by],
            null_keys="append" if cfg.parity else "match",
        )
    )
    touched = changes.select(by).union(changes.select(f"_was_{by}")).distinct()
    # At most one value per partition; as constants they prune the scan.
    values = [r[0] for r in touched.collect()]
    affected = stored.where(
        F.col(by).isin([v for v in values if v is not None])
        | (F.col(by).isNull() & F.lit(None in values))
    )
    if values:
        rows = apply_changes(affected, changes, ["collision_id"])
        write = partial(replace_partitions, table=name, touched=touched)
        if now is None:
            write(rows)
        else:
            _logged(spark, cfg, now, "fact_street" if street else "fact", rows, write)


def run_pipeline(
    crashes: DataFrame, cfg: CrashWarehouse, now: datetime, streets: DataFrame | None = None
) -> bool:
    """Extract, transform, dimensions, fact; tells whether anything new came in.

    A run without new records still brings later tables up to date, which
    changes nothing when the last run went through.
    """
    spark = crashes.sparkSession
    street = streets is not None
    before = intermediates()
    loaded = extract(crashes, cfg, now, streets)
    if not spark.catalog.tableExists(cfg.bronze):
        ensure_table(spark, cfg.bronze, f"{BRONZE_SCHEMA}, {BATCH} string", [BATCH])
    transform(spark, cfg, now)
    dimensions(spark, cfg, now, street)
    load_fact(spark, cfg, now=now)
    if street:
        load_fact(spark, cfg, street=True, now=now)
    drop_intermediates(spark, since=before)
    return loaded


def crash_report(spark: SparkSession, cfg: CrashWarehouse, by_month: bool = True) -> DataFrame:
    """Crashes by period, factor and vehicle category and borough, each counted once."""
    period = ["year", "month_name"] if by_month else ["year"]
    date, factor, vehicle, location = crash_lookups(spark, cfg)
    lookups = [
        replace(date, take={p: p for p in period}),
        replace(factor, take={"factor_category": "category"}),
        replace(vehicle, take={"vehicle_category": "category"}),
        replace(location, take={"dim_borough": "borough"}),
    ]
    by = [*period, "factor_category", "vehicle_category", "dim_borough"]
    return star_report(
        spark.table(cfg.silver), lookups, by, name="crash_count", order=True
    ).withColumnRenamed("dim_borough", "borough")


def missing_location_keys(spark: SparkSession, cfg: CrashWarehouse, since) -> DataFrame:
    """Facts without a location key among crashes extracted since a day."""
    recent = where_since(spark.table(cfg.silver), "extraction_timestamp", since)
    facts = spark.table(cfg.fact).where("location_key is null")
    return star_join(
        recent.select("collision_id", "borough", "latitude", "longitude"),
        [Lookup(facts, [("collision_id", "collision_id")], {"date_key": "date_key"}, current_only=False)],
    )


def crash_model(spark: SparkSession, cfg: CrashWarehouse) -> StarModel:
    """The curated model over the street variants, versioning columns hidden.

    A column is shown as its dimension and its name in the model, as
    ``Factor_Surrogate_key``: several dimensions use the same names.
    """
    t = spark.table
    scd = {"effective_date", "end_date", "is_current"}

    def shown(name: str, prefix: str, hidden=frozenset()) -> dict[str, str]:
        # Calendar and factors are capitalised, but for the year.
        title = prefix in ("Date", "Factor")
        return {
            f"{prefix}_{c.capitalize() if title and c != 'year' else c}": c
            for c in t(name).columns
            if c not in hidden
        }

    return StarModel(
        fact=t(cfg.fact_street),
        dims={
            "date": ModelDim(
                t(cfg.dim_date), "date_key", "date_key", shown(cfg.dim_date, "Date")
            ),
            "location": ModelDim(
                t(cfg.dim_location_street),
                "location_key",
                "surrogate_key",
                shown(cfg.dim_location_street, "Location"),
            ),
            "vehicle": ModelDim(
                t(cfg.dim_vehicle),
                "vehicle_key",
                "surrogate_key",
                shown(cfg.dim_vehicle, "Vehicle", scd),
            ),
            "factor": ModelDim(
                t(cfg.dim_factor),
                "factor_key",
                "surrogate_key",
                shown(cfg.dim_factor, "Factor", scd),
            ),
        },
        measures={
            "number_of_persons_injured": "number_of_persons_injured",
            "number_of_persons_killed": "number_of_persons_killed",
        },
    )
