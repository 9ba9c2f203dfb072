"""Settings of the road-crash warehouse: schemas, rules, lists, constants.

All names are defaults; every stage takes them from a ``CrashWarehouse``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.columns import clock_text, iso_date
from starloom.operators.quality import DuplicateRule, NullRule, Rule, ValueRule

# The columns a crash record is read with.
CRASH_COLUMNS = (
    "collision_id",
    "crash_date",
    "crash_time",
    "borough",
    "latitude",
    "longitude",
    "number_of_persons_injured",
    "number_of_persons_killed",
    "contributing_factor_vehicle_1",
    "vehicle_type_code1",
)
STREET_COLUMNS = ("collision_id", "on_street_name", "crash_date")

BRONZE_SCHEMA = ", ".join(f"{c} string" for c in CRASH_COLUMNS)
STREET_SCHEMA = ", ".join(f"{c} string" for c in STREET_COLUMNS)

#: A batch of records is a partition of the source table.
BATCH = "extraction_timestamp"

LOG_SCHEMA = """
    table_name string, error_timestamp timestamp, error_type string, severity string,
    columns_checked string, row_identifier string, error_description string,
    collision_id string, extraction_timestamp string
"""
LOCATION_SCHEMA = """
    surrogate_key bigint, log_lat string, latitude double, longitude double, borough string,
    effective_date timestamp, end_date timestamp, is_current int
"""
STREET_LOCATION_SCHEMA = """
    surrogate_key bigint, log_lat string, latitude double, longitude double, street_name string,
    borough string, effective_date timestamp, end_date timestamp, is_current int
"""
VEHICLE_SCHEMA = """
    surrogate_key bigint, vehicle_type string, category string,
    effective_date timestamp, end_date timestamp, is_current int
"""
FACTOR_SCHEMA = """
    surrogate_key int, factor string, category string,
    effective_date timestamp, end_date timestamp, is_current int
"""
FACT_SCHEMA = """
    collision_id string, date_key bigint, factor_key bigint, vehicle_key bigint,
    location_key bigint, number_of_persons_injured int, number_of_persons_killed int,
    crash_month date, year int
"""
FACT_COLUMNS = (
    "date_key",
    "factor_key",
    "vehicle_key",
    "location_key",
    "number_of_persons_injured",
    "number_of_persons_killed",
    "crash_month",
    "year",
)

DUPLICATE_KEY = (
    "crash_date",
    "borough",
    "vehicle_type_code1",
    "collision_id",
    "latitude",
    "longitude",
    "crash_time",
)

SILVER_CASTS = {
    "crash_time": clock_text,
    "extraction_timestamp": lambda c: F.try_to_timestamp(F.col(c)),
    "crash_date": iso_date,
    "number_of_persons_injured": "int",
    "number_of_persons_killed": "int",
    "latitude": "float",
    "longitude": "float",
}

# Band radii around a reference point, in degrees.
LATITUDE_RADIUS = 0.072
LONGITUDE_RADIUS = 0.095

UNKNOWN = "Unknown"


def quality_rules(coordinates: str = "any") -> tuple[Rule, ...]:
    """The checks a crash record goes through.

    Records with one coordinate missing are dropped from silver and logged;
    with ``coordinates="all"`` they are dropped all the same but only those
    lacking both are logged.
    """
    # Labels as existing logs spell them.
    return (
        NullRule(
            error_type="NULL_CHECK",
            columns_checked="log$lat",
            severity="High",
            description="Nulls found in log & lat",
            columns=("latitude", "longitude"),
            how=coordinates,
        ),
        ValueRule(
            error_type="Value_check",
            columns_checked="log$lat",
            severity="High",
            description="Invalid log and lat",
            values={"latitude": 0.0, "longitude": 0.0},
            how=coordinates,
            as_type="double",
        ),
        NullRule(
            error_type="Null_check",
            columns_checked="borough",
            severity="Meduim",
            description="Nulls found in borough",
            columns=("borough",),
        ),
        DuplicateRule(
            error_type="Duplicat_check",
            columns_checked=",".join(DUPLICATE_KEY),
            severity="Low",
            description="Duplicate record found",
            keys=DUPLICATE_KEY,
        ),
        NullRule(
            error_type="Null_check",
            columns_checked="Factor",
            severity="Meduim",
            description="Nulls found in factor&vehicle",
            columns=("contributing_factor_vehicle_1",),
        ),
        NullRule(
            error_type="Null_check",
            columns_checked="Vehicle_type",
            severity="Meduim",
            description="Nulls found in factor&vehicle",
            columns=("vehicle_type_code1",),
        ),
    )


# Contributing factors, in the title case the silver table holds.
FACTOR_CATEGORIES: Mapping[str, Sequence[str]] = {
    "Driver Behavior": (
        "Following Too Closely",
        "Failure To Yield Right-of-way",
        "Fatigued/drowsy",
        "Using On Board Navigation Device",
        "Aggressive Driving/road Rage",
        "Unsafe Speed",
        "Driver Inexperience",
        "Eating Or Drinking",
        "Illnes",
        "Drugs (illegal)",
        "Cell Phone (hand-held)",
        "Prescription Medication",
        "Lost Consciousness",
        "Fell Asleep",
        "Outside Car Distraction",
        "Passing Or Lane Usage Improper",
        "Reaction To Uninvolved Vehicle",
        "Pedestrian/bicyclist/other Pedestrian Error/confusion",
        "Unsafe Lane Changing",
        "Passenger Distraction",
        "Alcohol Involvement",
        "Driver Inattention/distraction",
        "Backing Unsafely",
        "Failure To Keep Right",
        "Turning Improperly",
        "Passing Too Closely",
        "Physical Disability",
        "Texting",
        "Listening/using Headphones",
    ),
    "Vehicle Issues": (
        "Accelerator Defective",
        "Tow Hitch Defective",
        "Tire Failure/inadequate",
        "Brakes Defective",
        "Headlights Defective",
        "Steering Failure",
        "Windshield Inadequate",
        "Other Lighting Defects",
        "Tinted Windows",
        "Oversized Vehicle",
        "Driverless/runaway Vehicle",
    ),
    "Environmental Factors": (
        "Lane Marking Improper/inadequate",
        "Pavement Defective",
        "Obstruction/debris",
        "Pavement Slippery",
        "Glare",
        "Shoulders Defective/improper",
        "Traffic Control Device Improper/non-working",
    ),
    "External Factors": ("Vehicle Vandalism", "Animals Action"),
    "Other/Unspecified": ("Unspecified", "Unknown", "Other Vehicular", "Other Electronic Device"),
}

# The vehicle categories in order of precedence.  Their spellings
# run to several hundred and are supplied as a table, see CrashWarehouse.
VEHICLE_CATEGORY_ORDER = (
    "Passenger Vehicles",
    "Commercial Vehicles",
    "Emergency Vehicles",
    "Public Transit",
    "Two-Wheeled Vehicles",
    "Heavy Machinery",
    "Other/Unspecified",
)


def vehicle_map(spellings: DataFrame) -> DataFrame:
    """``(value, category)`` rows as the ranked map ``categorize`` takes.

    A spelling listed under several categories goes to the earliest one.
    """
    rank = F.array_position(
        F.array(*[F.lit(c) for c in VEHICLE_CATEGORY_ORDER]), F.col("category")
    )
    return spellings.select("value", "category", rank.alias("rank"))


def read_spellings(spark: SparkSession, path: str) -> DataFrame:
    """``(value, category)`` from a JSON file ``{category: [spelling, ...]}``.

    The list that stands for vehicles is data of several hundred entries, so it is
    kept in a file beside the job and not in this library.
    """
    whole = spark.read.text(path, wholetext=True).select(
        F.from_json("value", "map<string, array<string>>").alias("lists")
    )
    return whole.select(F.explode("lists").alias("category", "values")).select(
        F.explode("values").alias("value"), "category"
    )


@dataclass(frozen=True)
class CrashWarehouse:
    """Table names, inputs and choices of one warehouse.

    ``boroughs`` holds the reference points ``(borough, longitude, latitude)``.
    ``vehicle_spellings`` holds ``(value, category)`` in lower case; or a
    mapping of category to spellings.  ``parity`` keeps the looser readings of
    the original jobs where they differ from the defaults: text identifiers in
    the error log, only records lacking both coordinates logged, two-run
    versioning, change tests that ignore NULLs, loads that never look back, and
    records without a collision number, which by default are rejected.

    ``fact_versions`` says which version of a member a fact points at: the
    ``current`` one, to which old facts move when a member changes, or the one
    that held ``on_day`` of the crash (before a member's first version: the first).

    With ``borough_areas``, polygons ``(area, rings)``, a missing borough is that of
    the area the crash lies in, and of the nearest reference point outside all.

    ``runs`` names a table that gets a row per write of a run, see ``RunLog``.

    With ``typing_errors`` a vehicle that is not listed gets the category of the
    listed spelling one or two edits away.
    """

    boroughs: DataFrame
    vehicle_spellings: DataFrame | Mapping[str, Sequence[str]]
    factor_categories: Mapping[str, Sequence[str]] = field(
        default_factory=lambda: FACTOR_CATEGORIES
    )
    rules: Sequence[Rule] | None = None
    bronze: str = "crashes"
    streets: str = "street_name"
    marks: str = "extraction_watermark"
    street_marks: str = "extraction_watermark_street"
    log: str = "fact_error_event"
    log_counts: str = "error_counts"
    rejects: str = "rejected_crashes"
    unmarked: str = "unreadable_crashes"
    silver: str = "silver_crashes"
    silver_street: str = "silver_crashes_street"
    dim_date: str = "dim_date"
    dim_factor: str = "dim_factor"
    dim_vehicle: str = "dim_vehicle"
    dim_location: str = "dim_location"
    dim_location_street: str = "dim_location_street"
    fact: str = "fact_crashes"
    fact_street: str = "fact_crashes_street"
    changes: str = "silver_changes"
    ledger: str = "propagated_batches"
    zones: str = "silver_zones"
    members: str = "silver_members"
    calendar: tuple[date, date] = (date(2010, 1, 1), date(2030, 12, 31))
    parity: bool = False
    fact_versions: str = "current"
    typing_errors: bool = False
    borough_areas: DataFrame | None = None
    area_cell: float = 0.01
    runs: str | None = None
