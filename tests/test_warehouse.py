"""The whole job on a handful of records, with the checks its users made by hand."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from starloom.plans.crashes import BRONZE_SCHEMA, STREET_SCHEMA, CrashWarehouse, quality_rules
from starloom.plans.warehouse import (
    calendar_days,
    crash_model,
    crash_report,
    missing_location_keys,
    run_pipeline,
)

DAY1, DAY2 = datetime(2025, 7, 10, 6), datetime(2025, 7, 11, 6)
FULL = "T00:00:00.000"

# id, date, time, borough, lat, lon, injured, killed, factor, vehicle
RECORDS = [
    ("1", "2024-01-05", "9:05", "BRONX", "40.85", "-73.88", "1", "0", "Unsafe Speed", "Sedan"),
    ("2", "2024-01-06", "10:30", None, "40.851", "-73.881", "0", "0", "Glare", "SEDAN"),
    ("3", "2024-02-07", "0:00", None, "41.9", "-70.0", "2", "1", None, "Bus"),
    ("4", "2024-02-08", "25:70", "QUEENS", "40.7", "-73.8", "x", "0", "Unspecified", None),
    ("5", "2024-02-08", "1:00", "QUEENS", None, None, "0", "0", "Glare", "Bus"),
    ("6", "2024-02-08", "1:00", "QUEENS", None, "-73.8", "0", "0", "Glare", "Bus"),
    ("7", "2024-02-08", "1:00", "QUEENS", "0.0000000", "0.0", "0", "0", "Glare", "Bus"),
    ("8", "2025-03-01", "2:00", "QUEENS", "40.7", "-73.8", "0", "0", "Glare", "Bus"),
    ("8", "2025-03-01", "2:00", "QUEENS", "40.7", "-73.8", "0", "0", "Glare", "Bus"),
    ("9", "2022-12-31", "2:00", "QUEENS", "40.7", "-73.8", "0", "0", "Glare", "Bus"),
]
VEHICLES = {"Passenger Vehicles": ["sedan"], "Public Transit": ["bus"], "Other/Unspecified": ["unknown", "sedan"]}


def crashes(spark, records=RECORDS):
    return spark.createDataFrame([(r[0], r[1] + FULL, *r[2:]) for r in records], BRONZE_SCHEMA)


def config(spark, **options):
    boroughs = spark.createDataFrame(
        [("Bronx", -73.88, 40.86), ("Queens", -73.8, 40.7), ("Nowhere", None, None)],
        "borough string, longitude double, latitude double",
    )
    return CrashWarehouse(boroughs=boroughs, vehicle_spellings=VEHICLES, **options)


def state(spark, *tables):
    return {t: sorted(str(r) for r in spark.table(t).collect()) for t in tables}


def streets(spark, *data):
    return spark.createDataFrame(list(data), STREET_SCHEMA)


@pytest.mark.parametrize("parity", [False, True])
def test_pipeline(spark, rows, db, parity):
    cfg = config(spark, parity=parity)
    names = streets(
        spark, ("1", "GRAND AVE", "2024-01-05" + FULL), ("1", "ELM ST", "2024-01-05" + FULL)
    )
    assert run_pipeline(crashes(spark), cfg, DAY1, names) is True

    assert spark.table(cfg.bronze).count() == 9
    assert rows(spark.table(cfg.log).groupBy("error_type", "columns_checked").count())[0:1] == [
        ("Duplicat_check", "crash_date,borough,vehicle_type_code1,collision_id,latitude,longitude,crash_time", 2)
    ]
    per_rule = {(r[0], r[1]): r[2] for r in rows(spark.table(cfg.log).groupBy("error_type", "columns_checked").count())}
    assert per_rule[("NULL_CHECK", "log$lat")] == (1 if parity else 2)
    assert per_rule[("Value_check", "log$lat")] == 1
    assert per_rule[("Null_check", "borough")] == 2
    assert per_rule[("Null_check", "Factor")] == 1
    assert per_rule[("Null_check", "Vehicle_type")] == 1
    assert rows(spark.table(cfg.rejects), "collision_id") == [("4",)]

    silver = spark.table(cfg.silver)
    assert rows(silver, "collision_id", "borough", "crash_time", "vehicle_type_code1", "crash_month") == [
        ("1", "Bronx", "09:05:00", "Sedan", date(2024, 1, 1)),
        ("2", "Bronx", "10:30:00", "Sedan", date(2024, 1, 1)),
        ("3", "Unknown", "00:00:00", "Bus", date(2024, 2, 1)),
        ("4", "Queens", None, "Unknown", date(2024, 2, 1)),
        ("8", "Queens", "02:00:00", "Bus", date(2025, 3, 1)),
    ]
    assert silver.where("latitude = 0 and longitude = 0").isEmpty()
    assert silver.groupBy("collision_id").count().where("count > 1").isEmpty()

    assert rows(spark.table(cfg.dim_vehicle), "vehicle_type", "category", "surrogate_key") == [
        ("Bus", "Public Transit", 1),
        ("Sedan", "Passenger Vehicles", 2),
        ("Unknown", "Other/Unspecified", 3),
    ]
    assert rows(spark.table(cfg.dim_factor), "factor", "category") == [
        ("Glare", "Environmental Factors"),
        ("Unknown", "Other/Unspecified"),
        ("Unsafe Speed", "Driver Behavior"),
        ("Unspecified", "Other/Unspecified"),
    ]
    assert spark.table(cfg.dim_location).where("surrogate_key is null").isEmpty()
    assert spark.table(cfg.dim_location).count() == 4

    fact = spark.table(cfg.fact)
    assert rows(fact, "collision_id", "date_key", "number_of_persons_injured", "year") == [
        ("1", 20240105, 1, 2024),
        ("2", 20240106, 0, 2024),
        ("3", 20240207, 2, 2024),
        ("4", 20240208, None, 2024),
        ("8", 20250301, 0, 2025),
    ]
    keys = ["date_key", "factor_key", "vehicle_key", "location_key"]
    assert fact.where(" or ".join(f"{k} is null" for k in keys)).isEmpty()
    assert missing_location_keys(spark, cfg, date(2025, 7, 10)).isEmpty()

    named = rows(spark.table(cfg.dim_location_street), "street_name")
    assert named == [("ELM ST",), ("Unknown",), ("Unknown",), ("Unknown",)]
    assert rows(crash_report(spark, cfg, by_month=False), "year", "borough", "crash_count") == [
        (2024, "Bronx", 1),
        (2024, "Bronx", 1),
        (2024, "Queens", 1),
        (2024, "Unknown", 1),
        (2025, "Queens", 1),
    ]
    report = crash_model(spark, cfg).report(["Date_year"])
    assert rows(report) == [(2024, 3, 1), (2025, 0, 0)]

    # Nothing new: nothing moves, apart from the batch-free rebuild of silver.
    tables = [cfg.bronze, cfg.marks, cfg.log, cfg.silver, cfg.dim_location, cfg.dim_vehicle,
              cfg.dim_factor, cfg.dim_location_street, cfg.fact, cfg.fact_street]
    before = state(spark, *tables)
    assert run_pipeline(crashes(spark), cfg, DAY2, names) is False
    assert state(spark, *tables) == before


def test_second_batch_changes_only_what_it_touches(spark, rows, db):
    cfg = config(spark)
    run_pipeline(crashes(spark), cfg, DAY1)
    old_files = set(spark.table(cfg.fact).where("year = 2024").inputFiles())
    more = [*RECORDS, ("10", "2025-04-01", "3:00", "BRONX", "40.85", "-73.88", "0", "0", "Texting", "Tram")]
    assert run_pipeline(crashes(spark, more), cfg, DAY2) is True
    assert spark.table(cfg.fact).count() == 6
    assert set(spark.table(cfg.fact).where("year = 2024").inputFiles()) == old_files
    added = spark.table(cfg.dim_vehicle).where(F.col("effective_date") == F.lit(DAY2))
    assert rows(added, "surrogate_key", "vehicle_type", "category") == [(4, "Tram", "Uncategorized")]
    assert rows(spark.table(cfg.marks), "last_watermark") == [(datetime(2025, 4, 1),)]


def test_changed_category_moves_facts_to_the_new_version(spark, rows, db):
    run_pipeline(crashes(spark), config(spark), DAY1)
    recut = CrashWarehouse(
        boroughs=config(spark).boroughs,
        vehicle_spellings=spark.createDataFrame(
            [("sedan", "Other/Unspecified"), ("sedan", "Commercial Vehicles"), ("bus", "Public Transit"), ("unknown", "Other/Unspecified")],
            "value string, category string",
        ),
    )
    run_pipeline(crashes(spark), recut, DAY2)
    assert rows(spark.table(recut.dim_vehicle).where("vehicle_type = 'Sedan'"), "surrogate_key", "category", "is_current") == [
        (2, "Passenger Vehicles", 0),
        (4, "Commercial Vehicles", 1),
    ]
    assert rows(spark.table(recut.fact).where("vehicle_key = 4"), "collision_id") == [("1",), ("2",)]
    assert spark.table(recut.fact).count() == 5


ODD = [
    *RECORDS,
    ("51", "2025-03-01", "1:00", "QUEENS", None, "-73.8", "0", "0", "Glare", "Bus"),
    ("52", "2025-03-01", "1:00", "QUEENS", "0.0", "-73.8", "0", "0", "Glare", "Bus"),
    ("53", "not a date", "1:00", "QUEENS", "40.7", "-73.8", "0", "0", "Glare", "Bus"),
    (None, "2025-03-01", "1:00", "QUEENS", "40.7", "-73.8", "0", "0", "Glare", "Bus"),
    (None, "2025-03-01", "2:00", "QUEENS", "40.7", "-73.8", "0", "0", "Glare", "Bus"),
    ("54", " 2025-03-01", "1:00", "QUEENS", "40.7", "-73.8", "0", "0", "Glare", "Bus"),
]


def test_every_record_is_somewhere(spark, db):
    """Bronze and unreadable days = silver + rejects + logged drops + surplus copies."""
    cfg = config(spark)
    run_pipeline(crashes(spark, ODD), cfg, DAY1)
    ids = lambda df: sorted(str(r.collision_id) for r in df.select("collision_id").collect())
    silver = ids(spark.table(cfg.silver))
    dropped = ids(
        spark.table(cfg.log).where("error_type in ('NULL_CHECK', 'Value_check')").select("collision_id").distinct()
    )
    rejects = spark.table(cfg.rejects)
    gone = ids(rejects.where("reason <> 'unreadable value'"))
    assert dropped == ["5", "51", "52", "6", "7"] and gone == ["53", "None", "None"]
    surplus = ["8"]  # an exact copy, logged as a duplicate
    assert sorted(silver + dropped + gone + surplus) == sorted(
        ids(spark.table(cfg.bronze)) + ids(spark.table(cfg.unmarked))
    )
    assert "54" in silver and ids(rejects.where("reason = 'unreadable value'")) == ["4"]


def test_late_records_come_in_and_three_runs_change_nothing(spark, db):
    cfg = config(spark)
    run_pipeline(crashes(spark, ODD), cfg, DAY1)
    late = [*ODD, ("60", "2025-03-01", "3:00", "QUEENS", "40.7", "-73.8", "0", "0", "Glare", "Bus")]
    assert run_pipeline(crashes(spark, late), cfg, DAY2) is True
    assert spark.table(cfg.fact).where("collision_id = '60'").count() == 1
    tables = [cfg.bronze, cfg.marks, cfg.rejects, cfg.fact]
    before = state(spark, *tables)
    for _ in range(2):
        assert run_pipeline(crashes(spark, late), cfg, DAY2) is False
        assert state(spark, *tables) == before


def test_one_missing_coordinate_can_be_logged(spark, db):
    cfg = config(spark, rules=quality_rules(coordinates="any"))
    run_pipeline(crashes(spark), cfg, DAY1)
    logged = spark.table(cfg.log).where("error_type = 'NULL_CHECK'")
    assert sorted(r.collision_id for r in logged.collect()) == ["5", "6"]


def test_empty_source(spark, db):
    cfg = config(spark)
    assert run_pipeline(crashes(spark, []), cfg, DAY1) is False
    for name in (cfg.bronze, cfg.log, cfg.silver, cfg.dim_location, cfg.fact):
        assert spark.table(name).isEmpty()
    assert run_pipeline(crashes(spark), cfg, DAY2) is True
    assert spark.table(cfg.fact).count() == 5


def test_calendar_holds_every_crash(spark, db):
    cfg = config(spark)
    days = spark.createDataFrame([("2009-12-31",), ("2031-02-03",), (None,)], "crash_date string")
    assert calendar_days(days, cfg) == (date(2009, 1, 1), date(2031, 12, 31))
    assert calendar_days(days.limit(0), cfg) == cfg.calendar
    assert calendar_days(days, config(spark, parity=True)) == cfg.calendar


def test_writes_are_logged_with_their_rows(spark, rows, db):
    cfg = config(spark, runs="runs")
    run_pipeline(crashes(spark, ODD), cfg, DAY1)
    run_pipeline(crashes(spark, ODD), cfg, DAY2)
    logged = spark.table("runs")
    assert logged.where("status <> 'done'").isEmpty()
    first = dict(rows(logged.where(F.col("run") == DAY1.isoformat()), "stage", "rows"))
    held = {"extract": cfg.bronze, "log": cfg.log, "silver": cfg.silver, "fact": cfg.fact}
    assert first == {stage: spark.table(name).count() for stage, name in held.items()}
    again = dict(rows(logged.where(F.col("run") == DAY2.isoformat()), "stage", "rows"))
    assert again == {"log": 0, "silver": first["silver"]}  # nothing came in, no fact changed
