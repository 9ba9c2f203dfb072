"""Runs that look at new batches only leave what full runs leave."""

from datetime import datetime
from urllib.parse import unquote, urlparse

import pytest
from pyspark.sql import functions as F
from test_warehouse import RECORDS, VEHICLES, config, crashes, state

from starloom.operators.deltas import merge_counts, partitions_with, signed_counts, without_keys, zones
from starloom.plans import changes as c
from starloom.plans.changes import run_changes
from starloom.plans.warehouse import run_pipeline

TIMES = [datetime(2025, 7, d, 6) for d in range(10, 20)]
LOADS = [
    RECORDS,
    # a correction that moves to another month and place, a copy of an old key, a new member, a bad value
    [
        ("1", "2025-03-02", "9:05", "QUEENS", "40.71", "-73.81", "1", "0", "Texting", "Tram"),
        ("8", "2025-03-01", "2:00", "QUEENS", "40.7", "-73.8", "5", "0", "Texting", "Bus"),
        ("20", "2025-04-01", "x", None, "40.85", "-73.88", "0", "y", None, None),
        ("21", "2025-04-01", "1:00", "QUEENS", None, "-73.8", "0", "0", "Glare", "Bus"),
    ],
    [],
    # the borough of a place that an older row names as well; a record late by hours
    [
        ("22", "2025-04-01", "1:00", "ASTORIA", "40.7", "-73.8", "0", "0", "Glare", "Bus"),
        ("23", "bad day", "1:00", "ASTORIA", "40.7", "-73.8", "0", "0", "Glare", "Bus"),
        (None, "2025-04-02", "1:00", "ASTORIA", "40.7", "-73.8", "0", "0", "Glare", "Bus"),
    ],
    # the row that named it goes, and with it the only row of its member
    [("22", "2026-01-01", "1:00", "BRONX", "40.85", "-73.88", "0", "0", "Unsafe Speed", "Sedan")],
]


def tables(cfg):
    return [cfg.bronze, cfg.log, cfg.log_counts, cfg.rejects, cfg.silver, cfg.dim_date, cfg.dim_location, cfg.dim_vehicle, cfg.dim_factor, cfg.fact]


def config_of(spark, load, **options):
    cfg = config(spark, **options)
    if load < 3:
        return cfg
    # from the fourth load on another cut of the categories, which closes members
    from dataclasses import replace

    return replace(cfg, vehicle_spellings=VEHICLES | {"Two-Wheeled Vehicles": ["tram"], "Public Transit": []})


def source(spark, upto):
    return crashes(spark, [r for load in LOADS[: upto + 1] for r in load])


@pytest.mark.parametrize("versions, loads", [("current", (0, 1, 2, 3, 4)), ("on_day", (0, 3))])
def test_as_full_runs(spark, db, versions, loads):
    states = {}
    for run in (run_pipeline, run_changes):
        name = f"{db}_{run.__name__}"
        spark.sql(f"CREATE DATABASE {name}")
        spark.catalog.setCurrentDatabase(name)
        try:
            states[run] = []
            for k in loads:
                cfg = config_of(spark, k, fact_versions=versions)
                came = run(source(spark, k), cfg, TIMES[k])
                states[run].append((came, state(spark, *tables(cfg))))
        finally:
            spark.catalog.setCurrentDatabase(db)
            spark.sql(f"DROP DATABASE {name} CASCADE")
    for k, (full, part) in enumerate(zip(states[run_pipeline], states[run_changes], strict=True)):
        assert full[0] == part[0], k
        for t in full[1]:
            assert full[1][t] == part[1][t], (k, t)


def test_nothing_else_is_read(spark, db):
    """Files of batches and partitions that a run has no business with may be unreadable."""
    cfg = config(spark)
    run_changes(source(spark, 0), cfg, TIMES[0])
    later = [("90", "2025-06-01", "1:00", "QUEENS", "40.7", "-73.8", "0", "0", "Glare", "Bus")]
    run_changes(crashes(spark, [*RECORDS, *later]), cfg, TIMES[1])
    facts = spark.table(cfg.fact).count()

    spoilt = 0
    for name, old in ((cfg.bronze, f"extraction_timestamp = '{TIMES[0].isoformat()}'"), (cfg.silver, "crash_month < '2025-03-01'"), (cfg.fact, "year < 2025")):
        for file in spark.table(name).where(old).inputFiles():
            with open(unquote(urlparse(file).path), "wb") as out:
                out.write(b"no parquet")
            spoilt += 1
    assert spoilt > 4
    latest = [("91", "2025-06-01", "2:00", "BRONX", "40.85", "-73.88", "0", "0", "Glare", "Bus")]
    assert run_changes(crashes(spark, [*RECORDS, *later, *latest]), cfg, TIMES[2]) is True
    assert spark.table(cfg.fact).where("year = 2025").count() == 3 and facts == 6
    assert spark.table(cfg.silver).where("crash_month = '2025-06-01'").count() == 2


@pytest.mark.parametrize("stage", ["_count_members"])
def test_a_run_that_breaks_off_is_taken_up(spark, db, monkeypatch, stage):
    """Whatever stage fails, before or after its work, the next run ends as if none had."""
    cfg = config(spark)
    run_changes(source(spark, 0), cfg, TIMES[0])
    plain = getattr(c, stage)

    def broken(*args, **options):
        plain(*args, **options)
        raise RuntimeError("lost")

    monkeypatch.setattr(c, stage, broken)
    with pytest.raises(RuntimeError):
        run_changes(source(spark, 1), cfg, TIMES[1])
    monkeypatch.undo()
    run_changes(source(spark, 3), cfg, TIMES[2])
    assert spark.table(cfg.changes).where("_op = '#'").count() == 1
    silver, fact = spark.table(cfg.silver), spark.table(cfg.fact)
    expected = {"1", "2", "3", "4", "8", "20", "22"}
    assert sorted(r.collision_id for r in silver.collect()) == sorted(expected)
    assert sorted(r.collision_id for r in fact.collect()) == sorted(expected)
    assert fact.where("location_key is null or vehicle_key is null or factor_key is null").isEmpty()
    counted = spark.table(cfg.members).where("kind <> '#'")
    assert sorted(map(str, counted.collect())) == sorted(
        map(str, c._member_rows(silver).groupBy(*c.MEMBER).count().withColumnRenamed("count", "n").collect())
    )
    log = spark.table(cfg.log)
    assert log.count() == log.select("collision_id", "error_type", "columns_checked", "extraction_timestamp", "row_identifier").distinct().count() + 1
    total = spark.table(cfg.log_counts).agg(F.sum("count")).first()[0]
    assert total == log.count()


def test_counts_go_up_and_down(spark, rows):
    stored = spark.createDataFrame([("a", 2), ("b", 1), (None, 1)], "k string, n long")
    plus = spark.createDataFrame([("a",), ("c",), (None,)], "k string")
    minus = spark.createDataFrame([("b",), ("c",), ("a",)], "k string")
    merged = merge_counts(stored, signed_counts(plus, minus, ["k"]), ["k"])
    assert rows(merged) == [(None, 2), ("a", 2)]


def test_zones_name_every_partition_that_may_hold_a_key(spark):
    df = spark.createDataFrame([("x", "3"), ("x", "5"), ("y", "7"), (None, "4")], "p string, k string")
    keys = spark.createDataFrame([("4",), ("9",), (None,)], "k string")
    assert set(partitions_with(keys, zones(df, "p", "k"), "p")) == {"x", None}
    assert without_keys(df, keys, ["k"]).count() == 3


def test_parity_is_refused(spark, db):
    with pytest.raises(ValueError):
        run_changes(source(spark, 0), config(spark, parity=True), TIMES[0])
