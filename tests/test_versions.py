"""Facts keep the version of a member that held on their day."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from test_skew import N, executed, skewed  # noqa: F401
from test_warehouse import DAY1, RECORDS, config, crashes

from starloom.operators.joins import resolve_keys
from starloom.operators.versions import VersionLookup
from starloom.plans.crashes import CrashWarehouse
from starloom.plans.warehouse import crash_report, run_pipeline


def at(month, day=1, hour=0):
    return datetime(2024, month, day, hour)


VERSIONS = [
    ("a", 1, at(1), at(3)),
    ("a", 2, at(3), at(3)),  # opened and closed at once
    ("a", 3, at(3), at(5)),
    ("a", 4, at(6), None),  # after a gap
    ("b", 5, None, at(2)),
    ("c", 6, at(4, 10, 12), None),
    (None, 7, at(1), None),
]


@pytest.mark.parametrize("early", ["none", "first"])
@pytest.mark.parametrize("days", [1, 32, 5000])
def test_version_on_the_day(spark, rows, early, days):
    dim = spark.createDataFrame(VERSIONS, "name string, key int, since timestamp, till timestamp")
    facts = [(n, d) for n in ("a", "b", "c", "z", None) for d in (*(date(2024, m, 1) for m in range(1, 9)), date(2023, 1, 1), date(2024, 4, 10), None)]
    df = spark.createDataFrame([(*f, "x") for f in facts * 2], "name string, day date, begins string")
    got = resolve_keys(df, [VersionLookup(dim, [("name", "name")], {"found": "key"}, day="day", start="since", end="till", early=early, bucket_days=days)])
    assert got.columns == ["name", "day", "begins", "found"]

    def brute(name, day):
        if name is None or day is None:
            return None
        moment = datetime(day.year, day.month, day.day)
        own = [v for v in VERSIONS if v[0] == name]
        begun = [v for v in own if (v[2] or datetime.min) <= moment]
        if not begun:
            return min(own, key=lambda v: v[2])[1] if own and early == "first" else None
        last = max(begun, key=lambda v: (v[2] or datetime.min, v[3] or datetime.max))
        return last[1] if last[3] is None or moment < last[3] else None

    assert rows(got, "name", "day", "found") == sorted(
        [(n, d, brute(n, d)) for n, d in facts * 2], key=lambda r: tuple((v is not None, str(v)) for v in r)
    )


def test_times_of_day_count(spark, rows):
    dim = spark.createDataFrame(VERSIONS, "name string, key int, since timestamp, till timestamp")
    df = spark.createDataFrame([("c", at(4, 10, 11)), ("c", at(4, 10, 12))], "name string, t timestamp")
    got = resolve_keys(df, [VersionLookup(dim, [("name", "name")], {"k": "key"}, day="t", start="since", end="till")])
    assert rows(got, "k") == [(None,), (6,)]


def test_empty_sides(spark):
    dim = spark.createDataFrame(VERSIONS, "name string, key int, since timestamp, till timestamp")
    df = spark.createDataFrame([("a", date(2024, 1, 1))], "name string, day date")
    look = lambda d: [VersionLookup(d, [("name", "name")], {"k": "key"}, day="day", start="since", end="till")]
    assert [tuple(r) for r in resolve_keys(df, look(dim.limit(0))).collect()] == [("a", date(2024, 1, 1), None)]
    assert resolve_keys(df.limit(0), look(dim)).count() == 0


def test_a_hot_member_is_split_and_meets_few_versions(spark, skewed):  # noqa: F811
    """A third of all facts has one key, which has hundreds of versions."""
    facts = skewed.withColumn("day", F.expr("date_add(date'2020-01-01', cast(crc32(payload) % 700 as int))"))
    dim = spark.range(700).selectExpr(
        "1 as member", "id as key", "date_add(date'2020-01-01', cast(id as int)) as since",
        "if(id = 699, null, date_add(date'2020-01-02', cast(id as int))) as till",
    )
    look = VersionLookup(dim, [("k", "member")], {"key": "key"}, day="day", start="since", end="till", bucket_days=400)
    got = resolve_keys(facts, [look])
    right = got.where("k = 1 and key = datediff(day, date'2020-01-01') or k <> 1 and key is null")
    count, plan = executed(got)
    assert count == N == right.count() and "skew=true" in plan


def test_old_facts_keep_their_version(spark, rows, db):
    """A category changes; crashes before it stay with the old version, later ones do not."""
    options = {"fact_versions": "on_day"}
    run_pipeline(crashes(spark), config(spark, **options), DAY1)
    recut = CrashWarehouse(
        boroughs=config(spark).boroughs,
        vehicle_spellings={"Commercial Vehicles": ["sedan"], "Public Transit": ["bus"]},
        **options,
    )
    change = datetime(2025, 7, 20)
    late = ("70", "2025-07-25", "1:00", "QUEENS", "40.7", "-73.8", "0", "0", "Glare", "Sedan")
    between = ("71", "2025-07-15", "1:00", "QUEENS", "40.7", "-73.8", "0", "0", "Glare", "Sedan")
    run_pipeline(crashes(spark, [*RECORDS, late, between]), recut, change)
    keys = {r.collision_id: r.vehicle_key for r in spark.table(recut.fact).collect()}
    versions = {r.surrogate_key: r.category for r in spark.table(recut.dim_vehicle).collect()}
    assert {k: versions[keys[k]] for k in ("1", "2", "71", "70")} == {
        "1": "Passenger Vehicles", "2": "Passenger Vehicles", "71": "Passenger Vehicles", "70": "Commercial Vehicles",
    }
    report = crash_report(spark, recut, by_month=False).groupBy("vehicle_category").sum("crash_count")
    assert dict(map(tuple, report.collect()))["Passenger Vehicles"] == 3


def test_unknown_choices_are_refused(spark, db):
    with pytest.raises(ValueError):
        run_pipeline(crashes(spark), config(spark, fact_versions="sometimes"), DAY1)
    dim = spark.createDataFrame(VERSIONS, "name string, key int, since timestamp, till timestamp")
    with pytest.raises(ValueError):
        resolve_keys(dim, [VersionLookup(dim, [("name", "name")], {"k": "key"}, day="since", start="since", end="till", early="?")])
