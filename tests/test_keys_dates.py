from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from starloom.functions.columns import normalise_text
from starloom.operators.categorize import categorize
from starloom.operators.dates import date_dim
from starloom.operators.keys import (
    assign_keys,
    dedupe,
    first_per_group,
    max_key,
    with_scalar,
)

LISTS = {"First": ["van", "comm"], "Second": ["comm", "bus"]}


def test_assign_keys_equals_global_row_number(spark):
    df = spark.range(0, 5000, numPartitions=7).selectExpr("id", "(id * 7919) % 5003 as v")
    keyed = assign_keys(df, ["v"], start=10)
    got = {r["v"]: r["surrogate_key"] for r in keyed.collect()}
    assert got == {v: i + 11 for i, v in enumerate(sorted(got))}


def test_ties_are_numbered_alike(spark, rows):
    df = spark.range(4000).selectExpr("0 as v", "id", "array(id) as a")
    keyed = assign_keys(df.repartition(5), ["v"])
    assert rows(keyed.where("surrogate_key <> id + 1")) == []
    again = assign_keys(df.repartition(3, "id"), ["v"])
    assert again.exceptAll(keyed).isEmpty()


def test_assign_keys_of_nothing_and_from_max(spark, rows):
    empty = spark.createDataFrame([], "k string")
    assert assign_keys(empty, ["k"]).count() == 0
    dim = spark.createDataFrame([(7,), (3,)], "surrogate_key bigint")
    assert max_key(dim, "surrogate_key").first()[0] == 7
    assert max_key(dim.limit(0), "surrogate_key").first()[0] == 0
    new = spark.createDataFrame([("b",), ("a",)], "k string")
    assert rows(assign_keys(new, ["k"], start=max_key(dim, "surrogate_key"))) == [(8, "a"), (9, "b")]


def test_first_per_group_and_dedupe(spark, rows):
    df = spark.createDataFrame(
        [("a", 2), ("a", 1), ("b", None), ("b", 5), (None, 1), (None, 2)], "k string, v int"
    )
    assert rows(first_per_group(df, ["k"], ["v"])) == [(None, 1), ("a", 1), ("b", None)]
    assert rows(dedupe(df, ["k"], ["v"])) == [(None, 1), ("a", 1), ("b", None)]
    assert dedupe(df, ["k"]).count() == 3


def test_first_per_group_limits_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as v")
    plan = first_per_group(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_with_scalar(spark, rows):
    df = spark.createDataFrame([(1,), (2,)], "a int")
    assert rows(with_scalar(df, df.selectExpr("max(a) as top"))) == [(1, 2), (2, 2)]


def test_categorize_lists(spark, rows):
    df = spark.createDataFrame([(" VAN ",), ("Comm",), ("bus",), ("tram",), (None,)], "t string")
    assert rows(categorize(df, "t", LISTS, normalize=normalise_text)) == [
        (None, "Uncategorized"),
        (" VAN ", "First"),
        ("Comm", "First"),
        ("bus", "Second"),
        ("tram", "Uncategorized"),
    ]
    exact = rows(categorize(df, "t", LISTS))
    assert ("Comm", "Uncategorized") in exact and ("bus", "Second") in exact


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["van", "Van ", "comm", "bus", "x", None]), min_size=1, max_size=20))
def test_categorize_table_equals_lists(spark, rows, values):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    table = spark.createDataFrame(
        [(v, c, i) for i, (c, vs) in enumerate(LISTS.items()) for v in vs],
        "value string, category string, rank int",
    )
    by_table = categorize(df, "t", table, normalize=normalise_text)
    assert rows(by_table) == rows(categorize(df, "t", LISTS, normalize=normalise_text))


def test_calendar_size_and_weekends(spark):
    dim = date_dim(spark)
    assert dim.count() == 7670
    assert dim.where("is_weekend = 1").count() == 2192
    assert dim.schema["full_date"].dataType.simpleString() == "timestamp"


@pytest.mark.parametrize(
    "day, expected",
    [
        (date(2024, 1, 1), ("Monday", 2, 0, "New Year's Day", 2024, 3)),
        (date(2024, 2, 29), ("Thursday", 5, 0, None, 2024, 3)),
        (date(2024, 6, 30), ("Sunday", 1, 1, None, 2024, 4)),
        (date(2024, 7, 1), ("Monday", 2, 0, None, 2025, 1)),
        (date(2024, 7, 4), ("Thursday", 5, 0, "Independence Day", 2025, 1)),
        (date(2024, 12, 25), ("Wednesday", 4, 0, "Christmas Day", 2025, 2)),
        (date(2024, 12, 28), ("Saturday", 7, 1, None, 2025, 2)),
    ],
)
def test_calendar_days(spark, day, expected):
    r = date_dim(spark, day, day).first()
    assert r["full_date"] == datetime(day.year, day.month, day.day)
    assert r["date_key"] == day.year * 10000 + day.month * 100 + day.day
    got = (r.day_name, r.day_of_week, r.is_weekend, r.holiday_name, r.fiscal_year, r.fiscal_quarter)
    assert got == expected
    assert r.is_holiday == int(expected[3] is not None)


def test_calendar_with_other_fiscal_start(spark):
    r = date_dim(spark, date(2024, 1, 1), date(2024, 1, 1), fiscal_start=1, holidays={}).first()
    assert (r.fiscal_year, r.fiscal_quarter, r.is_holiday) == (2024, 1, 0)
