from datetime import date, datetime

from pyspark.sql import types as T

from starloom.functions.columns import (
    clock_text,
    concat_key,
    hash_identifier,
    iso_date,
    month_start,
    text_identifier,
)
from starloom.operators.columns import (
    annotate,
    cast_failures,
    cast_schema,
    coalesce_into,
    columns_of_type,
    fill,
    normalize_case,
    project,
)
from starloom.operators.ordering import head_n, order, union_all
from starloom.operators.predicates import (
    drop_nulls,
    drop_values,
    where_not_null,
    where_null,
    where_since,
    where_value,
)
from starloom.operators.profile import count_by, distinct_by, null_profile, numeric_profile, row_count
from starloom.session import drop_intermediates, intermediates, reliable_checkpoint

CASTS = {"n": "int", "clock": clock_text, "day": iso_date}


def texts(spark):
    data = [
        (1, "12", "9:05", "2023-01-01T00:00:00.000"),
        (2, "x", "25:70", "2023-01-02"),
        (3, "", "23:59", "soon"),
        (4, None, None, None),
    ]
    return spark.createDataFrame(data, "id int, n string, clock string, day string")


def test_cast_turns_malformed_into_null(spark, rows):
    assert rows(cast_schema(texts(spark), CASTS)) == [
        (1, 12, "09:05:00", date(2023, 1, 1)),
        (2, None, None, date(2023, 1, 2)),
        (3, None, "23:59:00", None),
        (4, None, None, None),
    ]


def test_cast_failures_are_the_malformed_rows(spark, rows):
    assert rows(cast_failures(texts(spark), CASTS), "id") == [(2,), (3,)]


def places(spark):
    data = [(1, None, None), (2, 1.0, None), (3, 0.0, 0.0), (4, 0.0, 2.0), (5, 3.0, 4.0)]
    return spark.createDataFrame(data, "id int, lat double, lon double")


def test_null_predicates(spark, rows):
    df = places(spark)
    assert rows(where_null(df, ["lat", "lon"]), "id") == [(1,)]
    assert rows(where_null(df, ["lat", "lon"], "any"), "id") == [(1,), (2,)]
    assert rows(where_not_null(df, ["lat", "lon"]), "id") == [(3,), (4,), (5,)]
    assert rows(drop_nulls(df, ["lat", "lon"]), "id") == [(3,), (4,), (5,)]


def test_sentinel_predicates(spark, rows):
    df = places(spark)
    assert rows(where_value(df, {"lat": 0.0, "lon": 0.0}), "id") == [(3,)]
    assert rows(where_value(df, {"lat": 0.0, "lon": 0.0}, "any"), "id") == [(3,), (4,)]
    assert rows(drop_values(df, ["lat", "lon"], 0.0), "id") == [(5,)]


def test_where_since_filters_the_bare_column(spark, rows):
    df = spark.createDataFrame(
        [(datetime(2025, 7, 10, 23, 59),), (datetime(2025, 7, 11),)], "ts timestamp"
    )
    assert where_since(df, "ts", date(2025, 7, 11)).count() == 1
    text = spark.createDataFrame([("2025-07-10T23:59:59",), ("2025-07-11T00:00:00",)], "t string")
    assert rows(where_since(text, "t", date(2025, 7, 11))) == [("2025-07-11T00:00:00",)]
    days = spark.createDataFrame([(date(2025, 7, 10),), (date(2025, 7, 11),)], "d date")
    assert rows(where_since(days, "d", date(2025, 7, 11))) == [(date(2025, 7, 11),)]


def test_projection_and_constants(spark, rows):
    df = places(spark)
    assert project(df, drop=["lon"], rename={"lat": "y"}).columns == ["id", "y"]
    assert project(df, keep=["lon", "id"]).columns == ["lon", "id"]
    assert rows(annotate(df, {"k": "v"}).where("id = 1"), "k") == [("v",)]


def test_fill_and_coalesce(spark, rows):
    df = spark.createDataFrame([(1, None, "b"), (2, "a", None), (3, None, None)], "id int, x string, y string")
    assert rows(fill(df, {"x": "Unknown"}), "x", "y") == [
        ("Unknown", None),
        ("Unknown", "b"),
        ("a", None),
    ]
    assert rows(coalesce_into(df, "z", "x", "y"), "id", "z") == [(1, "b"), (2, "a"), (3, None)]


def test_columns_of_type(spark):
    df = spark.createDataFrame([], "a int, b string, c decimal(5,2), d float, e date")
    assert columns_of_type(df) == ["a", "c", "d"]
    assert columns_of_type(df, (T.DateType,)) == ["e"]


def test_title_case_splits_on_spaces_only(spark, rows):
    df = spark.createDataFrame([("E-BIKE two",)], "t string")
    assert rows(normalize_case(df, ["t"])) == [("E-bike Two",)]


def test_key_texts(spark, rows):
    df = spark.createDataFrame([(1, 40.672268, -73.5), (2, None, 1.0)], "id int, a float, b float")
    assert rows(df.select(concat_key("a", "b"))) == [(None,), ("40.672268_-73.5",)]
    assert rows(df.select(concat_key("a", "b", digits=3)).where("id = 1")) == [("40.672_-73.500",)]


def test_identifiers_and_nulls(spark):
    df = spark.createDataFrame([("a", None, "b"), (None, "a", "b")], "x string, y string, z string")
    text = [r[0] for r in df.select(text_identifier(df.columns)).collect()]
    hashed = [r[0] for r in df.select(hash_identifier(df.columns)).collect()]
    assert text == ["a-b", "a-b"]
    assert hashed[0] != hashed[1]


def test_profiles(spark, rows):
    df = places(spark)
    assert null_profile(df).first().asDict() == {"id": 0, "lat": 1, "lon": 2}
    lat = {r["column"]: r for r in numeric_profile(df).collect()}["lat"]
    assert (lat["count"], lat["mean"], lat["min"], lat["max"]) == (4, 1.0, 0.0, 3.0)
    assert abs(lat["stddev"] - 2**0.5) < 1e-12
    assert row_count(df) == 5
    assert [tuple(r) for r in count_by(df, ["lat"], order="count").collect()][0] == (0.0, 2)
    assert [r[0] for r in count_by(df, ["lat"], order="keys").collect()] == [None, 0.0, 1.0, 3.0]
    assert distinct_by(df, ["lat"]).count() == 4


def test_order_limit_union(spark, rows):
    df = places(spark)
    assert [r.id for r in order(df, ["lat", "id"], descending=["lat"]).collect()] == [5, 2, 3, 4, 1]
    assert [r.id for r in head_n(df, 2, ["id"], descending=["id"]).collect()] == [5, 4]
    assert union_all(df, df).count() == 10
    swapped = df.select("lon", "id", "lat")
    assert union_all(df, swapped).where("lon = 4 and lat = 3").count() == 2


def test_month_start(spark, rows):
    df = spark.createDataFrame([(date(2024, 2, 29),)], "d date")
    assert rows(df.select(month_start("d"))) == [(date(2024, 2, 1),)]


def test_where_null_reaches_the_scan(spark, tmp_path):
    places(spark).write.parquet(str(tmp_path / "p"))
    plan = where_null(spark.read.parquet(str(tmp_path / "p")), ["lat"]).select("id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "IsNull(lat)" in text and "lon" not in text.split("ReadSchema")[1]


def test_intermediate_tables_can_be_dropped(spark):
    import os

    before = intermediates()
    path = reliable_checkpoint(spark.range(3)).inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path) and intermediates() == before + 1
    assert drop_intermediates(spark, since=before) == 1
    assert not os.path.exists(path) and intermediates() == before


def test_a_stretch_of_intermediate_tables_can_be_dropped(spark):
    before = intermediates()
    kept = [reliable_checkpoint(spark.range(n)) for n in (1, 2, 3)]
    assert drop_intermediates(spark, since=before, until=before + 2) == 2
    assert kept[2].count() == 3 and intermediates() == before + 1
    assert drop_intermediates(spark, since=before) == 1
