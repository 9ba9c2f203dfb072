import pytest
from pyspark.sql import functions as F

from starloom.functions.columns import normalise_text
from starloom.operators.joins import (
    Lookup,
    lookup_default,
    not_in,
    orphan_report,
    orphan_rows,
    resolve_keys,
    star_join,
)
from starloom.operators.star import (
    ModelDim,
    StarModel,
    dimension_members,
    label_report,
    star_report,
    worth_grouping,
)


def fact(spark):
    return spark.createDataFrame(
        [(1, "Van ", "A"), (2, "van", "B"), (3, "bus", "B"), (4, None, None)],
        "id int, kind string, area string",
    )


def dim(spark):
    return spark.createDataFrame(
        [(10, "van", "small", 1), (11, "bus", "large", 1), (9, "van", "old", 0)],
        "surrogate_key bigint, kind_name string, size string, is_current int",
    )


def by_kind(spark, **take):
    pair = (normalise_text("kind"), normalise_text("kind_name"))
    return Lookup(dim(spark), [pair], take or {"kind_key": "surrogate_key"})


def test_resolve_and_star_join(spark, rows):
    assert rows(resolve_keys(fact(spark), [by_kind(spark)]), "id", "kind_key") == [
        (1, 10),
        (2, 10),
        (3, 11),
        (4, None),
    ]
    assert rows(star_join(fact(spark), [by_kind(spark)]), "id") == [(1,), (2,), (3,)]


def test_not_in_and_nulls(spark, rows):
    known = spark.createDataFrame([("van",), (None,), ("van",)], "kind string")
    assert rows(not_in(fact(spark), known, ["kind"]), "id") == [(1,), (3,), (4,)]
    assert rows(not_in(fact(spark), known, ["kind"], null_safe=True), "id") == [(1,), (3,)]


def test_lookup_default_does_not_multiply(spark, rows):
    ref = spark.createDataFrame([(1, "High St"), (1, "Elm"), (2, None)], "id int, street string")
    out = lookup_default(fact(spark), ref, "id", "street", "Unknown", order=["street"])
    assert rows(out, "id", "street") == [(1, "Elm"), (2, "Unknown"), (3, "Unknown"), (4, "Unknown")]


def test_orphans(spark, rows):
    dims = spark.createDataFrame([("A",)], "area string")
    assert rows(orphan_rows(fact(spark), dims, "area", "area"), "id") == [(2,), (3,), (4,)]
    report = orphan_report(fact(spark), {"area": (dims, "area")})
    assert rows(report) == [("area", None, 1), ("area", "B", 2)]


def test_report_counts_each_fact_once(spark, rows):
    large = Lookup(dim(spark), [("kind", "kind_name")], {"size": "size"})
    plain = star_report(fact(spark), [large], ["size", "area"])
    spread = star_report(fact(spark), [], ["size", "area"], large=[large])
    assert rows(plain) == rows(spread) == [("large", "B", 1), ("small", "B", 1)]
    computed = [(F.lower("kind"), "kind_name")]
    with pytest.raises(ValueError):
        star_report(fact(spark), [], ["size"], large=[Lookup(dim(spark), computed, {"size": "size"})])


def test_label_report_equals_the_fanned_out_join(spark, rows):
    labels = spark.createDataFrame([("B", 1), ("B", 2), ("B", 3), ("A", 4), (None, 5)], "label string, n int")
    joined = fact(spark).join(labels, F.col("area") == F.col("label")).groupBy("area").count()
    assert rows(label_report(fact(spark), labels, "area", "label")) == rows(joined)


def test_members_one_spelling_per_key(spark, rows):
    df = spark.createDataFrame([("Van",), ("van",), (" van",), ("Bus",), (None,), ("Van",)], "kind string")
    out = dimension_members(df, ["kind"], {"size": F.length("kind")}, ["kind"], key_expr=normalise_text)
    assert rows(out) == [(" van", 4), ("Bus", 3)]


def model(spark):
    lines = spark.createDataFrame([(10, 2024, 1), (10, 2024, 2), (11, 2025, 4), (None, 2025, 8)], "kind_key bigint, year int, hurt int")
    shown = {"Kind": "kind_name", "Size": "size", "Current": "is_current"}
    kinds = ModelDim(dim(spark), "kind_key", "surrogate_key", shown, frozenset({"Current"}))
    return StarModel(lines, {"kind": kinds}, {"hurt": "hurt"})


def test_model(spark, rows):
    m = model(spark)
    assert m.frame().columns == ["kind_key", "year", "hurt", "Kind", "Size"]
    assert m.frame().schema["Size"].metadata == {"dimension": "kind", "source": "size"}
    assert rows(m.report(["Size"])) == [(None, 8), ("large", 4), ("small", 3)]
    assert rows(m.report(["year", "Size"])) == [(2024, "small", 3), (2025, None, 8), (2025, "large", 4)]
    only_fact = m.report(["year"])
    assert rows(only_fact) == [(2024, 3), (2025, 12)]
    assert "Join" not in only_fact._jdf.queryExecution().executedPlan().toString()


def test_grouping_before_a_join_only_where_it_reduces(spark):
    few = spark.range(4000).selectExpr("id % 10 as k", "id % 3 as p", "1 as m")
    many = spark.range(4000).selectExpr("id as k", "id % 3 as p", "1 as m")
    assert worth_grouping(few, ["k", "p"]) and not worth_grouping(many, ["k", "p"])
    dim = spark.range(4000).selectExpr("id as d", "id % 2 as half")
    for fact in (few, many):
        model = StarModel(fact, {"dim": ModelDim(dim, "k", "d", {"half": "half"})}, {"m": "m"})
        assert {tuple(r) for r in model.report(["half"]).collect()} == {(0, 2000), (1, 2000)}
        halves = Lookup(dim, [("k", "d")], {"half": "half"}, current_only=False)
        got = star_report(fact, [], ["p", "half"], large=[halves])
        assert sum(r.rows for r in got.collect()) == 4000
