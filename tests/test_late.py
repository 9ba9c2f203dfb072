"""Facts wait for their members, or point at stand-ins that the members take over."""

from datetime import datetime

import pytest

from starloom.operators import late as mod
from starloom.operators.joins import Lookup
from starloom.operators.late import adopt_members, infer_members, load_or_wait

DIM = "surrogate_key long, name string, kind string, effective_date timestamp, end_date timestamp, is_current int, is_inferred int"
NOW = datetime(2024, 1, 1)


def facts(spark, *data):
    return spark.createDataFrame(list(data), "id long, who string, n int")


def look(spark, *names):
    dim = spark.createDataFrame([(k, n, 1) for k, n in enumerate(names)], "sk long, name string, is_current int")
    return [Lookup(dim, [("who", "name")], {"who_key": "sk"})]


def test_nothing_is_lost_or_doubled(spark, rows, db):
    first = facts(spark, (1, "a", 1), (2, "b", 1), (3, None, 1))
    assert load_or_wait(first, look(spark, "a"), "f", "w", ["id"]) == 2
    assert load_or_wait(first, look(spark, "a"), "f", "w", ["id"]) == 2  # the same load again
    assert load_or_wait(facts(spark, (2, "c", 9), (4, "d", 1)), look(spark, "a"), "f", "w", ["id"]) == 3
    assert rows(spark.table("w")) == [(2, "c", 9), (3, None, 1), (4, "d", 1)]
    assert load_or_wait(first.limit(0), look(spark, "a", "b", "c", "d"), "f", "w", ["id"]) == 1
    assert rows(spark.table("f")) == [(1, "a", 1, 0), (2, "c", 9, 2), (4, "d", 1, 3)]
    assert rows(spark.table("w")) == [(3, None, 1)]


def test_a_load_that_breaks_off_is_repeated(spark, rows, db, monkeypatch):
    load_or_wait(facts(spark, (1, "a", 1), (2, "b", 1)), look(spark), "f", "w", ["id"])
    plain = mod.replace_table
    monkeypatch.setattr(mod, "replace_table", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        load_or_wait(facts(spark, (3, "b", 1)), look(spark, "b"), "f", "w", ["id"])
    monkeypatch.setattr(mod, "replace_table", plain)
    assert load_or_wait(facts(spark, (3, "b", 1)), look(spark, "b"), "f", "w", ["id"]) == 1
    assert rows(spark.table("f"), "id") == [(2,), (3,)] and rows(spark.table("w"), "id") == [(1,)]


def test_a_fact_that_comes_twice_in_a_load_is_refused(spark, db):
    with pytest.raises(Exception, match="repeat a merge key"):
        load_or_wait(facts(spark, (1, "a", 1), (1, "b", 1)), look(spark), "f", "w", ["id"])


def test_stand_ins(spark, rows):
    dim = spark.createDataFrame(
        [(4, "a", "x", NOW, None, 1, 0), (5, "old", "x", NOW, NOW, 0, 0), (6, "b", "x", NOW, None, 1, None)], DIM
    )
    named = facts(spark, *[(k, who, 0) for k, who in enumerate(("a", "old", "z", "y", "z", None, "b"))])
    out = infer_members(dim, named, "who", "name", NOW, {"kind": "?"})
    assert out.dtypes == dim.dtypes
    assert rows(out.where("is_inferred = 1"), "surrogate_key", "name", "kind", "is_current") == [
        (7, "old", "?", 1), (8, "y", "?", 1), (9, "z", "?", 1),
    ]
    assert out.count() == 6 and infer_members(out, named, "who", "name", NOW, {"kind": "?"}).count() == 6
    source = spark.createDataFrame([("z", "real"), ("a", "changed"), ("new", "n")], "name string, kind string")
    adopted = adopt_members(out, source, "name", ["kind"])
    assert rows(adopted, "surrogate_key", "kind", "is_inferred") == [
        (4, "x", 0), (5, "x", 0), (6, "x", None), (7, "?", 1), (8, "?", 1), (9, "real", 0),
    ]
    assert adopt_members(out, source.limit(0), "name", ["kind"]).count() == 6
