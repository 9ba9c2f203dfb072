from datetime import datetime

import pytest

from starloom.functions.columns import normalise_text
from starloom.operators.keys import assign_keys
from starloom.operators.merge import apply_changes, changed_rows, empty_dim, scd2_merge, upsert

T0, T1, T2, T3 = (datetime(2025, 1, d) for d in (1, 2, 3, 4))
DIM = (
    "surrogate_key bigint, k string, v string,"
    " effective_date timestamp, end_date timestamp, is_current int"
)


def start(spark):
    return spark.createDataFrame([(1, "a", "X", T0, None, 1), (2, "b", "Y", T0, None, 1)], DIM)


def source(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k string, v string")


def test_next_run_closes_first_and_adds_later(spark, rows):
    src = source(spark, ("a", "X2"), ("b", "Y"), ("c", "Z"))
    one = scd2_merge(start(spark), src, "k", ["v"], T1, reopen="next_run")
    assert rows(one) == [
        (1, "a", "X", T0, T1, 0),
        (2, "b", "Y", T0, None, 1),
        (5, "c", "Z", T1, None, 1),
    ]
    two = scd2_merge(one, src, "k", ["v"], T2, reopen="next_run")
    assert rows(two) == rows(one) + [(6, "a", "X2", T2, None, 1)]
    assert rows(scd2_merge(two, src, "k", ["v"], T3, reopen="next_run")) == rows(two)


def test_same_run_reopens_at_once(spark, rows):
    src = source(spark, ("a", "X2"), ("b", "Y"), ("c", "Z"))
    one = scd2_merge(start(spark), src, "k", ["v"], T1)
    assert rows(one) == [
        (1, "a", "X", T0, T1, 0),
        (2, "b", "Y", T0, None, 1),
        (3, "a", "X2", T1, None, 1),
        (4, "c", "Z", T1, None, 1),
    ]
    assert rows(scd2_merge(one, src, "k", ["v"], T2)) == rows(one)


@pytest.mark.parametrize("old, new", [(None, "x"), ("x", None)])
def test_null_changes(spark, old, new):
    dim = spark.createDataFrame([(1, "a", old, T0, None, 1)], DIM)
    src = source(spark, ("a", new))
    assert scd2_merge(dim, src, "k", ["v"], T1).count() == 2
    assert scd2_merge(dim, src, "k", ["v"], T1, null_safe=False).count() == 1


def test_member_closed_earlier_comes_back(spark, rows):
    dim = spark.createDataFrame([(1, "a", "X", T0, T1, 0)], DIM)
    out = scd2_merge(dim, source(spark, ("a", "X")), "k", ["v"], T2)
    assert rows(out) == [(1, "a", "X", T0, T1, 0), (2, "a", "X", T2, None, 1)]


def test_member_missing_from_source_stays(spark, rows):
    assert rows(scd2_merge(start(spark), source(spark), "k", ["v"], T1)) == rows(start(spark))


def test_key_expression(spark, rows):
    out = scd2_merge(
        start(spark), source(spark, (" A ", "X"), ("B", "Y2")), "k", ["v"], T1, key_expr=normalise_text
    )
    assert rows(out) == [
        (1, "a", "X", T0, None, 1),
        (2, "b", "Y", T0, T1, 0),
        (3, "B", "Y2", T1, None, 1),
    ]


def test_first_load_and_repeated_source_key(spark, rows):
    empty = empty_dim(spark, "k", {"v": "string"})
    out = scd2_merge(empty, source(spark, ("b", "Y"), ("a", "X")), "k", ["v"], T1)
    assert rows(out, "surrogate_key", "k") == [(1, "a"), (2, "b")]
    with pytest.raises(Exception, match="repeat a merge key"):
        scd2_merge(empty, source(spark, ("a", "Y"), ("a", "X")), "k", ["v"], T1).collect()


FACT = "id string, a bigint, b int"


def fact(spark, *data):
    return spark.createDataFrame(list(data), FACT)


def test_upsert(spark, rows):
    stored = fact(spark, ("1", 1, 1), ("2", 2, 2), ("3", None, 3), ("4", 4, 4), (None, 9, 9))
    load = fact(spark, ("1", 1, 1), ("2", 2, 5), ("3", 3, 3), ("4", None, 4), ("5", 5, 5), (None, 8, 8))
    fixed = [(None, 8, 8), (None, 9, 9), ("1", 1, 1), ("2", 2, 5), ("3", 3, 3), ("4", None, 4), ("5", 5, 5)]
    assert rows(upsert(stored, load, ["id"], ["a", "b"])) == fixed
    loose = [(None, 8, 8), (None, 9, 9), ("1", 1, 1), ("2", 2, 5), ("3", None, 3), ("4", 4, 4), ("5", 5, 5)]
    assert rows(upsert(stored, load, ["id"], ["a", "b"], null_safe=False)) == loose


def test_upsert_rejects_repeated_keys(spark):
    with pytest.raises(Exception, match="repeat a merge key"):
        upsert(fact(spark, ("1", 1, 1)), fact(spark, ("1", 2, 2), ("1", 3, 3)), ["id"], ["a", "b"]).collect()
    nulls = fact(spark, (None, 2, 2), (None, 3, 3))
    assert upsert(fact(spark, ("1", 1, 1)), nulls, ["id"], ["a", "b"]).count() == 3


@pytest.mark.parametrize("null_safe", [True, False])
def test_changes_applied_equal_upsert(spark, rows, null_safe):
    stored = fact(spark, *[(str(i), i % 7 or None, i % 3) for i in range(200)], (None, 1, 1))
    load = fact(spark, *[(str(i), i % 5 or None, i % 3) for i in range(100, 300)], (None, 1, 1), (None, 2, 2))
    changes = changed_rows(stored, load, ["id"], ["a", "b"], null_safe=null_safe, was=["b"])
    assert changes.columns == ["id", "a", "b", "_was_b"]
    expected = rows(upsert(stored, load, ["id"], ["a", "b"], null_safe=null_safe))
    assert rows(apply_changes(stored, changes, ["id"])) == expected


def test_upsert_needs_one_shuffle_per_side(spark, tmp_path):
    for name in ("t", "s"):
        fact(spark, ("1", 1, 1)).write.parquet(str(tmp_path / name))
    t, s = (spark.read.parquet(str(tmp_path / n)) for n in ("t", "s"))
    def shuffles(**options):
        out = upsert(t, s, ["id"], ["a", "b"], **options)
        return out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    assert shuffles(null_keys="append") == 2
    assert shuffles() == 3  # and one of the rows without a key


def test_keys_survive_reevaluation(spark, rows):
    df = spark.range(1000).selectExpr("id", "hash(id) as h").repartition(6)
    keyed = assign_keys(df, ["h", "id"])
    assert rows(keyed) == rows(keyed)
