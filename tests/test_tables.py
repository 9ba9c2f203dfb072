from datetime import date, datetime, timedelta

import pytest

from starloom.operators.merge import apply_changes, changed_rows
from starloom.sources.readers import incremental_read, read_json, records_to_df, scan, stamp_batch
from starloom.sources.sinks import (
    append,
    ctas_if_absent,
    ensure_table,
    insert_into,
    partition_columns,
    register_view,
    replace_partitions,
    replace_table,
    vacuum,
)
from starloom.streaming.incremental import incremental_load
from starloom.streaming.marks import empty_marks, get_mark, next_mark, seed_mark, upsert_mark

NOW, LATER = datetime(2025, 1, 1), datetime(2025, 2, 1)


def frame(spark, *data):
    return spark.createDataFrame(list(data), "k string, v int")


def test_append_creates_then_adds_by_name(spark, rows, db):
    append(frame(spark, ("a", 1)), "t")
    append(frame(spark, ("b", 2)).select("v", "k"), "t")
    assert rows(scan(spark, "t")) == [("a", 1), ("b", 2)]
    with pytest.raises(ValueError):
        insert_into(frame(spark, ("c", 3)).withColumnRenamed("v", "w"), "t")


def test_replace_a_table_being_read(spark, rows, db):
    append(frame(spark, ("a", 1), ("b", 2)), "t")
    replace_table(spark.table("t").where("k = 'a'").unionByName(frame(spark, ("c", 3))), "t")
    assert rows(spark.table("t")) == [("a", 1), ("c", 3)]
    append(frame(spark, ("d", 4)), "t")
    assert spark.table("t").count() == 3


def test_replace_partitioned_table(spark, rows, db):
    replace_table(frame(spark, ("a", 1), ("b", 2), ("c", None)), "t", ["v"])
    assert partition_columns(spark, "t") == ["v"]
    grown = spark.table("t").unionByName(frame(spark, ("d", 3), ("e", 1)))
    replace_table(grown, "t", ["v"])
    assert rows(spark.table("t")) == [("a", 1), ("b", 2), ("c", None), ("d", 3), ("e", 1)]
    plan = spark.table("t").where("v = 3")._jdf.queryExecution().executedPlan().toString()
    assert "(v#" in plan.split("PartitionFilters")[1]


def test_replace_some_partitions(spark, rows, db):
    replace_table(frame(spark, ("a", 1), ("b", 2), ("c", None), ("d", 4)), "t", ["v"])
    untouched = set(spark.table("t").where("v = 4").inputFiles())
    fresh = spark.table("t").where("v = 1").unionByName(frame(spark, ("e", 1), ("f", 9), ("g", None)))
    gone = spark.createDataFrame([(2,)], "v int")
    replace_partitions(fresh, "t", gone)
    assert rows(spark.table("t")) == [("a", 1), ("d", 4), ("e", 1), ("f", 9), ("g", None)]
    assert untouched < set(spark.table("t").inputFiles())


def test_replace_partitions_with_awkward_names(spark, rows, db):
    names = ["a b", "x/y=z", "50%:'q'", "back\\slash", None]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "p string, v int")
    replace_table(df, "t", ["p"])
    replace_partitions(df.selectExpr("p", "v + 10 as v"), "t")
    assert rows(spark.table("t"), "p", "v") == rows(df.selectExpr("p", "v + 10"))


def test_replace_partitions_by_date(spark, rows, db):
    df = spark.createDataFrame([("a", date(2024, 1, 1)), ("b", date(2024, 2, 1))], "k string, m date")
    replace_table(df, "t", ["m"])
    replace_partitions(df.where("k = 'b'").selectExpr("'z' as k", "m"), "t")
    assert rows(spark.table("t")) == [("a", date(2024, 1, 1)), ("z", date(2024, 2, 1))]


def test_vacuum_leaves_what_is_pointed_at(spark, rows, db):
    def frame(*data):
        return spark.createDataFrame(list(data), "v int, p string")

    for n in range(3):
        replace_table(frame((n, "a"), (n, "b")), "kept", ["p"])
    replace_partitions(frame((7, "b")), "kept")
    replace_table(frame((1, "x")), "plain")
    replace_table(frame((2, "x")), "plain")
    assert vacuum(spark, "kept", timedelta(hours=1)) == 0
    assert vacuum(spark, "kept") == 2 and vacuum(spark, "plain") == 1
    assert rows(spark.table("kept")) == [(2, "a"), (7, "b")]
    assert rows(spark.table("plain")) == [(2, "x")]
    replace_table(frame((9, None)), "kept", ["p"])
    assert rows(spark.table("kept")) == [(9, None)]
    assert vacuum(spark, "kept") == 2
    append(frame((10, "c")), "kept")
    assert rows(spark.table("kept")) == [(10, "c"), (9, None)]


def test_partitions_swapped_in_half_are_repaired(spark, rows, db):
    target = spark.createDataFrame([(1, 5, "a"), (1, 6, "b"), (2, 1, "a")], "k int, v int, p string")
    source = spark.createDataFrame([(1, 7, "b"), (2, 1, "a")], "k int, v int, p string")
    changes = changed_rows(target, source, ["k"], ["v", "p"], was=["p"])
    assert rows(changes.select("_was_p")) == [("a",), ("b",)]
    assert rows(apply_changes(target, changes, ["k"])) == [(1, 7, "b"), (2, 1, "a")]


def test_ensure_and_ctas(spark, rows, db):
    ensure_table(spark, "t", "k string, v int", ["v"])
    assert spark.table("t").count() == 0
    insert_into(frame(spark, ("a", 1)), "t")
    ensure_table(spark, "t", "k string, v int", ["v"])
    assert rows(spark.table("t")) == [("a", 1)]
    assert ctas_if_absent(frame(spark, ("a", 1)), "u") is True
    assert ctas_if_absent(frame(spark, ("b", 1)), "u") is False
    assert rows(spark.table("u")) == [("a", 1)]


def test_views(spark, rows):
    register_view(frame(spark, ("a", 1)), "view_a")
    register_view(frame(spark, ("b", 1)), "view_a")
    assert rows(spark.sql("select k from view_a")) == [("b",)]


def test_records_with_missing_fields(spark, rows, tmp_path):
    (tmp_path / "one.json").write_text('{"k": "a", "v": 1}\n{"k": "b"}\n')
    assert rows(records_to_df(spark, str(tmp_path), "k string, v int")) == [("a", 1), ("b", None)]
    assert rows(records_to_df(spark, [("a", 1)], "k string, v int")) == [("a", 1)]
    (tmp_path / "doc").mkdir()
    (tmp_path / "doc" / "m.json").write_text('{\n "k": "a",\n "v": 1\n}\n')
    assert rows(read_json(spark, str(tmp_path / "doc"), "k string, v int")) == [("a", 1)]


def test_scan_path(spark, rows, tmp_path):
    frame(spark, ("a", 1)).write.parquet(str(tmp_path / "p"))
    assert rows(scan(spark, str(tmp_path / "p"))) == [("a", 1)]


def stamped(spark, *days):
    return spark.createDataFrame([(str(i), d) for i, d in enumerate(days)], "id string, day string")


def test_incremental_read_is_strict(spark, rows):
    df = stamped(spark, "2023-01-01T00:00:00.000", "2023-01-01T00:00:01", "2022-12-31", "soon")
    assert rows(incremental_read(df, "day", datetime(2023, 1, 1), ["id"])) == [("1",)]
    assert rows(incremental_read(df, "day", "2023-01-01T00:00:00", ["id"])) == [("1",)]
    back = incremental_read(df, "day", datetime(2023, 1, 1), ["id"], lookback=timedelta(days=2))
    assert rows(back) == [("0",), ("1",), ("2",)]


def test_incremental_filter_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([(NOW, 1, 2)], "ts timestamp, a int, b int").write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    plan = incremental_read(df, "ts", NOW, ["a"])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts" in plan and "b:int" not in plan


def test_stamp(spark, rows):
    out = stamp_batch(frame(spark, ("a", 1)), datetime(2025, 7, 4, 12, 33, 34, 912482))
    assert rows(out, "extraction_timestamp") == [("2025-07-04T12:33:34.912482",)]


def test_marks(spark, rows):
    marks = empty_marks(spark)
    assert get_mark(marks, "a") == datetime(2023, 1, 1)
    df = stamped(spark, "2024-05-06T07:08:09", "2024-05-05")
    marks = upsert_mark(marks, seed_mark(df, "day", "a", NOW))
    marks = upsert_mark(marks, next_mark(df, "day", "b", NOW))
    assert get_mark(marks, "a") == datetime(2024, 5, 6)
    assert get_mark(marks, "b") == datetime(2024, 5, 6, 7, 8, 9)
    marks = upsert_mark(marks, next_mark(stamped(spark, "2025-01-01"), "day", "a", LATER))
    assert rows(marks) == [
        ("a", datetime(2025, 1, 1), LATER),
        ("b", datetime(2024, 5, 6, 7, 8, 9), NOW),
    ]


LOAD = {"mark_col": "day", "columns": ["id", "day"]}


def test_incremental_load(spark, rows, db):
    old = stamped(spark, "2022-01-01", "2023-02-01", "2023-03-01")
    assert incremental_load(old, "t", "marks", batch_ts=NOW, **LOAD) is True
    assert rows(spark.table("t"), "id") == [("1",), ("2",)]
    assert incremental_load(old, "t", "marks", batch_ts=LATER, **LOAD) is False
    assert rows(spark.table("marks")) == [("t", datetime(2023, 3, 1), NOW)]
    more = stamped(spark, "2022-01-01", "2023-02-01", "2023-03-01", "2023-02-15", "2023-04-01")
    assert incremental_load(more, "t", "marks", batch_ts=LATER, **LOAD) is True
    assert rows(spark.table("t"), "id") == [("1",), ("2",), ("4",)]
    assert incremental_load(more, "u", "marks", batch_ts=LATER, **LOAD) is True
    assert rows(spark.table("marks"), "table_name") == [("t",), ("u",)]


def test_lookback_with_key_fetches_late_rows_once(spark, rows, db):
    options = {**LOAD, "lookback": timedelta(days=30), "key": ["id"]}
    incremental_load(stamped(spark, "2023-02-01", "2023-03-01"), "t", "marks", batch_ts=NOW, **options)
    late = stamped(spark, "2023-02-01", "2023-03-01", "2023-02-15", "2023-03-02")
    for _ in range(2):
        incremental_load(late, "t", "marks", batch_ts=LATER, **options)
    assert rows(spark.table("t"), "id") == [("0",), ("1",), ("2",), ("3",)]
