"""Files by several columns, merged when small; counts logged by the write."""

from datetime import datetime
from glob import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from starloom.sources import layout
from starloom.sources.layout import bins, clustered, compact
from starloom.sources.run_log import RunLog
from starloom.sources.sinks import append, ensure_table, replace_partitions, replace_table, table_files, vacuum


def test_filters_on_either_column_skip_files(spark, tmp_path):
    df = spark.range(0, 40_000, numPartitions=4).select(
        "id",
        (F.col("id") * 7919 % 10007).alias("a"),
        F.concat(F.lit("k"), F.lpad((F.col("id") * 104729 % 9973).cast("string"), 5, "0")).alias("b"),
        F.when(F.col("id") % 50 > 0, F.expr("date_add(date'2020-01-01', cast(id * 31 % 1000 as int))")).alias("c"),
    )
    clustered(df, ["a", "b"], 64).write.parquet(str(tmp_path / "z"))
    spans = []
    for file in glob(str(tmp_path / "z" / "*.parquet")):
        meta = pq.ParquetFile(file).metadata
        names = meta.row_group(0).to_dict()["columns"]
        stats = {c["path_in_schema"]: c["statistics"] for c in names}
        spans.append({n: (stats[n]["min"], stats[n]["max"]) for n in ("a", "b")})
    assert len(spans) > 48
    for name, values in (("a", (17, 5000, 9990)), ("b", ("k00017", "k05000", "k09900"))):
        for v in values:
            assert sum(s[name][0] <= v <= s[name][1] for s in spans) <= len(spans) / 4, (name, v)
    back = spark.read.parquet(str(tmp_path / "z"))
    assert back.dtypes == df.dtypes and back.exceptAll(df).count() == df.exceptAll(back).count() == 0
    three = clustered(df.withColumn("_x", F.lit(None).cast("int")), ["c", "a", "_x"], 8)
    assert three.drop("_x").exceptAll(df).count() == 0 and three.count() == 40_000
    assert clustered(df.limit(0), ["a", "c"], 4).count() == 0


def test_more_files_for_more_rows(spark, monkeypatch):
    """A task sorts a bounded number of rows, however many the table has."""
    monkeypatch.setattr(layout, "FILE_ROWS", 500, raising=False)
    df = spark.range(0, 20_000, numPartitions=4).select("id", (F.col("id") * 7919 % 10007).alias("a"))
    for rows, least in ((20_000, 40), (1_000, 8)):
        dealt = clustered(df.where(F.col("id") < rows), ["id", "a"], 8)
        sizes = [r[0] for r in dealt.groupBy(F.spark_partition_id()).count().select("count").collect()]
        assert sum(sizes) == rows and len(sizes) <= least and max(sizes) <= 2 * rows / least, sizes


def test_bins_hold_what_fits():
    files = [("a", 70), ("b", 60), ("c", 40), ("d", 30), ("e", 500)]
    assert bins(files, 100) == [["e"], ["a", "d"], ["b", "c"]]
    assert bins([], 10) == []


@pytest.fixture
def small_files(spark, db):
    ensure_table(spark, "t", "id long, p string", ["p"])
    for k in range(3):
        append(spark.range(k * 100, k * 100 + 100, numPartitions=4).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("a:/ %b"), (F.col("id") % 3).cast("string"))).alias("p")), "t")
    return "t"


def state(spark, name):
    return sorted(map(tuple, spark.table(name).collect()), key=str)


def test_compaction_keeps_rows(spark, small_files):
    rows = state(spark, small_files)
    before, after = compact(spark, small_files)
    assert before >= 30 and after == 3 and state(spark, small_files) == rows
    assert sorted(len(f) for f in table_files(spark, small_files).values()) == [1, 1, 1]
    assert compact(spark, small_files) == (3, 3)
    append(spark.range(1000, 1001).select("id", F.lit("new").alias("p")), small_files)
    assert compact(spark, small_files) == (4, 4) and len(state(spark, small_files)) == 301
    vacuum(spark, small_files)
    assert len(state(spark, small_files)) == 301


def test_partitions_in_good_order_are_left_alone(spark, small_files):
    compact(spark, small_files)
    for k in range(4):
        append(spark.range(500 + k, 501 + k, numPartitions=1).select("id", F.lit("z").alias("p")), small_files)
    kept = {r: f for r, f in table_files(spark, small_files).items() if r != ("z",)}
    rows = state(spark, small_files)
    assert compact(spark, small_files) == (7, 4) and state(spark, small_files) == rows
    assert {r: f for r, f in table_files(spark, small_files).items() if r != ("z",)} == kept


def test_a_compaction_that_breaks_off(spark, small_files, monkeypatch):
    rows = state(spark, small_files)
    monkeypatch.setattr(layout, "replace_snapshot", lambda df, *a: (df.count(), 1 / 0))
    with pytest.raises(ZeroDivisionError):
        compact(spark, small_files)
    monkeypatch.undo()
    assert state(spark, small_files) == rows
    assert compact(spark, small_files)[1] == 3 and state(spark, small_files) == rows


def test_a_file_that_comes_in_meanwhile_stops_it(spark, small_files, monkeypatch):
    listed = table_files(spark, small_files)
    append(spark.range(900, 901).select("id", F.lit("late").alias("p")), small_files)
    rows = state(spark, small_files)
    monkeypatch.setattr(layout, "table_files", lambda *a: listed)
    with pytest.raises(Exception, match="came in"):
        compact(spark, small_files)
    assert state(spark, small_files) == rows


def test_a_table_without_partitions(spark, db):
    replace_table(spark.range(0, 50, numPartitions=5).toDF("id"), "plain")
    assert compact(spark, "plain") == (5, 1) and spark.table("plain").count() == 50
    ensure_table(spark, "none", "id long")
    assert compact(spark, "none")[1] <= 1 and spark.table("none").count() == 0


def test_stages_are_logged_with_what_they_wrote(spark, rows, db):
    ticks = iter(datetime(2024, 1, 1, h) for h in range(9))
    log = RunLog(spark, "runs", "r1", lambda: next(ticks))
    df = spark.range(10).toDF("id")
    assert log.write("load", df, lambda d: replace_table(d, "a"), {"top": F.max("id")}) == 10
    assert log.write("none", df.limit(0), lambda d: append(d, "a"), {"top": F.max("id")}) == 0
    with pytest.raises(Exception, match="no such"):
        log.write("bad", df, lambda d: d.select(F.raise_error(F.lit("no such"))).collect())
    got = rows(log.rows(), "stage", "status", "rows", "metrics", "started_at")
    assert got == [
        ("bad", "failed", None, {}, datetime(2024, 1, 1, 4)),
        ("load", "done", 10, {"top": "9"}, datetime(2024, 1, 1, 0)),
        ("none", "done", 0, {"top": None}, datetime(2024, 1, 1, 2)),
    ]
    RunLog(spark, "runs", "r2").write("load", df, lambda d: append(d, "a"))
    assert log.rows().count() == 3 and spark.table("runs").count() == 4 and spark.table("a").count() == 20


def test_the_count_is_no_second_pass(spark, db):
    """What is written is computed once."""
    seen = spark.sparkContext.accumulator(0)

    def mark(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(1000).mapInArrow(mark, "id long")
    assert RunLog(spark, "runs", "r").write("s", df, lambda d: d.write.saveAsTable("w")) == 1000
    assert seen.value == 1000


def test_writes_by_partition_hold_no_sorted_rows(spark, db):
    """Tasks write their few partitions side by side; the session's setting comes back."""
    df = spark.range(0, 1_000, numPartitions=4).select("id", (F.col("id") % 40).cast("string").alias("p"))
    store = spark._jsparkSession.sharedState().statusStore()
    known = store.executionsList().size()
    replace_table(df, "t", ["p"])
    append(df, "t")
    replace_partitions(df.where("p < '2'"), "t")
    compact(spark, "t")
    ran = [store.executionsList().apply(k).physicalPlanDescription() for k in range(known, store.executionsList().size())]
    writes = [p for p in ran if "InsertIntoHadoopFsRelationCommand" in p]
    assert len(writes) >= 4 and not [p for p in writes if "Sort" in p]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    want = df.where("p < '2'").unionAll(df.where("p >= '2'")).unionAll(df.where("p >= '2'"))
    assert state(spark, "t") == sorted(map(tuple, want.collect()), key=str)
