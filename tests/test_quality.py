from datetime import datetime

from starloom.operators.clean import CleanSpec, clean
from starloom.operators.duplicates import duplicate_keys, duplicate_rows
from starloom.operators.quality import (
    DuplicateRule,
    NullRule,
    ValueRule,
    drop_failing,
    error_counts,
    find_errors,
    log_errors,
)

NOW = datetime(2025, 7, 4, 12)
LABELS = {"severity": "High", "description": "d"}
RULES = [
    NullRule(error_type="NULL_CHECK", columns_checked="place", columns=("lat", "lon"), **LABELS),
    ValueRule(error_type="Value_check", columns_checked="place", values={"lat": 0.0, "lon": 0.0}, **LABELS),
    NullRule(error_type="Null_check", columns_checked="area", columns=("area",), **LABELS),
    DuplicateRule(error_type="Duplicate_check", columns_checked="id", keys=("id", "area"), **LABELS),
]


def crashes(spark, batch="b1"):
    data = [
        ("1", None, None, "X"),
        ("2", 1.0, None, "X"),
        ("3", 0.0, 0.0, None),
        ("4", 1.0, 2.0, "Y"),
        ("4", 1.0, 3.0, "Y"),
        ("5", 1.0, 2.0, None),
        ("5", 1.0, 3.0, None),
        ("5", 1.0, 4.0, None),
    ]
    return spark.createDataFrame(
        [(*r, batch) for r in data], "id string, lat double, lon double, area string, batch string"
    )


def test_find_errors_one_row_per_failure(spark, rows):
    found = find_errors(crashes(spark), RULES, table_name="t", now=NOW, keep=("id",))
    counts = rows(found.groupBy("error_type", "columns_checked").count())
    assert counts == [
        ("Duplicate_check", "id", 5),
        ("NULL_CHECK", "place", 1),
        ("Null_check", "area", 4),
        ("Value_check", "place", 1),
    ]
    assert {r.table_name for r in found.collect()} == {"t"}


def test_second_run_adds_nothing(spark):
    df = crashes(spark)
    options = {"table_name": "t", "now": NOW, "keep": ("id",)}
    first = log_errors(df, RULES, find_errors(df, RULES, **options).limit(0), **options)
    assert first.count() == 11
    assert log_errors(df, RULES, first, **options).count() == 0


def test_new_batch_of_same_record(spark):
    """With all columns as identity the batch stamp makes an old error new."""
    by_all = RULES[:1]
    by_key = [NullRule(**{**vars(RULES[0]), "identity": ("id",)})]
    for rules, expected in ((by_all, 1), (by_key, 0)):
        for kind in ("text", "hash"):
            options = {"table_name": "t", "now": NOW, "identifier": kind}
            log = find_errors(crashes(spark), rules, **options)
            again = log_errors(crashes(spark, "b2"), rules, log, **options)
            assert again.count() == expected


def test_duplicates_with_null_key(spark):
    df = crashes(spark)
    assert duplicate_keys(df, ["id", "area"]).count() == 2
    assert duplicate_rows(df, ["id", "area"]).count() == 5
    assert duplicate_rows(df, ["id", "area"], null_safe=False).count() == 2


def test_value_rule_reads_text(spark):
    df = spark.createDataFrame([("0.000", "0"), ("x", "0"), ("1", "0")], "lat string, lon string")
    rule = ValueRule(error_type="v", columns_checked="c", values={"lat": 0.0, "lon": 0.0}, as_type="double", **LABELS)
    assert find_errors(df, [rule], table_name="t", now=NOW).count() == 1


def test_drop_failing_drops_what_is_logged(spark, rows):
    kept = drop_failing(crashes(spark), RULES, order=["lon"])
    assert rows(kept, "id", "lon") == [("2", None), ("4", 2.0)]


def test_counts_merge_spellings(spark, rows):
    data = [
        (NOW, "NULL_CHECK", "High", "c", "2025-07-04T01:02:03.000004"),
        (NOW, "Null_check", "High", "c", "2025-07-04T09:00:00"),
    ]
    log = spark.createDataFrame(
        data,
        "error_timestamp timestamp, error_type string, severity string,"
        " columns_checked string, extraction_timestamp string",
    )
    assert rows(error_counts(log), "error_type", "count") == [("Null_check", 2)]
    split = error_counts(log, normalize=False)
    assert rows(split, "error_type", "count") == [("Null_check", 1), ("Null_check", 1)]


def test_clean_in_order(spark, rows):
    df = spark.createDataFrame(
        [
            ("1", "1.5", None),
            ("1", "1.5", "v"),
            ("2", "0.0", "v"),
            ("3", "bad", "v"),
            ("4", None, "v"),
            ("5", "2", "v"),
        ],
        "id string, lat string, kind string",
    )
    spec = CleanSpec(
        casts={"lat": "float"},
        required=["lat"],
        sentinels={"lat": 0.0},
        dedupe_keys=["id"],
        dedupe_order=["kind"],
        defaults={"kind": "Unknown"},
    )
    assert rows(clean(df, spec)) == [("1", 1.5, "Unknown"), ("5", 2.0, "v")]
