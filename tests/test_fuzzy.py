"""Misspelt texts find the spelling that is fewest edits away."""

import json
import random

import pytest

from starloom.functions.columns import normalise_text
from starloom.operators.fuzzy import ALLOWED, fuzzy_categorize, nearest_spelling
from starloom.plans.crashes import CrashWarehouse, read_spellings, vehicle_map
from starloom.plans.warehouse import vehicle_members


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(texts, spellings, allowed):
    out = set()
    for t in {t for t in texts if t is not None}:
        may = [e for n, e in sorted(allowed) if len(t) >= n][-1]
        found = min(((edits(t, s), s) for s in set(spellings) if s is not None and abs(len(s) - len(t)) < 5), default=None)
        if found and found[0] <= may:
            out.add((t, found[1], found[0]))
    return out


@pytest.mark.parametrize("allowed", [ALLOWED, ((0, 2),), ((0, 0), (2, 3))])
def test_as_all_pairs_compared(spark, allowed):
    rng = random.Random(4)
    letters = "abcé"
    word = lambda n: "".join(rng.choices(letters, k=n))
    spellings = [word(rng.randint(0, 14)) for _ in range(60)] + ["station wagon", "aaaaaaaa", None, ""]
    texts = [word(rng.randint(0, 12)) for _ in range(150)] + [None, "", "z" * 100_000, "aaaaaaaaa", "staton wagn"]
    for s in spellings:
        t = list(s or "")
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(t) + 1)
            t[k : k + rng.randint(0, 1)] = rng.choice(("", "a", "é", "x"))
        texts.append("".join(t))
    a = spark.createDataFrame([(t,) for t in texts * 2], "t string")
    b = spark.createDataFrame([(s,) for s in spellings * 2], "s string")
    got = nearest_spelling(a, b, allowed=allowed)
    want = brute(texts, spellings, allowed)
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want) > 30


def test_empty_sides(spark):
    none = spark.createDataFrame([], "t string")
    some = spark.createDataFrame([("a",)], "t string")
    assert nearest_spelling(none, some).count() == nearest_spelling(some, none).count() == 0


def test_listed_texts_keep_their_category(spark, rows):
    lists = {"One": ["sedan", "tractor truck"], "Two": ["sedans", "pas", "sedan"]}
    df = spark.createDataFrame([(x, 1) for x in ("Sedan ", "sedans", "sedqn", "tractr trock", "pax", "bus", None)], "v string, value int")
    got = fuzzy_categorize(df, "v", lists, normalize=normalise_text)
    assert got.columns == ["v", "value", "category"]
    assert dict(rows(got, "v", "category")) == {
        "Sedan ": "One", "sedans": "Two", "sedqn": "One", "tractr trock": "One",
        "pax": "Uncategorized", "bus": "Uncategorized", None: "Uncategorized",
    }


def test_vehicles_from_a_file_of_lists(spark, tmp_path, rows):
    """The spellings listed under an earlier category and under the last."""
    both = {"pas": "Passenger Vehicles", "livestock rack": "Commercial Vehicles", "comm": "Commercial Vehicles",
            "x com": "Commercial Vehicles", "g psd": "Commercial Vehicles", "g amb": "Emergency Vehicles"}
    lists = {c: [v for v, x in both.items() if x == c] for c in dict.fromkeys(both.values())}
    file = tmp_path / "vehicles.json"
    file.write_text(json.dumps({"Other/Unspecified": [*both, "unknown"], **lists}, indent=2))
    spellings = read_spellings(spark, str(file))
    assert spellings.count() == 13 and vehicle_map(spellings).where("rank = 0").isEmpty()
    silver = spark.createDataFrame([(v.title(),) for v in both] + [("Livestok Rack",), ("Unknwn",), ("Px",)], "vehicle_type_code1 string")
    cfg = CrashWarehouse(boroughs=None, vehicle_spellings=spellings, typing_errors=True)
    got = dict(rows(vehicle_members(silver, cfg), "vehicle_type", "category"))
    assert {k.lower(): v for k, v in got.items()} == both | {
        "livestok rack": "Commercial Vehicles", "unknwn": "Other/Unspecified", "px": "Uncategorized",
    }
