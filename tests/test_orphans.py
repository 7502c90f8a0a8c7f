import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from orebody.operators.orphans import ForeignKey, Keyed, orphan_cascade
from orebody.operators.topn import first_n, latest_by

DAY = datetime(2025, 1, 1)
KEY = ForeignKey("reasons", "cites", "items", "item_id", since="loaded_at", until="deleted_at", clean=True)
REASONS = "reason_id bigint, cites array<string>, at timestamp, items string"
ITEMS = "item_id string, loaded_at timestamp, deleted_at timestamp, boss string, at string"


def dangling(spark, reasons, items):
    tables = {
        "reasons": Keyed(spark.createDataFrame(reasons, REASONS), "reason_id", F.col("at")),
        "items": Keyed(spark.createDataFrame(items, ITEMS), "item_id"),
    }
    return {(int(r.record_id), r.reference) for r in orphan_cascade(tables, [KEY]).references.collect()}


def at(hours):
    return DAY + timedelta(hours=hours)


def test_validity_bounds_and_clean_entries(spark):
    items = [("e1", at(10), at(20), None, "x"), ("e1", at(10), at(20), None, "x"), ("e1", at(40), None, None, "x"), (None, at(1), None, None, "x")]
    reasons = [
        (1, [" E1\n", "\te1"], at(10), "n"), (2, ["e1"], at(20), "n"), (3, ["e1", "", "  ", None], at(39), "n"), (4, ["e1"], at(40), "n"),
        (5, None, at(40), "n"), (6, ["missing", "missing"], at(40), "n"), (7, ["e1"], None, "n"), (6, ["missing"], at(40), "n"),
    ]
    assert dangling(spark, reasons, items) == {(2, "e1"), (3, "e1"), (6, "missing"), (7, "e1")}


def test_empty_tables(spark):
    assert dangling(spark, [], [("e1", at(1), None, None, "x")]) == set()
    assert dangling(spark, [(1, ["e1"], at(5), "n")], []) == {(1, "e1")}


def test_against_brute_force(spark):
    rng = random.Random(3)
    ids = ["a", "b", "c"]
    items = [(rng.choice(ids), at(s := rng.randrange(2000)), rng.choice([None, at(s + rng.randrange(-50, 900))]), None, "") for _ in range(60)]
    reasons = [(k, [rng.choice(ids) for _ in range(2)], at(rng.randrange(2500)), "") for k in range(300)]
    want = {
        (k, c) for k, cites, t, _ in reasons for c in cites
        if not any(i == c and s <= t and (u is None or u > t) for i, s, u, *_ in items)
    }
    assert dangling(spark, reasons, items) == want


def test_cascade_levels_and_cycles(spark):
    schema = "id string, parent string, extra string"
    frames = {
        "a": [("a1", None, ""), ("a2", "gone", "")],
        "b": [("b1", "a1", ""), ("b2", "a2", ""), ("b2", "a2", "")],
        "c": [("c1", "b2", ""), ("c2", "b1", ""), (None, "b2", "")],
    }
    tables = {n: Keyed(spark.createDataFrame(rows, schema), "id") for n, rows in frames.items()}
    keys = [ForeignKey("a", "parent", "a", "id"), ForeignKey("b", "parent", "a", "id"), ForeignKey("c", "parent", "b", "id")]
    found = orphan_cascade(tables, keys)
    assert {(r.table_name, r.record_id, r.level) for r in found.records.collect()} == {("a", "a2", 0), ("b", "b2", 1), ("c", "c1", 2), ("c", None, 2)}
    report = {r.table_name: (r.direct, r.inherited) for r in found.report().collect()}
    assert report == {"a": (1, 0), "b": (0, 1), "c": (0, 2)}
    ring = {"r": Keyed(spark.createDataFrame([("x", "y", ""), ("y", "x", "")], schema), "id")}
    assert orphan_cascade(ring, [ForeignKey("r", "parent", "r", "id")]).records.count() == 0


def test_first_n_and_latest(spark):
    rows = spark.createDataFrame([("g", 2, "b"), ("g", 1, "z"), ("g", 1, "a"), (None, 5, "q"), (None, 4, "q")], "g string, n int, s string")
    assert [tuple(r) for r in first_n(rows, ["g"], [F.col("n"), F.col("s")], 1).orderBy("n").collect()] == [("g", 1, "a"), (None, 4, "q")]
    assert {tuple(r) for r in latest_by(rows, ["g"], F.col("n")).collect()} == {("g", 2, "b"), (None, 5, "q")}
    plan = first_n(rows, ["g"], [F.col("n")], 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
