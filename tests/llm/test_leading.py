import pytest
from pyspark.sql import functions as F

from orebody.llm import queries
from orebody.llm.leading import leading, versions

SCHEMA = "contact_id string, company_id string, decision_rank int, full_name string, observed_at timestamp_ntz, title string"


def test_leading_rows_and_plan(spark):
    rows = spark.createDataFrame([("g", 2, "b"), ("g", 1, "z"), ("g", 1, "a"), (None, 5, "q"), (None, 4, "q"), (None, None, "q")], "g string, n int, s string")
    args = ["g"], [F.col("n").asc_nulls_last()], [F.col("s")]
    assert [tuple(r) for r in leading(rows, *args, 1).orderBy("n").collect()] == [("g", 1, "a"), (None, 4, "q")]
    assert leading(rows, *args, 9, place_as="p").count() == 6 and leading(rows.limit(0), *args, 2).isEmpty()
    assert leading(rows, *args, 2)._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
    assert {tuple(r) for r in versions(rows, ["g"], F.col("n"), [F.col("s")]).collect()} == {("g", 2, "b"), (None, 5, "q")}
    with pytest.raises(ValueError):
        leading(rows, *args, 0)
    with pytest.raises(ValueError):
        leading(rows, *args, 1, place_as="s")


def test_three_leading_contacts(spark, tmp_path):
    from datetime import datetime

    day = lambda d: datetime(2025, 1, d)
    rows = [
        ("a", "c", 1, "Zed", day(1), "x"), ("a", "c", 3, "Zed", day(2), "x"), ("a", "c", 3, "Zed", day(2), "x"),  # the later version counts
        ("b", "c", 9, "Abe", day(1), "x"), ("d", "c", None, "Abe", day(1), "x"), ("e", "c", 2, None, day(1), "x"), ("f", "c", 2, "Old", day(1), "x"),
        ("h", None, 1, "Abe", day(1), "x"), ("i", "gone", 1, "Abe", day(1), "x"), ("i", None, 1, "Abe", day(3), "x"), ("j", "solo", 0, None, None, None),
    ]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "contact_records.parquet"))
    found = {tuple(r) for r in queries.p7_found(spark, str(tmp_path)).collect()}
    assert found == {("c", "f"), ("c", "e"), ("c", "a"), ("solo", "j")}


def test_a_group_of_most_rows(spark):
    rows = spark.range(60_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 997)).alias("g"), "id")
    top = leading(rows, ["g"], [F.col("id").desc()], [], 3)
    assert top.groupBy("g").count().filter("count <> 3").isEmpty()
    assert sorted(r.id for r in top.filter("g = 'hot'").collect()) == [59996, 59998, 59999]
