import json

import pytest
from pyspark.sql import functions as F

from orebody.operators import calibration, contacts, evidence, identity, ledger
from orebody.operators.topn import numbered
from orebody.plans import domain
from orebody.sources.labels_csv import read_labels
from orebody.sources.ledger_jsonl import latest_records, read_ledger
from orebody.sources.sinks import append_json, replace_csv, replace_json
from orebody.streaming.usage import once, totals, usage_stream

SCHEMA = ", ".join(f"{c} string" for c in identity.RECORD)


def record(n, **over):
    base = dict.fromkeys(identity.RECORD) | {
        "record_id": f"r{n}", "provider": "exa", "name": "Acme Valve", "city": "Houston", "region": "Texas", "country_code": "United States",
        "retrieved_at": f"2026-08-2{n % 10}T10:00:00+00:00", "raw_metadata": "{}",
    }
    return tuple((base | over)[c] for c in identity.RECORD)


def test_identity(spark):
    rows = [
        record(1, website_url="https://acme.com/a"), record(2, provider="apify", name="ACME Valve, Inc."), record(3, website_url="https://www.acme.com"),
        record(4, name="Other", city=None), record(5, name=None), record(6, name=None, website_url="https://solo.org", country_code="MX"),
        record(7, name="Lone Pipe"), record(8, name="Lone Pipe Ltd"), record(9, name="Two", website_url="https://two.com"),
        record(9, name="Two", website_url="https://two.net"), record(3, name="Two"), record(4, name="Other", city=None),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    found = identity.resolve(df.orderBy(F.rand(3)))
    companies = {r.normalized_name: r for r in found.companies.collect() if r.n_records > 1 or r.normalized_name != "two"}
    assert companies["acme valve"].n_records == 3 and companies["acme valve"].discovery_sources == ["apify", "exa"]
    assert companies["acme valve"].name == "Acme Valve" and companies["acme valve"].country == "US"
    assert companies["lone pipe"].n_records == 2 and companies["lone pipe"].domain is None
    assert companies["solo.org"].review_reasons == ["INSUFFICIENT_IDENTITY", "OUTSIDE_GEOGRAPHY"]
    reasons = sorted(tuple(r.review_reasons) for r in found.companies.collect())
    assert reasons.count(("AMBIGUOUS_IDENTITY",)) == 1 and reasons.count(("INSUFFICIENT_IDENTITY",)) == 2
    back = found.members.drop("company_id").unionByName(found.unresolved)
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()
    again = identity.resolve(df.repartition(3)).companies
    assert again.exceptAll(found.companies).isEmpty()
    assert identity.resolve(df.limit(0)).companies.isEmpty()


def test_bundle(spark):
    rows = [("c", f"e{k:02}", f"https://s{k % 3}.com/p{k}", "x" * 3000, k) for k in range(20)] + [("c", "e99", "https://s0.com/p0", "y", 99), ("c", "e98", "nope", "y", 98), ("c", "e97", None, None, 97)]
    df = spark.createDataFrame(rows, "company_id string, evidence_id string, url string, excerpt string, n int")
    out = evidence.bundle(df, F.lit("s0.com"), [F.col("n")]).orderBy("position").collect()
    assert [r.evidence_id for r in out] == ["e00", "e01", "e02", "e03", "e04", "e05", "e06", "e09"]
    assert sum(len(r.excerpt_used) for r in out) == 16_000
    short = evidence.bundle(df, F.lit("s0.com"), [F.col("n")], chars_all=5000).orderBy("position").collect()
    assert [len(r.excerpt_used) for r in short] == [2000, 2000, 1000]
    assert evidence.bundle(df.limit(0), F.lit("x"), [F.col("n")]).isEmpty()


def test_ledgers(spark):
    events = spark.createDataFrame([("exa", 2, 0.04), ("deepseek", 1, 0.01), ("clay", 1, None)], "provider string, n int, cost double")
    out = {r.provider: (r.n, r.cost) for r in ledger.usage_totals(events, "provider", ["n"], ["cost"]).collect()}
    assert out == {"exa": (2, 0.04), "deepseek": (1, 0.01), "clay": (1, None), None: (4, None)}
    asks = spark.createDataFrame([("g", k, a) for k, a in enumerate([1.0, 1.0, 5.0, 0.5, None])] + [("h", 1, None)], "g string, k int, a double")
    assert [r.admitted for r in ledger.admitted_prefix(asks, ["g"], ["k"], "a", F.lit(2.0)).orderBy("g", "k").collect()] == [True, True, False, False, False, False]
    assert all(r.admitted for r in ledger.admitted_prefix(asks, ["g"], ["k"], "a", F.lit(None).cast("double")).collect())
    shares = spark.range(10).select(ledger.allocate(F.lit(67), F.lit(10), F.col("id")).cast("int").alias("s")).collect()
    assert sorted(r.s for r in shares) == [6] * 3 + [7] * 7


def test_hot_groups_are_summed_in_ranges(spark, monkeypatch):
    rows = [("hot", k, (k * 7) % 5) for k in range(2000)] + [(None, k, k % 3) for k in range(900)] + [(f"g{k}", k, 1) for k in range(50)] + [("hot", 2000, None)]
    df = spark.createDataFrame(rows, "g string, k int, a int").repartition(7)
    plain = {(r.g, r.k): (r.s, r.ok) for r in ledger.admitted_prefix(ledger.running_sum(df, ["g"], ["k"], F.col("a"), "s"), ["g"], ["k"], "a", F.lit(1500)).withColumnRenamed("admitted", "ok").collect()}
    monkeypatch.setattr(ledger, "WHOLE_GROUP", 500)
    spread = {(r.g, r.k): (r.s, r.ok) for r in ledger.admitted_prefix(ledger.running_sum(df, ["g"], ["k"], F.col("a"), "s"), ["g"], ["k"], "a", F.lit(1500)).withColumnRenamed("admitted", "ok").collect()}
    assert plain == spread and len(plain) == len(rows) and sum(ok for _, ok in plain.values()) < len(rows)


def test_contacts(spark):
    titles = spark.createDataFrame([("Owner",), ("Vice President, Inside Sales",), ("President",), ("Branch Mgr",), ("Branch Manager",), ("Chief of Staff",), (None,)], "t string")
    got = {r.t: r.r for r in titles.select("t", contacts.title_reason(F.col("t")).alias("r")).collect()}
    assert got == {
        "Owner": "direct_decision_maker:owner", "Vice President, Inside Sales": "functional_decision_maker:inside_sales", "President": "direct_decision_maker:president",
        "Branch Mgr": None, "Branch Manager": "operational_deputy:branch", "Chief of Staff": None, None: None,
    }
    schema = "contact_id string, company_id string, full_name string, title string, profile_url string, company_domain string, reason2 string"
    rows = [(f"k{k}", "c", f"N{k}", t, None, "x.test", "") for k, t in enumerate(["Sales Director", "Owner", "Estimating Director", "CEO", "Cook"])]
    rows += [("k9", "c", "n1", "Owner", None, "X.test ", ""), ("k8", None, "Z", "Owner", None, "x.test", ""), ("k7", "d", "Z", "Owner", None, None, "")]
    out = contacts.select_contacts(spark.createDataFrame(rows, schema)).orderBy("position").collect()
    assert [r.contact_id for r in out] == ["k1", "k3", "k2"]


def test_calibration(spark):
    df = spark.createDataFrame([("A", "x", 1.0, "i"), ("A", "y", None, "j"), ("B", "x", 4.0, "k"), (None, "x", 9.0, "l")], "label string, decision string, v double, id string")
    got = {r.label: (r.x, r.y) for r in calibration.confusion(df, "label", "decision", ["A", "B", "C"], ["x", "y"]).collect()}
    assert got == {"A": (1, 1), "B": (1, 0), "C": (0, 0)}
    assert {r.label: (r.n, r.mean) for r in calibration.metric_summary(df, "label", "v", 2).collect()} == {"A": (1, 1.0), "B": (1, 4.0)}
    assert [tuple(r) for r in calibration.disagreements(df, "label", "decision", "id", {"critical": [("A", "y")]}).collect()] == [("j", "critical")]


def test_ledger_files(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": "x", "v": 1}\n\n{"id": "y", "v": 2}\n{"id": "x", "v": 3}')
    (tmp_path / "b.jsonl").write_text('{"id": "y", "v": 4}\n{"id": "z", "v"')
    (tmp_path / "c.jsonl").write_text("")
    rows = read_ledger(spark, str(tmp_path), "id string, v int")
    assert {(r.id, r.v) for r in latest_records(rows, "id").collect()} == {("x", 3), ("y", 4)}
    for bad in ('{"id": 1\n', "[1]\n", '{"a": 1, "a": 2}\n'):
        (tmp_path / "d.jsonl").write_text(bad)
        with pytest.raises(Exception, match="bad ledger line"):
            read_ledger(spark, str(tmp_path)).collect()


def test_ledger_as_a_whole(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.jsonl").write_text('{"id": "x", "v": 1}\n' * 5)
    assert read_ledger(spark, str(tmp_path), all_bytes=1000, all_rows=15).count() == 15
    for bound in ({"all_bytes": 100}, {"all_rows": 14}):
        with pytest.raises(ValueError, match="more than"):
            read_ledger(spark, str(tmp_path), **bound)


def test_ledger_of_many_lines(spark, tmp_path):
    lines = ["" if k % 1000 == 7 else f'{{"id": {k}, "note": "é and some more text"}}' for k in range(1, 60_001)]
    (tmp_path / "a.jsonl").write_text("\n".join(lines) + '\n{"id": 60001, "no')
    (tmp_path / "b.jsonl").write_text("\n".join(lines[:2000]))
    rows = read_ledger(spark, str(tmp_path), "id long, note string").cache()
    assert rows.filter("id = line_no AND note = 'é and some more text'").count() == rows.count() == 59_940 + 1_998
    assert sorted(r.last for r in rows.groupBy("path").agg(F.max("line_no").alias("last")).collect()) == [2000, 60_000]
    rows.unpersist()
    (tmp_path / "b.jsonl").write_text("\n".join(lines[:1500] + ["[]"] + lines[1501:]))
    with pytest.raises(Exception, match="bad ledger line .*b.jsonl:1501"):
        read_ledger(spark, str(tmp_path)).collect()


def test_ledger_keeps_unknown_numbers(spark, tmp_path):
    from orebody.plans.files import ledger_files

    rows = [(1, 1, '{"k": 10}'), (2, 1, "{}"), (3, 2, '{"k": 50}'), (4, 2, '{"k": 49}'), (5, None, None), (6, 3, "{}"), (7, 3, '{"k": null}')]
    spark.createDataFrame(rows, "event_id long, user_id long, props string").write.parquet(str(tmp_path / "events.parquet"))
    assert {tuple(r) for r in ledger_files(spark, str(tmp_path)).collect()} == {(1, 2, None), (2, 4, 49), (None, 5, None), (3, 7, None)}


def test_canonical_lines(spark, tmp_path):
    from orebody.sources.sinks import canonical_lines

    df = spark.createDataFrame([({"b": 1.5, "a": 2.0}, (3, "é"), [1.0])], "z map<string,double>, a struct<y: int, x: string>, l array<double>")
    assert [r.value for r in canonical_lines(df).collect()] == ['{"a":{"x":"é","y":3},"l":[1.0],"z":{"a":2.0,"b":1.5}}']
    replace_json(df, str(tmp_path / "out"))
    for wrong in ([({"b": float("nan")}, None, None)], [(None, None, [float("inf")])]):
        with pytest.raises(Exception, match="a number that is none"):
            replace_json(spark.createDataFrame(wrong, df.schema), str(tmp_path / "out"))
    with pytest.raises(Exception, match="over its bound"):
        replace_json(df, str(tmp_path / "out"), record_bytes=10)
    assert spark.read.text(str(tmp_path / "out")).count() == 1


def test_progress_with_constant_columns(spark):
    rows = [("k", 1, 0, "a"), ("k", 2, 1, "a"), ("k", 3, 1, None), ("k", 4, 1, None), ("k", 5, 0, None), ("j", 1, 5, None)]
    df = spark.createDataFrame(rows, "k string, n int, r int, c string")
    assert [r.n for r in ledger.regressions(df, ["k"], ["n"], F.col("r"), constant=["c"]).orderBy("n").collect()] == [3, 5]
    assert [r.n for r in ledger.regressions(df, ["k"], ["n"], F.col("r")).collect()] == [5]


def test_labels(spark, tmp_path):
    known = spark.createDataFrame([("c1",), ("c2",)], "company_id string")
    path = tmp_path / "l.csv"
    path.write_text('extra,company_id,manual_label,manual_notes\nq,c1, a ,"two\nlines"\nq,c2,B,\n')
    assert {(r.company_id, r.manual_label) for r in read_labels(spark, str(path), known).collect()} == {("c1", "A"), ("c2", "B")}
    with pytest.raises(ValueError, match="rows"):
        read_labels(spark, str(path), known, most=1)
    path.write_bytes(b"company_id,manual_label,manual_notes\nc1,A,caf\xe9\n")
    with pytest.raises(ValueError, match="encoding"):
        read_labels(spark, str(path), known)
    for body in ("c1,A\nc1,B\n", "c3,A\n", "c1,D\n", "=c1,A\n", ",A\n"):
        path.write_text("company_id,manual_label\n" + body)
        with pytest.raises(ValueError):
            read_labels(spark, str(path), known)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", None), ("a", 1)], "z string, y int")
    target = str(tmp_path / "out")
    for _ in range(2):
        replace_json(df, target)
    lines = [r.value for r in spark.read.text(target).collect()]
    assert sorted(lines) == ['{"y":1,"z":"a"}', '{"y":null,"z":"b"}']
    append_json(df, target)
    assert spark.read.text(target).count() == 4
    replace_csv(df, str(tmp_path / "csv"), ["z"])
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 2
    assert sorted(p.name for p in tmp_path.iterdir()) == ["csv", "out"]


def test_usage_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    event = lambda i, p, n, c, t: json.dumps({"dispatch_id": i, "provider": p, "request_count": n, "cost_usd": c, "recorded_at": t})
    (source / "1.json").write_text("\n".join([event("d1", "exa", 2, 0.5, "2025-01-01T10:00:00Z"), event("d1", "exa", 2, 0.5, "2025-01-01T10:00:00Z"), event("d2", "exa", 1, None, "2025-01-01T11:00:00Z")]))
    query = once(usage_stream(spark, str(source))).writeStream.format("memory").queryName("seen").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    query.awaitTermination()
    out = {(r.w.start.hour, r.request_count, r.cost_usd) for r in totals(spark.table("seen")).collect()}
    assert {x[1:] for x in out} == {(2, 0.5), (1, None)}


def test_support(spark):
    from orebody.operators.support import support

    rows = [("c", "We sell valves. We do not sell pipe; quotes are slow"), ("c", "Nous notons la vente"), ("d", None), (None, "We sell pipe"), ("e", "")]
    out = {(r.c, r.fact): (r.stated, r.denied) for r in support(spark.createDataFrame(rows, "c string, t string"), "c", "t").collect()}
    assert out == {("c", "pvf_relevant"): (1, 1)}


def test_every_contact_has_a_place(spark, tmp_path):
    schema = "contact_id string, company_final_score double, decision_rank int, full_name string, observed_at timestamp_ntz"
    rows = spark.range(1201).selectExpr(
        "concat('k', id)", "CASE WHEN id % 7 > 0 THEN CAST(id % 7 AS double) END", "CASE WHEN id % 5 > 0 THEN CAST(id % 5 AS int) END",
        "CASE WHEN id % 11 > 0 THEN concat('n', id % 11) END", "timestamp_ntz'2026-01-01 00:00:00'",
    ).toDF(*[c.split()[0] for c in schema.split(", ")])
    rows.union(rows.limit(9)).repartition(5).write.parquet(str(tmp_path / "contact_records.parquet"))
    last = lambda v: (v is None, v)
    key = lambda r: (last(r.company_final_score and -r.company_final_score), last(r.decision_rank), last(r.full_name), r.contact_id)
    want = {r.contact_id: k for k, r in enumerate(sorted(rows.collect(), key=key), 1)}
    assert {r.contact_id: r.place for r in domain.publication_order(spark, str(tmp_path)).collect()} == want
    assert numbered(rows.limit(0), [F.col("contact_id")], "place").isEmpty()
