import json
import random
import re

import pytest
from pyspark.sql import functions as F

from orebody.functions.text import phrase_count
from orebody.functions.values import canonical_text
from orebody.operators import contacts, evidence, facts, ledger, propositions, ranking
from orebody.operators import vocabulary as v
from orebody.sources import documents

ITEMS = "company_id string, evidence_id string, title string, excerpt string, supported string"
FACTS = "company_id string, fact_key string, value string, confidence double, evidence_ids array<string>"
STATED = (
    "Industrial pipe, valves, and fittings. We serve industrial customers. Branch count 5. Inside sales team. RFQ workflow. Project tender business. BOM line items. "
    "Manufacturer count 20. Relevant hiring. Employee count 50. Regional independent distributor. Multiple locations. No competitor customer. No quote automation. "
    "Direct quotation pain. Manual workflow. Process bottleneck."
)

CASES = [
    ("pvf_relevant", False, "We do not sell or distribute pipe, valves, or fittings.", True), ("pvf_relevant", True, "Industrial pipe, valves, and fittings.", True),
    ("pvf_relevant", True, "We build electrical control panels.", False), ("branch_count", 3, "We operate 3 branch locations across the region.", True),
    ("branch_count", 3, "The company was founded in 3 states decades ago.", False), ("pvf_relevant", False, "We do not manufacture pipe and distribute industrial valves.", False),
    ("pvf_relevant", False, "We do not sell pipe, but we distribute industrial valves.", False), ("branch_count", 3, "3 employees work at our branch.", False),
    ("rfq_or_quote_workflow_evidence", False, "Our RFQ workflow is online, not manual.", False), ("pvf_relevant", False, "We do not manufacture or sell pipe.", True),
    ("pvf_relevant", False, "Pipe products. We do not sell pipe.", True), ("pvf_relevant", False, "We do not distribute industrial valves.", True),
    ("industrial_or_process_customer_focus", False, "We do not serve industrial customers.", True), ("pvf_relevant", False, "We do not sell pipe. We are a PVF distributor of valves.", False),
    ("pvf_relevant", False, "We do not sell, distribute, or stock pipe.", True), ("pvf_relevant", False, "We do not sell pipe or distribute valves.", True),
    ("pvf_relevant", False, "We are not a PVF distributor of valves.", True), ("pvf_relevant", False, "We are not a manufacturer. We distribute industrial valves.", False),
    ("revenue_if_reliably_available", 1200000, "Revenue of $1,200,000 last year", True), ("revenue_if_reliably_available", 1200, "Revenue grew; 1200 orders", False),
    ("manufacturer_count_or_breadth", ["Acme", "Bolt"], "One brand: Acme. Another brand: Bolt", False), ("manufacturer_count_or_breadth", ["Acme", "Nut"], "The brands Acme, Bolt", False),
    ("manufacturer_count_or_breadth", ["Acme", "Bolt"], "Our line card lists Acme, Bolt", True), ("multi_location_signal", True, "Multiple locations", False), ("employee_count", 50.0, "Employee count 50", True), ("manual_workflow_evidence", True, "No longer any manual workflow", False), ("no_such_fact", True, "manual workflow", False),
    ("pvf_relevant", None, "", True), ("regional_independent_signal", "Regional", "A REGIONAL house", True),
] + [(k, x, STATED, True) for k, x in {
    "pvf_relevant": True, "industrial_or_process_customer_focus": True, "branch_count": 5, "inside_sales_or_estimating_presence": True, "rfq_or_quote_workflow_evidence": True,
    "project_or_tender_business": True, "bom_or_line_item_complexity": True, "manufacturer_count_or_breadth": 20, "relevant_hiring": True, "employee_count": 50,
    "regional_independent_signal": True, "known_current_direct_competitor_customer": False,
    "known_quote_automation_or_order_automation_relationship": False, "direct_quotation_pain_evidence": True, "manual_workflow_evidence": True, "explicit_process_bottleneck_evidence": True,
}.items()]


def test_supported_facts(spark):
    items = [(f"c{n}", "e", None, text, "x") for n, (_, _, text, _) in enumerate(CASES)] * 2 + [("c0", "f", "We sell pipe.", None, "x"), ("d", "e", "We sell pipe", "", "x")]
    told = [(f"c{n}", k, json.dumps(x), 0.9, ["e", "e"]) for n, (k, x, _, _) in enumerate(CASES)]
    told += [("d", "pvf_relevant", "true", 0.5, []), ("d", "pvf_relevant", "true", 0.6, None), ("d", "pvf_relevant", "true", 0.7, ["gone"]), ("d", "pvf_relevant", "true", 0.8, ["e"])]
    told += [("c0", "pvf_relevant", "false", 0.2, ["e", "f"]), ("d", "pvf_relevant", None, 0.1, [])]
    frames = spark.createDataFrame(told, FACTS), spark.createDataFrame(items, ITEMS)
    out = propositions.supported(*frames)
    got = {(r.company_id, r.confidence): r.supported for r in out.collect()}
    wrong = [CASES[n] for n in range(len(CASES)) if got[f"c{n}", 0.9] != CASES[n][3]]
    assert not wrong
    assert [got["d", c] for c in (0.5, 0.6, 0.7, 0.8, 0.1)] == [False, False, False, True, True] and got["c0", 0.2] is False  # vetoed by another item
    kept = {(r.company_id, r.value): (r.confidence, r.evidence_ids) for r in propositions.canonical(out).filter("company_id = 'd'").collect()}
    assert kept == {("d", "null"): (0.0, []), ("d", "true"): (0.8, ["e"]), ("d", None): (0.1, [])}
    assert propositions.supported(frames[0].limit(0), frames[1]).isEmpty() and propositions.supported(frames[0], frames[1].limit(0)).filter("supported").count() == 2


def test_every_fact_has_its_words():
    assert set(v.FACT_KEYS) == set(v.PREDICATES) == set(v.TERMS) == set(v.CONCEPTS) and len(v.FACT_KEYS) == 20
    assert [propositions.mentions("bill  of\nmaterials, bills of materials", ("bill of materials",))] == [[(0, 18)]]


def test_denials_against_sql():
    import duckdb

    from orebody.plans.evaluation import ORACLE

    rng = random.Random(3)
    words = "we,do not,don't,never,are not,no,without,currently,a,the,industrial,pvf,pipe,valves,fittings,sell,sells,distributor,distribution,stock,supply,or,nor,\x2c,manufacture,make,of,steel,for,carry".split(",")
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(3, 9))).replace(" \x2c", ",") for _ in range(3000)]
    con = duckdb.connect()
    con.execute("CREATE TABLE evidence_items AS SELECT i::VARCHAR AS company_id, 'e' AS evidence_id, NULL::VARCHAR AS title, t AS excerpt, NULL::TIMESTAMP AS deleted_at FROM (SELECT unnest(?) AS t, unnest(?) AS i)", [texts, list(range(len(texts)))])
    want = {int(c): (yes, no) for c, yes, no in con.execute(ORACLE["relevance_facts"]).fetchall()}
    for n, text in enumerate(texts):
        clauses = [c.casefold() for c in re.split(v.CLAUSE_END, text, flags=re.IGNORECASE)]
        verdicts = [propositions.judge("pvf_relevant", False, c) for c in clauses]
        got = any(propositions.judge("pvf_relevant", True, c)[0] for c in clauses), any(a for a, _ in verdicts) and not any(b for _, b in verdicts)
        assert got == want[n], text
    assert 50 < sum(no for _, no in want.values()) < 2000


def answer(**over):
    told = {k: {"value": None, "confidence": 0, "evidence_ids": []} for k in v.FACT_KEYS} | over
    return json.dumps({"choices": [{"finish_reason": "stop", "message": {"content": json.dumps({"facts": told})}}]})


def test_answers(spark):
    fact = lambda value, confidence=0.5, ids=("e1",): {"value": value, "confidence": confidence, "evidence_ids": list(ids)}
    good = answer(branch_count=fact(3), relevant_hiring=fact(True, 1), manufacturer_count_or_breadth=fact(["a"]), revenue_if_reliably_available=fact(1.5))
    bad = {
        "shape": {"value": 1, "confidence": 0.5}, "value": fact({"a": 1}), "value2": fact([1]), "confidence": fact(1, True), "confidence2": fact(1, 1.5), "confidence3": fact(1, "1"),
        "citations": fact(1, ids=("a", "a")), "citations2": {"value": 1, "confidence": 1, "evidence_ids": [1]}, "citations3": {"value": 1, "confidence": 1, "evidence_ids": "e1"},
        "unknown": fact(None, 0.5, ()), "unknown2": fact(None, 0), "unknown3": fact(1, 0.5, ()),
    }
    whole = json.loads(good)
    broken = [None, "", "{", "[]", json.dumps({"choices": whole["choices"] * 2}), good.replace('"stop"', '"length"'), json.dumps({"choices": [{"finish_reason": "stop", "message": {"content": " "}}]}),
              good.replace('{\\"facts\\"', '{\\"facts\\": 1, \\"facts\\"'), good.replace('\\"branch_count\\"', '\\"branches\\"')]
    rows = [("good", good)] + [(k, answer(branch_count=x)) for k, x in bad.items()] + [(f"b{n}", x) for n, x in enumerate(broken)]
    out = facts.answers(spark.createDataFrame(rows, "company_id string, body string"))
    found = {}
    for r in out.collect():
        if r.problem:
            found.setdefault(r.company_id, set()).add((r.fact_key, r.problem))
    assert found == {k: {("branch_count", re.sub(r"\d", "", k))} for k in bad} | {f"b{n}": {(None, "envelope")} for n in range(len(broken))}
    told = {r.fact_key: r.value for r in out.filter("company_id = 'good'").collect()}
    assert (told["branch_count"], told["relevant_hiring"], told["manufacturer_count_or_breadth"], told["employee_count"]) == ("3", "true", '["a"]', "null")
    items = spark.createDataFrame([("good", "e1", None, "3 branch offices; we are hiring", "x")], ITEMS)
    assert {r.company_id for r in facts.accepted(out, items).collect()} == {"good"}
    assert facts.accepted(out, items.limit(0)).isEmpty()
    assert {(r.fact_key, r.evidence_id) for r in facts.unretained(out.filter("company_id = 'good'"), items.limit(0)).collect()} == {
        (k, "e1") for k in ("branch_count", "relevant_hiring", "manufacturer_count_or_breadth", "revenue_if_reliably_available")}
    companies = spark.createDataFrame([("good", {"research": "pending", "x": "y"}), ("none", {"x": "y"})], "company_id string, stage_status map<string,string>")
    done = {r.company_id: r for r in facts.applied(companies, facts.accepted(out, items), items).collect()}
    assert done["good"].features["branch_count"] == "3" and done["good"].features["relevant_hiring"] == "true" and done["good"].features["revenue_if_reliably_available"] == "null"
    assert done["good"].feature_confidence["revenue_if_reliably_available"].confidence == 0.0 and done["good"].stage_status == {"research": "completed", "extraction": "completed", "x": "y"}
    assert done["none"].features is None and done["none"].stage_status == {"x": "y"}


def test_item_problems_and_lists(spark):
    items = spark.createDataFrame([("a", "e"), ("a", "e"), ("a", None), ("b", "e"), ("c", "")], "company_id string, evidence_id string")
    assert {tuple(r) for r in facts.item_problems(items).collect()} == {("a", 1, 1), ("c", 1, 0)}
    df = spark.createDataFrame([([" A", "a", "", None, "b"], ["z"]), (None, None)], "x array<string>, y array<string>")
    assert [tuple(r) for r in df.select(facts.distinct_entries(F.col("x")), facts.citation_union(F.col("x"), F.col("y"))).collect()] == [(2, ["", " A", "a", "b", "z"]), (None, [])]
    keys = spark.createDataFrame([('{"a": 1, "b": null}',), ('{"a": 1}',), ("[1]",), (None,), ("x",)], "j string")
    assert [r[0] for r in keys.select(facts.exact_keys(F.try_parse_json("j"), ["b", "a"])).collect()] == [True, False, False, False, False]


def test_ranking_and_sheets(spark):
    schema = "company_id string, name string, normalized_name string, final_decision string, final_score double, coverage double"
    rows = [("c1", "Zed", None, "accepted", 90.0, 0.5), ("c2", " ann  LEE ", "", "accepted", 90.0, 0.5), ("c3", "x", "x", "accepted", 90.0, 0.9), ("c4", "x", "x", "accepted", None, 1.0),
            ("c5", "x", "x", "rejected", 99.0, 1.0), ("c6", "x", "x", "uncertain", None, None), ("c8", "x", "x", None, 1.0, 1.0), ("c7", None, None, "uncertain", None, None)]
    df = spark.createDataFrame(rows, schema)
    random.Random(1).shuffle(rows)
    again = spark.createDataFrame(rows, schema)
    want = ["c3", "c2", "c1", "c4", "c7", "c6", "c5", "c8"]
    for frame in (df, again):
        assert [r.company_id for r in ranking.ranked(frame).orderBy("place").collect()] == want
    assert ranking.ranked(df.limit(0)).isEmpty()
    one = spark.createDataFrame(
        [("c", "=cmd", "d.test", None, None, "1", 84.905, "accepted", ["a", "b"], None, {"workload": 62.5, "economic_fit": None}, {"workload": 0.4, "overall": 0.39751})],
        "company_id string, name string, domain string, normalized_domain string, country string, policy_version string, final_score double, final_decision string, "
        "review_reasons array<string>, rejection_reasons array<string>, score_components map<string,double>, coverage map<string,double>",
    )
    labels = spark.createDataFrame([("c", "A", "-x")], "company_id string, manual_label string, manual_notes string")
    (r,) = ranking.with_labels(ranking.company_sheet(one), labels).collect()
    assert len(ranking.COMPANY_SHEET) == 18 and len(ranking.CONTACT_SHEET) == 14
    assert tuple(r) == ("c", "'=cmd", "d.test", "", "1", "62.50", "0.4000", "", "0.0000", "", "0.0000", "", "0.0000", "0.3975", r.final_score, "accepted", "a;b", "", "A", "'-x")
    (r,) = ranking.with_labels(ranking.company_sheet(one), labels.limit(0)).collect()
    assert (r.manual_label, r.manual_notes) == ("", "")


def test_usage_and_enrichment(spark):
    schema = "provider string, operation string, request_count long, input_tokens long, output_tokens long, estimated_cost_usd double, exact_cost_usd double, metadata string, recorded_at string"
    ok = ("p", "o", 1, 0, 0, None, 0.5, "{}", "t")
    change = {0: [("", "provider"), (None, "provider")], 2: [(-1, "request_count"), (None, "request_count")], 5: [(-0.1, "estimated_cost_usd"), (float("nan"), "estimated_cost_usd")], 7: [("[]", "metadata"), (None, "metadata"), ("{", "metadata")], 8: [("", "recorded_at")]}
    rows = [(ok, None)] + [(ok[:n] + (x,) + ok[n + 1 :], p) for n, more in change.items() for x, p in more]
    events = spark.createDataFrame([r for r, _ in rows], schema)
    assert [r.p for r in events.select(ledger.usage_problem().alias("p")).collect()] == [p for _, p in rows]
    assert ledger.checked(events.limit(1)).count() == 1 and ledger.combined(events, events.limit(1)).count() == len(rows) + 1
    with pytest.raises(Exception, match="bad usage event"):
        ledger.checked(events).collect()
    items = [(1, {"id": "k1", "result": {"Work Email": "A@x.example"}}), (2, {"id": "k1", "result": {"Work Email": "me@gmail.com", "work_email": "b@x.example"}}),
             (3, {"id": "k2", "work_email": "nope"}), (4, {"id": "other", "work_email": "z@x.example"}), (5, {"work_email": "z@x.example"}), (6, [])]
    people = spark.createDataFrame([("k1", None, None), ("k2", "old@x.example", "apollo"), ("k3", None, None)], "contact_id string, work_email string, email_source string")
    out = contacts.enriched(people, spark.createDataFrame([(n, json.dumps(x)) for n, x in items] + [(7, None)], "position int, item string"))
    assert {tuple(r) for r in out.collect()} == {("k1", "b@x.example", "clay"), ("k2", "old@x.example", "apollo"), ("k3", None, None)}
    payloads = ['{"credits_consumed": null, "credits_used": 2}', '{"usage": {"credits_used": 1.5}}', "{}", '{"usage": 3}']
    df = spark.createDataFrame([(p,) for p in payloads], "p string").select(contacts.reported_credits(F.parse_json("p")).alias("c"))
    assert [r.c for r in df.collect()] == [2.0, 1.5, None, None]
    for wrong in ('{"credits_used": -1}', '{"credits_used": "1"}', '{"credits_used": true}'):
        with pytest.raises(Exception, match="credits must be"):
            spark.createDataFrame([(wrong,)], "p string").select(contacts.reported_credits(F.parse_json("p"))).collect()


def test_documents(spark, tmp_path):
    path = str(tmp_path / "d.json")
    assert documents.read_document(spark, path) is None
    for value in ({"b": [1, "é"], "a": None}, {"a": 2}):
        documents.replace_document(spark, path, value)
        assert documents.read_document(spark, path) == value
    assert (tmp_path / "d.json").read_text() == '{\n  "a": 2\n}\n'
    with pytest.raises(ValueError):
        documents.replace_document(spark, path, {"a": float("nan")})
    with pytest.raises(ValueError):
        documents.read_document(spark, path, most=3)
    for text in ("[1]", "{"):
        (tmp_path / "e.json").write_text(text)
        with pytest.raises(ValueError):
            documents.read_document(spark, str(tmp_path / "e.json"))
    sheet = tmp_path / "s.csv"
    assert documents.read_sheet(spark, str(sheet), ["a"]).isEmpty()
    sheet.write_text('b,a,c\n"x\n,y",,1\n')
    assert [tuple(r) for r in documents.read_sheet(spark, str(sheet), ["a", "b"]).collect()] == [("", "x\n,y")]
    with pytest.raises(ValueError):
        documents.read_sheet(spark, str(sheet), ["z"])
    bodies = spark.createDataFrame([("é" * 3, None), ("abcde", 9), (None, None), ("", 1)], "body string, length long")
    assert [tuple(r) for r in documents.within_size(bodies, declared="length", most=5).select("body", "too_large").collect()] == [(None, True), (None, True), (None, False), ("", False)]
    (tmp_path / ".env").write_text("﻿# c\n\nA=1 # x\nexport B='q # r'\nA=2\nC=\nD=kept\n")
    assert documents.read_settings(str(tmp_path / ".env"), {"D": "own"}) == {"A": "1", "B": "q # r", "C": ""}
    assert documents.read_settings(str(tmp_path / "none"), {}) == {}
    (tmp_path / ".env").write_text("A=1\nnonsense\n")
    with pytest.raises(ValueError, match="line 2"):
        documents.read_settings(str(tmp_path / ".env"), {})


def test_small_functions(spark):
    df = spark.createDataFrame([('{"b": {"updated_at": 1, "z": [1.0, {"created_at": 2}]}, "a": "é"}',), (None,)], "j string")
    assert [r[0] for r in df.select(canonical_text(F.col("j"), ("created_at", "updated_at"))).collect()] == ['{"a":"é","b":{"z":[1.0,{}]}}', None]
    with pytest.raises(Exception, match="no JSON number"):
        spark.createDataFrame([("[NaN]",)], "j string").select(canonical_text(F.col("j"))).collect()
    texts = spark.createDataFrame([("Bill  of\nmaterials; bill of materials_2, éinside sales",), ("",), (None,)], "t string")
    assert [tuple(r) for r in texts.select(phrase_count(F.col("t"), "bill of materials"), phrase_count(F.col("t"), "inside sales")).collect()] == [(1, 0), (0, 0), (None, None)]


def test_companies_seen_abroad_are_not_researched(spark):
    rows = [("a", "x.test", None, ["CONFLICTING_COUNTRY", "OUTSIDE_GEOGRAPHY"], 1, 1), ("b", None, "US", [], 1, 1), ("c", "x.test", None, None, 1, 1), ("d", "x.test", "MX", [], 1, 1)]
    df = spark.createDataFrame(rows, "company_id string, domain string, country string, review_reasons array<string>, n_sources long, n_records long")
    assert [r.company_id for r in evidence.research_order(df).collect()] == ["c", "b"]
