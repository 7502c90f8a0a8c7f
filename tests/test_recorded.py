import hashlib
import json

from orebody.sources import recorded

REQUESTS = [("q1", "US", ["pumps houston", "x"])]


def tables(spark, body, request="q1"):
    responses = spark.createDataFrame([(request, "2026-01-01T00:00:00Z", body if isinstance(body, str) else json.dumps(body))], "request_id string, retrieved_at string, body string")
    return responses, spark.createDataFrame(REQUESTS, "request_id string, target_country_code string, queries array<string>")


def test_search_records(spark):
    body = {"results": [
        {"id": "top", "url": "https://a.com", "title": "T", "highlights": ["one", 5, "two"],
         "entities": [{"type": "person", "id": "p"}, {"type": "Company", "id": "e1", "properties": {"name": "Acme", "headquarters": {"city": "Houston", "postalCode": 77001, "country": "US"}}}]},
        {"title": "Only title", "entities": [{"name": "Untyped"}], "highlights": []}, {"entity": {"name": "Single", "id": ""}}, "noise", 7,
    ]}
    rows = recorded.search_records(*tables(spark, body)).orderBy("name").collect()
    assert [r.name for r in rows] == ["Acme", "Single", "Untyped"]
    acme = rows[0]
    assert (acme.provider_result_id, acme.city, acme.postal_code, acme.country_code, acme.snippet, acme.query) == ("e1", "Houston", None, "US", "one\ntwo", "pumps houston")
    assert acme.record_id == "raw_" + hashlib.sha256(b'["exa","q1","e1"]').hexdigest()[:24]
    assert rows[2].title == "Only title" and rows[2].snippet is None and rows[1].record_id != rows[2].record_id
    assert recorded.search_records(*tables(spark, "{broken")).isEmpty()
    assert recorded.search_records(*tables(spark, '{"results": 3}')).isEmpty()


def test_place_records(spark):
    body = [{"cid": "9", "title": "Acme", "googleMapsUrl": "https://m", "state": "TX", "categoryName": "Valves", "website": "", "searchString": "s"}]
    (r,) = recorded.place_records(*tables(spark, body)).collect()
    assert (r.provider_result_id, r.source_url, r.region, r.snippet, r.website_url, r.query, r.provider) == ("9", "https://m", "TX", "Valves", None, "s", "apify")


def test_evidence_items(spark):
    body = {"results": [{"url": "HTTPS://A.com#f", "highlights": ['say "é"', "b"], "title": "t"}, {"url": "nope"}, {"url": "https://b.com", "highlights": []}]}
    rows = recorded.evidence_items(tables(spark, body)[0]).orderBy("position").collect()
    want = lambda *x: "ev_" + hashlib.sha256(json.dumps(["exa", *x], ensure_ascii=False, separators=(",", ":")).encode()).hexdigest()[:24]
    assert [r.evidence_id for r in rows] == [want("https://a.com/", 'say "é"\nb'), want("https://b.com/", None)]


def test_people(spark):
    role = lambda title, **dates: {"title": title, "company": {"name": "ACME Inc."}, "dates": dates}
    person = lambda name, *roles: {"url": "https://www.linkedin.com/in/x/", "entities": [{"type": "person", "properties": {"name": name, "workHistory": list(roles)}}]}
    body = {"results": [
        person("Ana", role("Branch Manager", to=None), role("Owner", to=None)), person("Bo", role("CEO", to="2020")), person("Cy", role("CEO")),
        person("Di", {"title": "CEO", "company": {"name": "Other"}, "dates": {"to": None}}), person(" ", role("CEO", to=None)), person("Ed", role("Cook", to=None)),
    ]}
    responses = tables(spark, body)[0].selectExpr("'c1' AS company_id", "*")
    companies = spark.createDataFrame([("c1", "Acme")], "company_id string, name string")
    out = [(r.full_name, r.title, r["rank"], r.profile_url) for r in recorded.people(responses, companies).collect()]
    assert out == [("Ana", "Owner", 1, "https://linkedin.com/in/x")]
