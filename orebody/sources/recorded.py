"""Recorded provider responses as rows: company searches, places, pages of evidence, people.

A response table has request_id, retrieved_at and body, the JSON text as received. Bodies are parsed once into VARIANT
and read by path in the JVM; what is no string, or empty, is null, so a number is never taken for a name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebody.functions.text import normalize_company_name, normalize_person_name
from orebody.functions.url import page_url, profile_url
from orebody.functions.values import digest_id, text_at
from orebody.operators.contacts import relevance, title_rank, title_reason
from orebody.operators.identity import RECORD
from orebody.operators.topn import first_n

SNIPPET = 2000


def _list_at(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "array<variant>")


def _is_object(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))


def _lines(value: Column, path: str) -> Column:
    """The strings of a list, a line each; null without any."""
    parts = F.filter(_list_at(value, path), lambda x: F.schema_of_variant(x) == "STRING")
    return F.nullif(F.array_join(F.transform(parts, lambda x: F.variant_get(x, "$", "string")), "\n"), F.lit(""))


def results(responses: DataFrame, path: str = "$.results", most: int | None = None) -> DataFrame:
    """One row per result object, in its position; bodies that are no JSON, or repeat a key, have none."""
    parsed = responses.withColumn("_body", F.try_parse_json("body"))
    rows = parsed.select(*[c for c in responses.columns if c != "body"], F.posexplode(_list_at(F.col("_body"), path)).alias("position", "raw"))
    rows = rows.filter(_is_object(F.col("raw")))
    return rows if most is None else rows.filter(F.col("position") < most)


def company_entity(raw: Column) -> Column:
    """The first entity typed company, else the first without a type, else the single entity."""
    kind = lambda x: F.coalesce(text_at(x, "$.type"), text_at(x, "$.entityType"))
    all_of = F.filter(_list_at(raw, "$.entities"), _is_object)
    typed = F.try_element_at(F.filter(all_of, lambda x: F.lower(kind(x)) == "company"), F.lit(1))
    untyped = F.try_element_at(F.filter(all_of, lambda x: kind(x).isNull()), F.lit(1))
    single = F.try_variant_get(raw, "$.entity", "variant")
    return F.coalesce(typed, untyped, F.when(_is_object(single), single))


def _with_id(rows: DataFrame, provider: str, told: list[str]) -> DataFrame:
    """record_id from the provider's own id, else from what was told and the whole row."""
    named = F.to_json(F.array(F.lit(provider), "request_id", "provider_result_id"))
    seen = F.to_json(F.struct(*sorted(told)), {"ignoreNullFields": "false"})
    whole = F.concat(F.lit('["'), F.lit(provider), F.lit('",'), F.to_json(F.array("request_id")), F.lit(","), seen, F.lit(","), "raw_metadata", F.lit("]"))
    return rows.withColumn("record_id", digest_id("raw_", F.when(F.col("provider_result_id").isNotNull(), named).otherwise(whole)))


def _records(rows: DataFrame, requests: DataFrame, provider: str, told: list[str]) -> DataFrame:
    known = requests.select("request_id", "target_country_code", F.try_element_at("queries", F.lit(1)).alias("first_query"))
    joined = rows.withColumn("raw_metadata", F.to_json("raw")).join(known, "request_id")
    joined = joined.withColumns({"provider": F.lit(provider), "query": F.coalesce("query", "first_query") if "query" in rows.columns else F.col("first_query")})
    return _with_id(joined, provider, told).select(*RECORD)


def search_records(responses: DataFrame, requests: DataFrame) -> DataFrame:
    """Discovery records of company searches."""
    rows = results(responses).withColumn("entity", company_entity(F.col("raw")))
    properties = F.try_variant_get("entity", "$.properties", "variant")
    rows = rows.withColumn("p", F.when(_is_object(properties), properties).otherwise(F.col("entity")))
    entity, p, raw = F.col("entity"), F.col("p"), F.col("raw")
    first = lambda *xs: F.coalesce(*xs)
    rows = rows.withColumns({
        "provider_result_id": first(text_at(entity, "$.id"), text_at(p, "$.id"), text_at(raw, "$.id")),
        "title": text_at(raw, "$.title"),
        "name": first(text_at(p, "$.name"), text_at(entity, "$.name"), text_at(raw, "$.title")),
        "source_url": text_at(raw, "$.url"),
        "website_url": text_at(raw, "$.url"),
        "city": text_at(p, "$.headquarters.city"),
        "region": F.lit(None).cast("string"),
        "postal_code": first(text_at(p, "$.headquarters.postalCode"), text_at(p, "$.headquarters.postal_code")),
        "country_code": first(text_at(p, "$.headquarters.countryCode"), text_at(p, "$.headquarters.country_code"), text_at(p, "$.headquarters.country")),
        "snippet": F.substring(_lines(raw, "$.highlights"), 1, SNIPPET),
    })
    return _records(rows, requests, "exa", ["name", "source_url", "city", "postal_code", "country_code"])


def place_records(responses: DataFrame, requests: DataFrame) -> DataFrame:
    """Discovery records of place searches; the body is the list of places itself."""
    raw = F.col("raw")
    at = lambda *paths: F.coalesce(*[text_at(raw, f"$.{x}") for x in paths])
    rows = results(responses, "$").withColumns({
        "provider_result_id": at("placeId", "cid"), "source_url": at("url", "googleMapsUrl"), "name": at("title"), "title": at("title"),
        "website_url": at("website"), "city": at("city"), "region": at("state", "region"), "postal_code": at("postalCode"),
        "country_code": at("countryCode"), "query": at("searchString"), "snippet": at("description", "categoryName"),
    })
    return _records(rows, requests, "apify", ["name", "website_url", "city", "region", "postal_code", "country_code"])


def evidence_items(responses: DataFrame) -> DataFrame:
    """Pages with their excerpts: (request_id, position, evidence_id, url, title, excerpt, retrieved_at); results without
    a proper address are left out, and none gets an excerpt that was not sent."""
    rows = results(responses)
    rows = rows.withColumns({"url": text_at(F.col("raw"), "$.url"), "title": text_at(F.col("raw"), "$.title"), "excerpt": _lines(F.col("raw"), "$.highlights")})
    rows = rows.withColumn("_page", page_url(F.col("url"))).filter(F.col("_page").isNotNull())
    preimage = F.to_json(F.array(F.lit("exa"), "_page", "excerpt"))
    return rows.select("request_id", "position", digest_id("ev_", preimage).alias("evidence_id"), "url", "title", "excerpt", "retrieved_at")


def people(responses: DataFrame, companies: DataFrame, most: int = 10) -> DataFrame:
    """Each person's best current role at the company asked about.

    ``responses`` carry company_id; ``companies``: company_id, name. A role is current when its end is stated as null
    (present, not absent), and at the company when the employer's normal form is the company's. The best is the lowest
    rank, then relevance, then title.
    """
    rows = results(responses, most=most).join(companies.select("company_id", normalize_company_name(F.col("name")).alias("_company")), "company_id")
    person = F.try_element_at(F.filter(_list_at(F.col("raw"), "$.entities"), lambda x: text_at(x, "$.type") == "person"), F.lit(1))
    rows = rows.withColumn("_person", person).withColumns({
        "full_name": F.trim(text_at(F.col("_person"), "$.properties.name")),
        "profile": text_at(F.col("raw"), "$.url"),
        "_role": F.explode(_list_at(F.col("_person"), "$.properties.workHistory")),
    })
    ended = F.try_variant_get("_role", "$.dates.to", "variant")
    rows = rows.withColumns({"title": F.trim(text_at(F.col("_role"), "$.title")), "_employer": normalize_company_name(text_at(F.col("_role"), "$.company.name"))})
    current = rows.filter(F.coalesce(F.is_variant_null(ended), F.lit(False)) & (F.col("_employer") == F.col("_company")) & (F.col("full_name") != ""))
    ranked = current.withColumn("reason", title_reason(F.col("title"))).filter(F.col("reason").isNotNull()).withColumn("rank", title_rank(F.col("reason")))
    order = [F.col("rank"), relevance(F.col("reason")), normalize_person_name(F.col("title")), F.col("reason")]
    best = first_n(ranked, ["company_id", "request_id", "position"], order, 1)
    return best.select("company_id", "request_id", "position", "full_name", "title", "rank", "reason", profile_url(F.col("profile")).alias("profile_url"))
