"""Exact identity resolution: by domain first, by name and place where there is none."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orebody.functions.geo import country_code, location, region_code
from orebody.functions.text import normalize_company_name, normalize_text
from orebody.functions.url import company_domain
from orebody.functions.values import digest_id, instant
from orebody.session import cut_lineage

RECORD = (
    "record_id", "provider", "request_id", "target_country_code", "query", "provider_result_id", "name", "source_url", "website_url", "city",
    "region", "postal_code", "country_code", "title", "snippet", "raw_metadata", "retrieved_at",
)
FIRST_PROVIDER = "exa"
HOME = ("US", "CA")


@dataclass
class Identities:
    """companies: one row per identity. members: every named or sited record with its company. unresolved: the rest."""

    companies: DataFrame
    members: DataFrame
    unresolved: DataFrame


def prepare(records: DataFrame) -> DataFrame:
    """Identity columns beside the record: name, city, region, country, domain, the fallback key, the place, the instant."""
    # Columns that are strings stay what they are: a second name of each would make the planner weigh all their combinations.
    text = [F.col(c) if isinstance(records.schema[c].dataType, T.StringType) else F.col(c).cast("string").alias(c) for c in RECORD]
    named = records.select(*text).withColumns({
        "_name": normalize_company_name(F.col("name")),
        "_city": normalize_text(F.col("city")),
        "_region": region_code(F.col("region")),
        "_country": country_code(F.col("country_code")),
        "_postal": normalize_text(F.col("postal_code")),
        "_domain": company_domain(F.col("website_url")),
        "_at": instant(F.col("retrieved_at")),
    })
    return named.withColumns({
        "_fallback": F.concat("_name", F.lit("|"), "_city", F.lit("|"), "_region", F.lit("|"), "_country"),
        "_place": location(F.col("_city"), F.col("_region"), F.col("_postal"), F.col("_country")),
    })


def _first_by(columns: list[Column]) -> Column:
    return F.min(F.struct(*columns))


def resolve(records: DataFrame) -> Identities:
    """Groups records into companies.

    A record with a domain belongs to that domain. One without, that has all of name, city, region and country, joins
    the only domain that shares them; with several such domains it stays alone (AMBIGUOUS_IDENTITY), with none it
    groups with its like. One that lacks any of them stays alone (INSUFFICIENT_IDENTITY); without a name it is
    unresolved. The index of fallback keys is built from records with a domain only, so no chain of attachments arises.

    Normal forms are computed once and kept in the checkpoint folder; from there, records with a domain need no exchange
    until they are counted, only those without one that have a fallback key meet the index, and only those that stay
    alone are numbered. Everything about a company is an aggregate that is combined before the shuffle: sets of distinct
    sources, queries, places and countries, the first and last instant, counts; the records themselves stay rows
    (members), so a company that holds a third of them is never gathered. Multiplicity is kept: repeated records are
    members as often as given.
    """
    rows = cut_lineage(prepare(records))
    unsited = rows.filter(F.col("_domain").isNull())
    unresolved = unsited.filter(F.col("_name").isNull()).select(*RECORD)
    unsited = unsited.filter(F.col("_name").isNotNull())
    nothing = F.lit(None).cast("string")
    by_domain = rows.filter(F.col("_domain").isNotNull()).withColumns({"_reason": nothing, "domain": F.col("_domain"), "authority": F.concat(F.lit("domain:"), "_domain")})
    index = rows.filter(F.col("_domain").isNotNull() & F.col("_fallback").isNotNull()).groupBy("_fallback").agg(F.min("_domain").alias("_only"), F.max("_domain").alias("_last"))
    asked = unsited.filter(F.col("_fallback").isNotNull()).join(index, "_fallback", "left")
    several = F.coalesce(F.col("_only") != F.col("_last"), F.lit(False))
    attached = asked.filter(~several).withColumns({"_reason": nothing, "domain": F.col("_only"), "authority": F.coalesce(F.concat(F.lit("domain:"), "_only"), F.concat(F.lit("fallback:"), "_fallback"))})
    bare = unsited.filter(F.col("_fallback").isNull()).withColumn("_reason", F.lit("INSUFFICIENT_IDENTITY"))
    alone = asked.filter(several).withColumn("_reason", F.lit("AMBIGUOUS_IDENTITY")).drop("_only", "_last").unionByName(bare)
    whole = F.to_json(F.struct(*sorted(RECORD)), {"ignoreNullFields": "false"})
    order = Window.partitionBy("record_id").orderBy("_key", "_reason")  # a column: as an expression of all others it would burden the planner
    single = alone.withColumn("_key", whole).withColumns({"domain": nothing, "authority": F.concat(F.lit("singleton:"), "record_id", F.lit(":"), (F.row_number().over(order) - 1).cast("string"))}).drop("_key")
    members = by_domain.unionByName(attached.drop("_only", "_last")).unionByName(single).withColumn("company_id", digest_id("cmp_", F.col("authority")))
    return Identities(_companies(members), members.select("company_id", *RECORD), unresolved)


def _companies(members: DataFrame) -> DataFrame:
    """Two aggregates over the members: the votes for a name, by company and name and then by company, and all else by
    company. Sets are merged before and after the exchange, so a company takes no more room than its distinct values."""
    exa = F.col("provider") == FIRST_PROVIDER
    trimmed = F.trim("name")
    raw = _first_by([(~exa).alias("a"), F.length(trimmed).alias("b"), F.lower(trimmed).alias("c"), trimmed.alias("d")])
    votes = members.groupBy("company_id", "_name").agg(F.count("*").alias("n"), F.max(exa).alias("exa"), raw.alias("raw"))
    best = F.min(F.when(F.col("_name").isNotNull(), F.struct((-F.col("n")).alias("n"), (~F.col("exa")).alias("e"), F.col("_name").alias("name"), F.col("raw.d").alias("raw"))))
    names = votes.groupBy("company_id").agg(best.alias("best"))
    facts = members.groupBy("company_id").agg(
        F.first("domain").alias("domain"),
        F.collect_set("provider").alias("providers"),
        F.collect_set("query").alias("queries"),
        F.collect_set("_place").alias("places"),
        F.min("_country").alias("one"),
        F.max("_country").alias("other"),
        F.max(~F.col("_country").isin(*HOME)).alias("abroad"),
        F.first("_reason").alias("reason"),
        F.min("_at").alias("created_at"),
        F.max("_at").alias("updated_at"),
        F.count("*").alias("n_records"),
    )
    both = facts.join(names, "company_id")
    provisional = F.col("best").isNull()
    reviews = F.array_compact(F.array(
        F.col("reason"),
        F.when(provisional, "INSUFFICIENT_IDENTITY"),
        F.when(F.col("one") != F.col("other"), "CONFLICTING_COUNTRY"),
        F.when(F.col("abroad"), "OUTSIDE_GEOGRAPHY"),
    ))
    return both.select(
        "company_id",
        F.coalesce("best.raw", "domain").alias("name"),
        F.coalesce("best.name", "domain").alias("normalized_name"),
        "domain",
        F.when(F.col("one") == F.col("other"), F.col("one")).alias("country"),
        F.array_sort("places").alias("locations_if_known"),
        F.array_sort("providers").alias("discovery_sources"),
        F.array_sort("queries").alias("discovery_queries"),
        F.array_sort(F.array_distinct(reviews)).alias("review_reasons"),
        "created_at",
        "updated_at",
        "n_records",
    )
