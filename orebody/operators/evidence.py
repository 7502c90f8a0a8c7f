"""Bounded evidence bundles and the order in which companies are researched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orebody.functions.url import page_url, registrable_domain
from orebody.operators.topn import first_n

_QUERIES = ("{} products services markets", "{} branches locations employees", "{} quotation estimating tender projects")


def bundle(items: DataFrame, own_domain: Column, order: list[Column], most: int = 12, chars_each: int = 2000, chars_all: int = 20_000, own: int = 4, others: int = 2) -> DataFrame:
    """Per company the first pages that fit: each page once, at most ``own`` of the company's own domain and ``others`` of
    any other, ``most`` items and ``chars_all`` characters of excerpt in all, the last excerpt cut to what is left.

    ``items``: company_id, evidence_id, url, title, excerpt and whatever ``own_domain`` and ``order`` read. Three picks,
    by page, by host and by company, each cut to its limit before its exchange: a company with most of the items is
    spread over its pages and hosts, and sends only ``most`` items a task to where the room is counted. Items without a
    proper address drop out; null excerpts take no room; ties beyond ``order`` are decided by evidence_id. Adds position
    and excerpt_used.
    """
    total = [*order, F.col("evidence_id")]
    rows = items.withColumns({"_page": page_url(F.col("url")), "_site": registrable_domain(F.col("url")), "_own": own_domain})
    rows = rows.filter(F.col("_page").isNotNull()).withColumn("_host", F.coalesce("_site", F.regexp_extract("_page", r"^[a-z]+://([^/:?]+)", 1)))
    rows = first_n(rows, ["company_id", "_page"], total, 1)
    limit = F.when(F.col("_site") == F.col("_own"), own).otherwise(others)
    rows = first_n(rows, ["company_id", "_host"], total, max(own, others), rank_as="_nth").filter(F.col("_nth") <= limit)
    rows = first_n(rows, ["company_id"], total, most, rank_as="position")
    size = F.coalesce(F.least(F.length("excerpt"), F.lit(chars_each)), F.lit(0))
    earlier = Window.partitionBy("company_id").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_before", F.coalesce(F.sum(size).over(earlier), F.lit(0))).filter(F.col("_before") < chars_all)
    used = F.expr(f"substring(excerpt, 1, cast(least({chars_each}, {chars_all} - _before) as int))")
    return rows.withColumn("excerpt_used", used).drop("_page", "_site", "_own", "_host", "_nth", "_before")


def research_order(companies: DataFrame, limit: int | None = None) -> DataFrame:
    """Companies with a domain first, then known home countries, many sources, many records; by id at last.

    ``companies``: company_id, domain, country, review_reasons, n_sources, n_records. Those abroad are left out, and those
    seen abroad too (OUTSIDE_GEOGRAPHY), whose country is unknown. With a limit the plan keeps only that many rows a task.
    """
    home = F.col("country").isin("US", "CA")
    seen_abroad = F.coalesce(F.array_contains("review_reasons", "OUTSIDE_GEOGRAPHY"), F.lit(False))
    kept = companies.filter((F.col("country").isNull() | home) & ~seen_abroad)
    ranked = kept.orderBy(F.col("domain").isNull(), ~F.coalesce(home, F.lit(False)), F.desc("n_sources"), F.desc("n_records"), "company_id")
    return ranked if limit is None else ranked.limit(limit)


def research_requests(companies: DataFrame) -> DataFrame:
    """Three search texts for each company: (company_id, family, query), white space collapsed."""
    families = F.array(*[F.struct(F.lit(k).alias("family"), F.lit(q).alias("pattern")) for k, q in enumerate(_QUERIES)])
    text = F.trim(F.regexp_replace(F.replace(F.col("f.pattern"), F.lit("{}"), F.coalesce("name", F.lit(""))), r"\s+", " "))
    return companies.select("company_id", "name", F.explode(families).alias("f")).select("company_id", "f.family", text.alias("query"))
