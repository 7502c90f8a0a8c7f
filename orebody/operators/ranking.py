"""The order in which evaluated companies are published, their views and their sheets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebody.functions.text import collapse, compatibility_fold, formula_safe
from orebody.operators.topn import numbered

# Decisions in the order of publication.
DECISIONS = ("accepted", "uncertain", "rejected")
# Components of the score and the columns of the two sheets, in their order.
COMPONENTS = ("workload", "economic_fit", "low_incumbent_exposure", "direct_pain")
COMPANY_SHEET = (
    "company_id", "name", "domain", "country", "policy_version", "workload_score", "workload_coverage", "economic_fit_score", "economic_fit_coverage",
    "low_incumbent_exposure_score", "low_incumbent_exposure_coverage", "direct_pain_score", "direct_pain_coverage", "overall_coverage", "final_score",
    "final_decision", "review_reasons", "rejection_reasons",
)
CONTACT_SHEET = (
    "company_id", "company_name", "company_domain", "company_final_score", "contact_id", "full_name", "title", "decision_rank", "decision_reason",
    "work_email", "email_verification_status", "linkedin_url", "profile_url", "email_source",
)


def sort_name(normalized: Column, name: Column) -> Column:
    """The normal form if there is one, else the name, folded and with single spaces; '' for none."""
    return F.coalesce(collapse(compatibility_fold(F.coalesce(F.nullif(normalized, F.lit("")), name))), F.lit(""))


def publication(decision: Column, score: Column, coverage: Column, name: Column, company_id: Column) -> list[Column]:
    """Decision, known scores first and high ones before low, coverage, name, id; other decisions come last."""
    place = F.array_position(F.array(*map(F.lit, DECISIONS)), decision)
    return [F.when(place > 0, place).otherwise(len(DECISIONS) + 1), score.desc_nulls_last(), coverage.desc_nulls_last(), name, company_id]


def ranked(companies: DataFrame, place_as: str = "place") -> DataFrame:
    """companies with their place in the order of publication, over the whole table and without gaps.

    ``companies``: company_id, name, normalized_name, final_decision, final_score, coverage. A range-partitioned sort with
    offsets, so no task holds more than its range; filters on final_decision afterwards are the views by decision, with
    the order kept.
    """
    named = companies.withColumn("_name", sort_name(F.col("normalized_name"), F.col("name")))
    order = publication(*map(F.col, ("final_decision", "final_score", "coverage", "_name", "company_id")))
    return numbered(named, order, place_as).drop("_name")


def fixed(value: Column, digits: int) -> Column:
    """A number with so many decimals, '' for null."""
    return F.when(value.isNull(), "").otherwise(F.format_string(f"%.{digits}f", value))


def company_sheet(companies: DataFrame) -> DataFrame:
    """The 18 columns of the sheet of companies, all of them text.

    ``companies``: company_id, name, domain, normalized_domain, country, policy_version, final_score, final_decision,
    review_reasons, rejection_reasons, score_components and coverage (maps; coverage also has overall). Texts are safe
    from formulas, unknown scores are blank, coverage has four decimals and counts as none where it is missing.
    """
    part = lambda name, key: F.try_element_at(name, F.lit(key))
    cover = lambda key: fixed(F.coalesce(part("coverage", key), F.lit(0.0)), 4)
    cells = {
        "company_id": formula_safe(F.col("company_id")), "name": formula_safe(F.col("name")),
        "domain": formula_safe(F.coalesce(F.nullif("normalized_domain", F.lit("")), "domain")), "country": formula_safe(F.col("country")),
        "policy_version": F.col("policy_version"), "overall_coverage": cover("overall"), "final_score": fixed(F.col("final_score"), 2), "final_decision": F.col("final_decision"),
    }
    for c in COMPONENTS:
        cells |= {f"{c}_score": fixed(part("score_components", c), 2), f"{c}_coverage": cover(c)}
    for c in ("review_reasons", "rejection_reasons"):
        cells[c] = F.coalesce(F.array_join(c, ";"), F.lit(""))
    return companies.select(*[cells[c].alias(c) for c in COMPANY_SHEET])


def contact_sheet(contacts: DataFrame) -> DataFrame:
    """The 14 columns of the sheet of contacts, all of them text and safe from formulas."""
    return contacts.select(*[formula_safe(F.col(c)).alias(c) for c in CONTACT_SHEET])


def with_labels(sheet: DataFrame, labels: DataFrame) -> DataFrame:
    """A sheet with manual_label and manual_notes of its companies, '' where there are none."""
    told = labels.select(F.col("company_id"), "manual_label", "manual_notes")
    joined = sheet.join(told, "company_id", "left")
    return joined.withColumns({"manual_label": F.coalesce("manual_label", F.lit("")), "manual_notes": formula_safe(F.col("manual_notes"))})
