"""Facts as extracted from evidence: parsed from recorded answers, checked, and applied to companies.

Answers are read as VARIANT in the JVM. An answer counts as a whole or not at all: one bad fact spoils it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebody.operators.propositions import canonical, supported
from orebody.operators.vocabulary import FACT_KEYS
from orebody.session import cut_lineage

FACT_FIELDS = ("confidence", "evidence_ids", "value")


def kind(value: Column) -> Column:
    """The type of a VARIANT in capitals, without its parameters; null for null."""
    return F.regexp_extract(F.schema_of_variant(value), r"^\w+", 0)


def _fields(value: Column) -> Column:
    """The entries of a VARIANT that is an object, else null."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def exact_keys(value: Column, expected: Sequence[str]) -> Column:
    """Whether a VARIANT is an object with exactly these keys."""
    return F.coalesce(F.array_sort(F.map_keys(_fields(value))) == F.array(*map(F.lit, sorted(expected))), F.lit(False))


def is_number(value: Column) -> Column:
    return F.coalesce(kind(value).isin("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT", "DECIMAL"), F.lit(False))


def valid_confidence(value: Column) -> Column:
    """Whether a VARIANT is a number, and no truth value, from 0 to 1."""
    return is_number(value) & F.coalesce(F.try_variant_get(value, "$", "double").between(0, 1), F.lit(False))


def _texts(value: Column) -> Column:
    """The entries of a VARIANT that is a list of strings only, else null."""
    entries = F.try_variant_get(value, "$", "array<variant>")
    return F.when(F.forall(entries, lambda x: F.coalesce(kind(x) == "STRING", F.lit(False))), F.transform(entries, lambda x: F.variant_get(x, "$", "string")))


def valid_value(value: Column) -> Column:
    """Whether a VARIANT is null, a truth value, a string, a finite number or a list of strings."""
    finite = is_number(value) & ~F.isnan(F.coalesce(F.try_variant_get(value, "$", "double"), F.lit(float("nan"))))
    return value.isNull() | F.is_variant_null(value) | F.coalesce(kind(value).isin("BOOLEAN", "STRING"), F.lit(False)) | finite | _texts(value).isNotNull()


def answers(responses: DataFrame, keys: Sequence[str] = FACT_KEYS) -> DataFrame:
    """(company_id, fact_key, value, confidence, evidence_ids, problem): one row per fact of every recorded answer.

    ``responses``: company_id, body, the JSON as received: exactly one choice, finished by "stop", whose message's content
    is JSON without repeated keys, of the one object "facts" with exactly ``keys``. Anything else is one row without a
    fact and with the problem "envelope". A fact has exactly value, confidence and evidence_ids; its problem is the first
    of "shape", "value", "confidence", "citations" (no list of distinct strings) and "unknown" (a null value with
    confidence or citations, or a value without citations). Null bodies are envelope problems; values come as JSON text.
    """
    choices = F.try_variant_get(F.try_parse_json("body"), "$.choices", "array<variant>")
    one = F.when(F.size(choices) == 1, choices[0])
    content = F.when(kind(F.try_variant_get(one, "$.message.content", "variant")) == "STRING", F.try_variant_get(one, "$.message.content", "string"))
    said = F.try_parse_json(F.when(F.try_variant_get(one, "$.finish_reason", "string") == "stop", content))
    rows = responses.select("company_id", said.alias("_said"))
    facts = F.try_variant_get("_said", "$.facts", "variant")
    good = exact_keys(F.col("_said"), ["facts"]) & exact_keys(facts, keys)
    rows = rows.withColumn("_facts", F.when(good, _fields(facts))).select("company_id", F.explode_outer("_facts").alias("fact_key", "_raw"), F.col("_facts").isNull().alias("_bad"))
    at = lambda name: F.try_variant_get("_raw", f"$.{name}", "variant")
    value, cited = at("value"), _texts(at("evidence_ids"))
    none = value.isNull() | F.is_variant_null(value)
    sure = F.try_variant_get("_raw", "$.confidence", "double")
    problem = (
        F.when(F.col("_bad"), "envelope").when(~exact_keys(F.col("_raw"), FACT_FIELDS), "shape").when(~valid_value(value), "value").when(~valid_confidence(at("confidence")), "confidence")
        .when(cited.isNull() | (F.size(F.array_distinct(cited)) != F.size(cited)), "citations").when(F.when(none, (sure != 0) | (F.size(cited) > 0)).otherwise(F.size(cited) == 0), "unknown")
    )
    return rows.select("company_id", "fact_key", F.when(none, "null").otherwise(F.to_json(value)).alias("value"), sure.alias("confidence"), cited.alias("evidence_ids"), problem.alias("problem"))


def unretained(facts: DataFrame, items: DataFrame) -> DataFrame:
    """(company_id, fact_key, evidence_id): citations, each once, of items that the company does not hold."""
    cited = facts.select("company_id", "fact_key", F.explode("evidence_ids").alias("evidence_id")).distinct()
    return cited.join(items.select("company_id", "evidence_id").distinct(), ["company_id", "evidence_id"], "left_anti").select("company_id", "fact_key", "evidence_id")


def accepted(facts: DataFrame, items: DataFrame) -> DataFrame:
    """The facts of those companies whose answers have no problem and cite nothing that is not there. Answers are read
    once, and kept."""
    facts = cut_lineage(facts)
    wrong = facts.filter(F.col("problem").isNotNull()).select("company_id").unionByName(unretained(facts, items).select("company_id")).distinct()
    return facts.join(wrong, "company_id", "left_anti").drop("problem")


def item_problems(items: DataFrame) -> DataFrame:
    """(company_id, blank, repeated): how many items of a company have no identifier, and how many rows repeat one."""
    blank = F.coalesce(F.col("evidence_id"), F.lit("")) == ""
    counted = items.groupBy("company_id", "evidence_id").agg(F.count("*").alias("n"))
    out = counted.groupBy("company_id").agg(F.coalesce(F.sum(F.when(blank, F.col("n"))), F.lit(0)).alias("blank"), F.sum(F.when(~blank, F.col("n") - 1).otherwise(0)).alias("repeated"))
    return out.filter((F.col("blank") > 0) | (F.col("repeated") > 0))


def applied(companies: DataFrame, facts: DataFrame, items: DataFrame) -> DataFrame:
    """companies with features, feature_confidence and stage_status as the accepted and supported facts leave them.

    ``companies``: company_id, stage_status and anything else; ``facts``: as ``accepted`` gives them; repeated ones count
    once, and of different ones of a company and key the greatest value. Companies without facts stay as they are, with null features. Features are JSON texts by fact.
    """
    kept = canonical(supported(facts, items))
    once = kept.groupBy("company_id", "fact_key").agg(F.max(F.struct("value", "confidence", "evidence_ids")).alias("_told"))
    told = once.groupBy("company_id").agg(F.map_from_entries(F.collect_list(F.struct("fact_key", "_told"))).alias("_facts"))  # as many as there are facts
    joined = companies.join(told, "company_id", "left")
    done = F.create_map(F.lit("research"), F.lit("completed"), F.lit("extraction"), F.lit("completed"))
    others = F.map_filter("stage_status", lambda k, _: ~k.isin("research", "extraction"))
    return joined.withColumns({
        "features": F.transform_values("_facts", lambda _, x: x["value"]),
        "feature_confidence": F.transform_values("_facts", lambda _, x: F.struct(x["confidence"].alias("confidence"), x["evidence_ids"].alias("evidence_ids"))),
        "stage_status": F.when(F.col("_facts").isNotNull(), F.map_concat(others, done)).otherwise(F.col("stage_status")),
    }).drop("_facts")


def distinct_entries(values: Column) -> Column:
    """How many distinct entries a list has, trimmed and in lower case, blank and null ones not counted; null for null."""
    clean = F.transform(values, lambda x: F.lower(F.regexp_replace(x, r"^[\s\p{Z}]+|[\s\p{Z}]+\z", "")))
    return F.size(F.array_distinct(F.filter(clean, lambda x: x.isNotNull() & (x != ""))))


def citation_union(*lists: Column) -> Column:
    """The entries of all lists, each once, in order; null lists and entries have none."""
    empty = F.array().cast("array<string>")
    return F.array_sort(F.array_distinct(F.array_compact(F.flatten(F.array(*[F.coalesce(x, empty) for x in lists])))))
