"""Queries pN_... of the llm problems over their whole tables, and the SQL that some of them must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebody.llm import canonical, encode, leading, linkage, mojibake, pii, survivors, variants, wordruns
from orebody.session import table

HOST = r"^[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+\z"


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    reference = table(spark, sf_dir, "title_reference").select("title_id", "title")
    entries = [(r.title_id, r.title) for r in reference.limit(canonical.MOST_ENTRIES + 1).collect()]
    typed = table(spark, sf_dir, "contact_records").select("contact_id", "title", "observed_at")
    typed = typed.filter(F.col("title").rlike(r"[^\s\u0085\p{Z}]")).join(reference.select("title").distinct(), "title", "left_anti")
    mapped = canonical.map_values(typed, "title", entries, canonical.title_aliases(entries), "title_id")
    latest = F.max(F.struct("observed_at", "title_id")).alias("l")
    return mapped.groupBy("contact_id").agg(latest).select("contact_id", F.col("l.title_id").alias("title_id"))


def p3_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = None
    for source in ("discovery_exa", "discovery_apify"):
        r = table(spark, sf_dir, source).select(F.lit(source).alias("source"), "record_id", "name", F.col("website_url").alias("site"), F.col("source_url").alias("link"), "city", "region")
        rows = r if rows is None else rows.unionByName(r)
    return linkage.link_records(rows)


def p3_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkage.matches(p3_companies(spark, sf_dir), "discovery_exa", "discovery_apify")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_matches(spark, sf_dir).select("record_id_a", "record_id_b")


def p4_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = variants.variant_classes(table(spark, sf_dir, "company_records"), "company_id", "name", "normalized_name", "domain")
    return out.select(F.col("owner").alias("company_id"), "class")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = p4_classes(spark, sf_dir).withColumnRenamed("company_id", "owner")
    return variants.class_pairs(classes).select(F.col("a").alias("company_id_a"), F.col("b").alias("company_id_b"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    measure = lambda n: survivors.Survival(F.when(n > 0, n))
    fields = {
        "discovery_records": measure(survivors.filled(F.col("discovery_records.record_id"))),
        "domain": survivors.Survival(F.when(F.col("domain").rlike(HOST), F.lit(1))),
        "locations_if_known": measure(survivors.filled(F.col("locations_if_known"), fold=True)),
    }
    return survivors.survive(table(spark, sf_dir, "company_records"), "company_id", "snapshot_id", survivors.instant(F.col("updated_at")), fields)


def p5_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truth discovery over the same table: runs are the sources, what a snapshot says of a field is its claim (of
    discovery_records the sorted distinct record_ids; country is claimed beside the three dealt fields)."""
    rows = table(spark, sf_dir, "company_records")
    place = F.transform(F.col("locations_if_known"), lambda x: F.lower(survivors.trimmed(x)))
    record = F.transform(F.col("discovery_records.record_id"), survivors.trimmed)
    listed = lambda entries: F.array_join(F.array_sort(F.array_distinct(F.filter(entries, lambda x: x.isNotNull() & (x != "")))), "|")
    said = {
        "discovery_records": listed(record),
        "domain": F.when(F.col("domain").rlike(HOST), F.lower("domain")),
        "country": F.nullif(survivors.trimmed(F.col("country")), F.lit("")),
        "locations_if_known": listed(place),
    }
    claim = F.explode(F.array(*[F.struct(F.lit(k).alias("field"), F.nullif(v, F.lit("")).alias("value")) for k, v in said.items()]))
    claims = rows.select(F.col("company_id").alias("entity"), F.col("run_id").alias("source"), claim.alias("c")).select("entity", "source", "c.field", "c.value")
    out = survivors.discover_truth(claims)
    return out.select(F.col("entity").alias("company_id"), F.col("field").alias("field_name"), "value", F.round("confidence", 6).alias("confidence"))


def p6_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = pii.known_names(table(spark, sf_dir, "contact_records"), "full_name")
    out = None
    for source, row_id, text in (("evidence_items", "evidence_id", "excerpt"), ("discovery_exa", "record_id", "snippet"), ("discovery_apify", "record_id", "snippet")):
        found = pii.find_personal(table(spark, sf_dir, source), row_id, text, names).select(F.lit(source).alias("source_table"), "*")
        out = found if out is None else out.unionByName(found)
    return out


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p6_redacted(spark, sf_dir).select("source_table", "row_id", F.explode("kinds").alias("pii_kind")).distinct()


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "contact_records").select("contact_id", "company_id", "decision_rank", "full_name", "observed_at")
    rank = F.when(F.col("decision_rank").between(1, 3), F.col("decision_rank")).otherwise(4)
    tie = [F.col("company_id").asc_nulls_last(), rank, F.col("full_name").asc_nulls_last()]
    latest = leading.versions(rows, ["contact_id"], F.col("observed_at"), tie).filter(F.col("company_id").isNotNull())
    by = [rank, F.col("full_name").asc_nulls_last()]
    return leading.leading(latest, ["company_id"], by, [F.col("contact_id").asc_nulls_last()], 3).select("company_id", "contact_id")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.encode_texts(table(spark, sf_dir, "documents"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    literal = wordruns.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"), edited=False)
    return literal.filter(F.col("run") >= wordruns.RUN).select("doc_id", "item_id")


def p9_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordruns.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p10_repair(spark, sf_dir).select("doc_id").distinct()


def p10_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mojibake.repair_texts(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p2_found, p3_found, p3_companies, p3_matches, p4_found, p4_classes, p5_found, p5_truth, p6_found, p6_redacted, p7_found, p8_ids, p9_found, p9_leaks, p10_found, p10_repair)
}

_P5 = """
WITH r AS (
  SELECT DISTINCT company_id, snapshot_id, try_cast(updated_at AS TIMESTAMPTZ) AS u,
    (SELECT count(DISTINCT trim(x.record_id)) FROM unnest(discovery_records) AS t(x) WHERE trim(x.record_id) <> '') AS n_records,
    CASE WHEN regexp_full_match(domain, '[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+') THEN 1 END AS n_domain,
    (SELECT count(DISTINCT lower(trim(x))) FROM unnest(locations_if_known) AS t(x) WHERE trim(x) <> '') AS n_places
  FROM company_records WHERE company_id IS NOT NULL AND snapshot_id IS NOT NULL),
g AS (SELECT company_id FROM r GROUP BY company_id HAVING count(DISTINCT snapshot_id) > 1),
c AS (
  SELECT company_id, 'discovery_records' AS field_name, snapshot_id, n_records AS m, u FROM r WHERE n_records > 0
  UNION ALL SELECT company_id, 'domain', snapshot_id, n_domain, u FROM r WHERE n_domain = 1
  UNION ALL SELECT company_id, 'locations_if_known', snapshot_id, n_places, u FROM r WHERE n_places > 0)
SELECT company_id, field_name, snapshot_id FROM c JOIN g USING (company_id)
QUALIFY row_number() OVER (PARTITION BY company_id, field_name ORDER BY m DESC, u DESC NULLS LAST, snapshot_id DESC) = 1
"""

_P7 = """
WITH l AS (
  SELECT contact_id, company_id, full_name, CASE WHEN decision_rank BETWEEN 1 AND 3 THEN decision_rank ELSE 4 END AS k FROM contact_records
  QUALIFY row_number() OVER (PARTITION BY contact_id ORDER BY observed_at DESC NULLS LAST, company_id NULLS LAST, k, full_name NULLS LAST) = 1)
SELECT company_id, contact_id FROM l WHERE company_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY k, full_name NULLS LAST, contact_id NULLS LAST) <= 3
"""

ORACLE: dict[str, str] = {"p5_found": _P5, "p7_found": _P7}
