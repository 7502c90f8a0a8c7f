"""The registry of core queries and the SQL that they must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebody.operators.orphans import Cascade, ForeignKey, Keyed, orphan_cascade
from orebody.plans import domain, evaluation, files  # noqa: F401
from orebody.session import table

EVIDENCE_KEY = ForeignKey("decision_reasons", "evidence_ids", "evidence_items", "evidence_id", since="loaded_at", until="deleted_at", clean=True)


def _cited(spark: SparkSession, sf_dir: str) -> dict[str, Keyed]:
    return {
        "decision_reasons": Keyed(table(spark, sf_dir, "decision_reasons"), "reason_id", F.col("decided_at")),
        "evidence_items": Keyed(table(spark, sf_dir, "evidence_items"), "evidence_id", F.col("loaded_at")),
    }


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    cascade = orphan_cascade(_cited(spark, sf_dir), [EVIDENCE_KEY])
    return cascade.references.select(F.col("record_id").cast("long").alias("reason_id"), F.col("reference").alias("evidence_id")).distinct()


def p1_cascade(spark: SparkSession, sf_dir: str) -> Cascade:
    """The whole foreign-key graph: what hangs on a company, an evidence item or a request that is not there."""
    read = lambda name: table(spark, sf_dir, name)
    retrieved = F.to_utc_timestamp(F.col("retrieved_at").try_cast("timestamp"), "UTC")
    tables = _cited(spark, sf_dir) | {
        "company_records": Keyed(read("company_records"), "company_id"),
        "contact_records": Keyed(read("contact_records"), "contact_id", F.col("observed_at")),
        "discovery_exa": Keyed(read("discovery_exa"), "record_id", retrieved),
        "discovery_apify": Keyed(read("discovery_apify"), "record_id", retrieved),
        "discovery_requests": Keyed(read("discovery_requests"), "request_id"),
    }
    keys = [EVIDENCE_KEY]
    keys += [ForeignKey(t, "company_id", "company_records", "company_id") for t in ("evidence_items", "decision_reasons", "contact_records")]
    keys += [ForeignKey(t, "request_id", "discovery_requests", "request_id") for t in ("discovery_exa", "discovery_apify")]
    return orphan_cascade(tables, keys)


def p1_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_cascade(spark, sf_dir).report().withColumn("period", F.col("period").cast("date"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p1_found, p1_report)} | domain.QUERIES

ORACLE: dict[str, str] = domain.ORACLE | {
    "p1_found": """
WITH e AS (
  SELECT DISTINCT reason_id, decided_at, lower(regexp_replace(x, '^\\s+|\\s+$', '', 'g')) AS evidence_id
  FROM (SELECT reason_id, decided_at, unnest(evidence_ids) AS x FROM decision_reasons) WHERE x IS NOT NULL)
SELECT DISTINCT reason_id, evidence_id FROM e
WHERE evidence_id <> '' AND NOT EXISTS (
  SELECT 1 FROM evidence_items i WHERE i.evidence_id = e.evidence_id AND i.loaded_at <= e.decided_at
    AND (i.deleted_at IS NULL OR i.deleted_at > e.decided_at))
""",
    "p1_report": """
WITH e AS (
  SELECT DISTINCT reason_id, decided_at, lower(regexp_replace(x, '^\\s+|\\s+$', '', 'g')) AS entry
  FROM (SELECT reason_id, decided_at, unnest(evidence_ids) AS x FROM decision_reasons) WHERE x IS NOT NULL),
known AS (SELECT company_id FROM company_records WHERE company_id IS NOT NULL), asked AS (SELECT request_id FROM discovery_requests WHERE request_id IS NOT NULL),
d AS (
  SELECT 'decision_reasons' AS table_name, reason_id::VARCHAR AS id, decided_at AS t FROM e WHERE entry <> '' AND NOT EXISTS (SELECT 1 FROM evidence_items i
    WHERE i.evidence_id = e.entry AND i.loaded_at <= e.decided_at AND (i.deleted_at IS NULL OR i.deleted_at > e.decided_at))
  UNION ALL SELECT 'decision_reasons', reason_id::VARCHAR, decided_at FROM decision_reasons WHERE company_id NOT IN (FROM known)
  UNION ALL SELECT 'evidence_items', evidence_id, loaded_at FROM evidence_items WHERE company_id NOT IN (FROM known)
  UNION ALL SELECT 'contact_records', contact_id, observed_at FROM contact_records WHERE company_id NOT IN (FROM known)
  UNION ALL SELECT 'discovery_exa', record_id, try_cast(retrieved_at AS TIMESTAMPTZ) AT TIME ZONE 'UTC' FROM discovery_exa WHERE request_id NOT IN (FROM asked)
  UNION ALL SELECT 'discovery_apify', record_id, try_cast(retrieved_at AS TIMESTAMPTZ) AT TIME ZONE 'UTC' FROM discovery_apify WHERE request_id NOT IN (FROM asked)),
g AS (SELECT table_name, id, min(t) AS t, 0 AS level FROM d GROUP BY 1, 2),
h AS (SELECT 'decision_reasons' AS table_name, reason_id::VARCHAR AS id, min(decided_at) AS t, 1 AS level FROM e
  WHERE entry IN (SELECT id FROM g WHERE table_name = 'evidence_items' AND id IS NOT NULL) AND reason_id::VARCHAR NOT IN (SELECT id FROM g WHERE table_name = 'decision_reasons') GROUP BY 2)
SELECT table_name, date_trunc('month', t)::DATE AS period, count(*) FILTER (level = 0) AS direct, count(*) FILTER (level > 0) AS inherited FROM (FROM g UNION ALL FROM h) GROUP BY 1, 2
""",
}
