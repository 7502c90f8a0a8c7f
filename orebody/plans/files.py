"""Queries that pass whole tables through the sources, sinks and streams, each with the SQL it must equal.

Files go to the folder that all executors share (spark.checkpoint.dir), are read back, and are deleted once read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orebody.functions import values
from orebody.operators import calibration, ranking
from orebody.operators.topn import latest_by
from orebody.plans.domain import _PROFILE, _TITLE, _company, _title_sql, query
from orebody.session import cut_lineage, shared_folder, table
from orebody.sources import documents, labels_csv, ledger_jsonl, recorded, sinks
from orebody.streaming import usage


def _through(spark: SparkSession, work: Callable[[str], DataFrame]) -> DataFrame:
    """The rows that ``work`` reads from a folder of its own."""
    with shared_folder(spark) as folder:
        return cut_lineage(work(folder))


@query(f"""SELECT status, count(*) AS n FROM (SELECT DISTINCT snapshot_id, status FROM company_records) GROUP BY 1""")
def document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary kept as one document, replaced and read again."""
    counts = table(spark, sf_dir, "company_records").select("snapshot_id", "status").distinct().groupBy("status").count()
    with shared_folder(spark) as folder:
        path = f"{folder}/summary.json"
        assert documents.read_document(spark, path) is None
        for summary in ({"n": {}}, {"n": {r["status"]: r["count"] for r in counts.collect()}}):  # one number per status
            documents.replace_document(spark, path, summary)
        read = documents.read_document(spark, path)
    return spark.createDataFrame(list(read["n"].items()), "status string, n long")


_K = "CAST(json_extract(props, '$.k') AS BIGINT)"


@query(f"""SELECT user_id, event_id, k FROM (SELECT user_id, event_id, {_K} AS k FROM events) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""")
def ledger_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last entry of every key of a ledger kept as JSON lines, after it was appended to in two parts."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))

    first = F.coalesce(F.col("k") < 50, F.lit(False))

    def work(folder: str) -> DataFrame:
        sinks.replace_json(events.filter(first), f"{folder}/ledger")
        sinks.append_json(events.filter(~first), f"{folder}/ledger")
        rows = ledger_jsonl.read_ledger(spark, f"{folder}/ledger/*.*", "user_id long, event_id long, k long")
        return latest_by(rows, ["user_id"], F.col("event_id")).select("user_id", "event_id", "k")

    return _through(spark, work)


_LATEST = "SELECT * FROM company_records QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY snapshot_id DESC) = 1"
_CASES = ", ".join(f"count(*) FILTER (final_decision = '{d}') AS {d}" for d in ranking.DECISIONS)


@query(f"""WITH l AS (SELECT CASE status WHEN 'active' THEN 'A' WHEN 'merged' THEN 'B' ELSE 'C' END AS label, final_decision FROM ({_LATEST}))
SELECT s.label, {_CASES.replace("count(*)", "count(l.label)")} FROM (VALUES ('A'), ('B'), ('C')) AS s(label) LEFT JOIN l ON l.label = s.label GROUP BY 1""")
def label_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions against the labels of a checked sheet, which here say whether a company is active."""
    rows = latest_by(table(spark, sf_dir, "company_records").select("company_id", "snapshot_id", "status", "final_decision", "run_id"), ["company_id"], F.col("snapshot_id"))
    label = F.when(F.col("status") == "active", " a").when(F.col("status") == "merged", "B").otherwise("c ")

    def work(folder: str) -> DataFrame:
        sinks.replace_csv(rows.select(F.col("run_id").alias("context"), "company_id", label.alias("manual_label"), F.lit('said "no",\nthen left').alias("manual_notes")), f"{folder}/labels")
        labels = labels_csv.read_labels(spark, f"{folder}/labels", rows)
        joined = rows.join(labels, "company_id").withColumnRenamed("manual_label", "label")
        return calibration.confusion(joined, "label", "final_decision", labels_csv.LABELS, ranking.DECISIONS)

    return _through(spark, work)


@query("SELECT DISTINCT contact_id, coalesce(company_id, '') AS company_id, coalesce(work_email, '') AS work_email, coalesce(email_source, '') AS email_source FROM contact_records")
def sheet_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the contacts' sheet, written and read again."""
    rows = table(spark, sf_dir, "contact_records").select("full_name", "contact_id", "company_id", "work_email", "email_source", "title").distinct()

    def work(folder: str) -> DataFrame:
        sinks.replace_csv(rows, f"{folder}/sheet")
        return documents.read_sheet(spark, f"{folder}/sheet", ["contact_id", "company_id", "work_email", "email_source"]).distinct()

    return _through(spark, work)


@query(f"""SELECT date_trunc('day', ts)::VARCHAR AS day, event_type AS provider, sum({_K})::BIGINT AS request_count,
  CASE WHEN count(*) = count(CASE WHEN value <= 90 THEN value END) THEN round(sum(value), 6) END AS cost_usd FROM events GROUP BY 1, 2""")
def streamed_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals per day of a ledger that arrives as a stream, each dispatch once although sent twice."""
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("dispatch_id"), F.col("event_type").alias("provider"), F.get_json_object("props", "$.k").cast("long").alias("request_count"),
        F.when(F.col("value") <= 90, F.col("value")).alias("cost_usd"), F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).alias("recorded_at"),
    )

    def work(folder: str) -> DataFrame:
        sinks.append_json(events.unionByName(events), f"{folder}/in")
        arriving = usage.once(usage.usage_stream(spark, f"{folder}/in", files_per_trigger=1 << 30))
        writing = arriving.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
        writing.awaitTermination()
        seen = usage.totals(spark.read.schema(arriving.schema).parquet(f"{folder}/out"), "1 day")
        day = F.date_format("w.start", "yyyy-MM-dd HH:mm:ss")
        return seen.select(day.alias("day"), "provider", "request_count", F.round("cost_usd", 6).alias("cost_usd"))

    return _through(spark, work)


def _object(**fields: Column) -> Column:
    return F.struct(*[x.alias(k) for k, x in fields.items()])


def _bodies(rows: DataFrame, body: Column, *keep: str) -> DataFrame:
    """One recorded answer per row, so that a request with most of the rows is no single text."""
    return rows.select(*keep, F.to_json(body).alias("body"))


def _requests(spark: SparkSession, rows: DataFrame) -> DataFrame:
    return rows.select("request_id", "target_country_code").distinct().withColumn("queries", F.array(F.lit("asked")))


@query("""
WITH r AS (SELECT DISTINCT request_id, record_id, target_country_code, name, website_url, city, postal_code, country_code, title, left(snippet, 2000) AS snippet, retrieved_at FROM discovery_exa)
SELECT 'raw_' || substr(sha256('["exa","' || request_id || '","' || record_id || '"]'), 1, 24) AS record_id, request_id, target_country_code, 'asked' AS query, record_id AS provider_result_id,
  coalesce(nullif(name, ''), nullif(title, '')) AS name, nullif(website_url, '') AS website_url, nullif(city, '') AS city, nullif(postal_code, '') AS postal_code, nullif(country_code, '') AS country_code,
  nullif(title, '') AS title, nullif(snippet, '') AS snippet FROM r""")
def recorded_searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discovery records read from recorded company searches."""
    c = F.col
    rows = table(spark, sf_dir, "discovery_exa").select("request_id", "record_id", "target_country_code", "name", "website_url", "city", "postal_code", "country_code", "title", "snippet", "retrieved_at").distinct()
    place = _object(city=c("city"), postalCode=c("postal_code"), countryCode=c("country_code"))
    entity = _object(type=F.lit("Company"), id=c("record_id"), properties=_object(name=c("name"), headquarters=place))
    result = _object(url=c("website_url"), title=c("title"), highlights=F.array("snippet"), entities=F.array(entity))
    out = recorded.search_records(_bodies(rows, _object(results=F.array(result)), "request_id", "retrieved_at"), _requests(spark, rows))
    return out.select("record_id", "request_id", "target_country_code", "query", "provider_result_id", "name", "website_url", "city", "postal_code", "country_code", "title", "snippet")


@query("""
WITH r AS (SELECT DISTINCT request_id, record_id, target_country_code, name, source_url, website_url, city, region, snippet, retrieved_at FROM discovery_apify)
SELECT 'raw_' || substr(sha256('["apify","' || request_id || '","' || record_id || '"]'), 1, 24) AS record_id, request_id, record_id AS provider_result_id, nullif(name, '') AS name,
  nullif(source_url, '') AS source_url, nullif(website_url, '') AS website_url, nullif(city, '') AS city, nullif(region, '') AS region, coalesce(nullif(snippet, ''), 'place') AS snippet FROM r""")
def recorded_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discovery records read from recorded place searches."""
    c = F.col
    rows = table(spark, sf_dir, "discovery_apify").select("request_id", "record_id", "target_country_code", "name", "source_url", "website_url", "city", "region", "snippet", "retrieved_at").distinct()
    result = _object(placeId=c("record_id"), title=c("name"), url=c("source_url"), website=c("website_url"), city=c("city"), state=c("region"), description=c("snippet"), categoryName=F.lit("place"))
    out = recorded.place_records(_bodies(rows, F.array(result), "request_id", "retrieved_at"), _requests(spark, rows))
    return out.select("record_id", "request_id", "provider_result_id", "name", "source_url", "website_url", "city", "region", "snippet")


@query("""
WITH e AS (SELECT DISTINCT company_id, url, nullif(title, '') AS title, nullif(excerpt, '') AS excerpt FROM evidence_items WHERE regexp_matches(lower(url), '^https?://[^/?#]')),
p AS (SELECT *, lower(regexp_extract(url, '^(https?://[^/?#]+)', 1)) || coalesce(nullif(regexp_extract(url, '^https?://[^/?#]+([^#]*)', 1), ''), '/') AS page FROM e)
SELECT company_id, title, length(excerpt) AS n_chars, 'ev_' || substr(sha256('["exa",' || to_json(page)::VARCHAR || ',' || coalesce(to_json(excerpt)::VARCHAR, 'null') || ']'), 1, 24) AS evidence_id FROM p""")
def recorded_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence read from recorded page searches."""
    c = F.col
    rows = table(spark, sf_dir, "evidence_items").select("company_id", "url", "title", "excerpt").distinct()
    result = _object(url=c("url"), title=c("title"), highlights=F.array_compact(F.array("excerpt")))
    out = recorded.evidence_items(_bodies(rows, _object(results=F.array(result)), c("company_id").alias("request_id"), F.lit("2026-01-01T00:00:00Z").alias("retrieved_at")))
    return out.select(c("request_id").alias("company_id"), "title", F.length("excerpt").cast("long").alias("n_chars"), "evidence_id").distinct()


@query(f"""
WITH r AS (SELECT DISTINCT company_name, trim(full_name) AS full_name, trim(title) AS title, profile_url FROM contact_records WHERE trim(coalesce(full_name, '')) <> ''),
t AS (SELECT *, {_title_sql("t")} AS reason FROM (SELECT *, {_TITLE} AS t FROM r) WHERE {_company("company_name")} IS NOT NULL)
SELECT DISTINCT full_name, title, CASE reason[1] WHEN 'd' THEN 1 WHEN 'f' THEN 2 WHEN 'o' THEN 3 END AS rank, reason, {_PROFILE} AS profile_url FROM t WHERE reason IS NOT NULL""")
def recorded_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current roles of decision makers read from recorded people searches; the employer's name stands for the company asked about."""
    c = F.col
    rows = table(spark, sf_dir, "contact_records").select("company_name", "full_name", "title", "profile_url").distinct()
    role = _object(title=c("title"), company=_object(name=c("company_name")), dates=_object(to=F.lit(None).cast("string")))
    person = _object(type=F.lit("person"), properties=_object(name=c("full_name"), workHistory=F.array(role)))
    result = _object(url=c("profile_url"), entities=F.array(person))
    body = F.to_json(_object(results=F.array(result)), {"ignoreNullFields": "false"})
    asked = rows.select(F.coalesce("company_name", F.lit("")).alias("company_id"), F.sha2(F.concat_ws("|", "full_name", "title", "profile_url"), 256).alias("request_id"), body.alias("body"))
    companies = rows.select("company_name").filter(F.col("company_name").isNotNull()).distinct().select(c("company_name").alias("company_id"), c("company_name").alias("name"))
    return recorded.people(asked, companies).select("full_name", "title", "rank", "reason", "profile_url").distinct()


@query("SELECT record_id, name, round(x, 2) AS score FROM (SELECT DISTINCT record_id, name, CAST(json_extract(raw_metadata, '$.score') AS DOUBLE) AS x FROM discovery_exa) WHERE x IS NOT NULL AND abs(x * 100 - floor(x * 100) - 0.5) > 1e-6")
def metadata_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores rounded half-even on their exact value, but for those half-way between two, which the test covers."""
    rows = table(spark, sf_dir, "discovery_exa").select("record_id", "name", F.get_json_object("raw_metadata", "$.score").cast("double").alias("x")).distinct()
    part = F.col("x") * 100 - F.floor(F.col("x") * 100)
    return rows.filter(F.col("x").isNotNull() & (F.abs(part - 0.5) > 1e-6)).select("record_id", "name", values.round_exact(F.col("x"), 2).alias("score"))
