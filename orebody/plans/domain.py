"""Queries of the prospect domain over whole tables, each with the SQL that it must equal."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebody.functions import geo, text, url, values
from orebody.operators import calibration, contacts, evidence, identity, ledger, support, vocabulary
from orebody.operators.topn import latest_by, numbered
from orebody.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# The same normal forms in SQL, for these tables' alphabets.
_MACROS = {
    "norm": "nullif(trim(regexp_replace(regexp_replace(replace(lower({0}), '&', ' and '), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' +', ' ', 'g')), '')",
    "tail": "nullif(regexp_replace({0}, '((^| )(inc|incorporated|llc|ltd|limited|corp|corporation|co|company|lp|llp|plc|ulc|ltee|ltée))+$', ''), '')",
    "host": "nullif(regexp_extract(lower(trim({0}, ' \t\n\r')), '^https?://([^/?#@:]+)(:[0-9]+)?([/?#].*)?$', 1), '')",
}


def _norm(x: str) -> str:
    return _MACROS["norm"].format(x)


def _company(x: str) -> str:
    return _MACROS["tail"].format(_norm(x))


def _domain(x: str) -> str:
    host = _MACROS["host"].format(x)
    return f"nullif(regexp_extract({host}, '([a-z0-9-]+\\.(example|test|invalid|com|net|org))$', 1), '')"


def _case(x: str, known: dict[str, str]) -> str:
    pairs = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in known.items())
    return f"(CASE {x} {pairs} ELSE upper({x}) END)"


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _joined(column: str):  # noqa: ANN202
    return F.array_join(column, "; ").alias(column)


_RECORDS = "SELECT * FROM (SELECT DISTINCT * FROM discovery_exa UNION ALL SELECT DISTINCT * FROM discovery_apify)"


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both providers' records, repeated rows once."""
    return table(spark, sf_dir, "discovery_exa").distinct().unionByName(table(spark, sf_dir, "discovery_apify").distinct())


_PREPARED = f"""
WITH r AS ({_RECORDS}),
p AS (SELECT *, {_company("name")} AS n, {_norm("city")} AS c,
    {_case(_norm("region"), geo.REGIONS)} AS g, {_case(_norm("country_code"), geo.COUNTRIES)} AS k,
    upper({_norm("postal_code")}) AS z, {_domain("website_url")} AS dom, try_cast(retrieved_at AS TIMESTAMPTZ) AS ts FROM r),
q AS (SELECT *, n || '|' || c || '|' || g || '|' || k AS fb, nullif(concat_ws(', ', c, g, z, k), '') AS place FROM p)
"""


@query(f"{_PREPARED} SELECT record_id, n AS name_form, c AS city_form, g AS region_code, k AS country, dom AS domain, fb AS fallback_key, place FROM q")
def prepared_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = identity.prepare(_records(spark, sf_dir))
    return out.select(
        "record_id", F.col("_name").alias("name_form"), F.col("_city").alias("city_form"), F.col("_region").alias("region_code"),
        F.col("_country").alias("country"), F.col("_domain").alias("domain"), F.col("_fallback").alias("fallback_key"), F.col("_place").alias("place"),
    )


_RESOLVED = f"""{_PREPARED},
i AS (SELECT fb, min(dom) AS only1, max(dom) AS last1 FROM q WHERE dom IS NOT NULL AND fb IS NOT NULL GROUP BY fb),
j AS (SELECT q.*, only1, last1,
    CASE WHEN dom IS NULL AND q.fb IS NULL THEN 'INSUFFICIENT_IDENTITY' WHEN dom IS NULL AND only1 <> last1 THEN 'AMBIGUOUS_IDENTITY' END AS reason,
    coalesce(dom, CASE WHEN only1 = last1 THEN only1 END) AS domain
  FROM q LEFT JOIN i ON q.fb = i.fb WHERE dom IS NOT NULL OR n IS NOT NULL),
m AS (SELECT *, CASE WHEN reason IS NOT NULL THEN 'singleton:' || record_id || ':' || (row_number() OVER (PARTITION BY record_id, reason IS NOT NULL) - 1)
    WHEN domain IS NOT NULL THEN 'domain:' || domain ELSE 'fallback:' || fb END AS authority FROM j),
x AS (SELECT *, 'cmp_' || substr(sha256(authority), 1, 24) AS company_id FROM m)
"""


@query(
    f"""{_RESOLVED},
v AS (SELECT company_id, n, count(*) AS cnt, bool_or(provider = 'exa') AS exa,
    arg_min(trim(name), (provider <> 'exa', length(trim(name)), lower(trim(name)), trim(name))) AS raw FROM x WHERE n IS NOT NULL GROUP BY 1, 2),
b AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY cnt DESC, exa DESC, n) = 1),
f AS (SELECT company_id, any_value(domain) AS domain, min(k) AS k1, max(k) AS k2, bool_or(k NOT IN ('US', 'CA')) AS abroad, any_value(reason) AS reason,
    array_to_string(list_sort(list(DISTINCT place) FILTER (place IS NOT NULL)), '; ') AS locations_if_known,
    array_to_string(list_sort(list(DISTINCT provider)), '; ') AS discovery_sources,
    array_to_string(list_sort(list(DISTINCT query) FILTER (query IS NOT NULL)), '; ') AS discovery_queries,
    epoch_us(min(ts)) AS created_us, epoch_us(max(ts)) AS updated_us, count(*) AS n_records FROM x GROUP BY 1)
SELECT f.company_id, coalesce(b.raw, f.domain) AS name, coalesce(b.n, f.domain) AS normalized_name, f.domain,
  CASE WHEN k1 = k2 THEN k1 END AS country, coalesce(locations_if_known, '') AS locations_if_known, discovery_sources, coalesce(discovery_queries, '') AS discovery_queries,
  array_to_string(list_sort(list_distinct(list_filter([CASE WHEN b.n IS NULL THEN 'INSUFFICIENT_IDENTITY' END, reason,
    CASE WHEN k1 <> k2 THEN 'CONFLICTING_COUNTRY' END, CASE WHEN abroad THEN 'OUTSIDE_GEOGRAPHY' END], lambda e: e IS NOT NULL))), '; ') AS review_reasons,
  created_us, updated_us, n_records
FROM f LEFT JOIN b USING (company_id)"""
)
def resolved_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = identity.resolve(_records(spark, sf_dir)).companies
    lists = ("locations_if_known", "discovery_sources", "discovery_queries", "review_reasons")
    return out.select(
        "company_id", "name", "normalized_name", "domain", "country", *map(_joined, lists),
        F.unix_micros("created_at").alias("created_us"), F.unix_micros("updated_at").alias("updated_us"), "n_records",
    )


@query(f"""{_RESOLVED} SELECT (SELECT count(*) FROM r) AS n_in, (SELECT count(*) FROM x) AS n_members, (SELECT count(*) FROM q WHERE dom IS NULL AND n IS NULL) AS n_unresolved""")
def record_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record ends in a company or among the unresolved, none twice."""
    records = _records(spark, sf_dir)
    found = identity.resolve(records)
    count = lambda df, name: df.agg(F.count("*").alias(name))
    return count(records, "n_in").crossJoin(count(found.members, "n_members")).crossJoin(count(found.unresolved, "n_unresolved"))  # one row each


@query("""
SELECT company_id, snapshot_id, name, status, final_score FROM (SELECT DISTINCT company_id, snapshot_id, name, status, final_score FROM company_records)
QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY snapshot_id DESC) = 1""")
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "company_records").select("company_id", "snapshot_id", "name", "status", "final_score")
    return latest_by(rows, ["company_id"], F.col("snapshot_id"))


_PAGE = "regexp_extract(url, '^(https?://[^/?#]+)', 1)"


@query(f"""
WITH c AS (SELECT company_id, domain FROM company_records QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY snapshot_id DESC) = 1),
e AS (SELECT DISTINCT i.company_id, evidence_id, url, excerpt, loaded_at, c.domain FROM evidence_items i LEFT JOIN c USING (company_id) WHERE deleted_at IS NULL),
n AS (SELECT *, lower({_PAGE}) || coalesce(nullif(regexp_extract(url, '^https?://[^/?#]+([^#]*)', 1), ''), '/') AS page,
    {_domain("url")} AS site FROM e WHERE regexp_matches(lower(url), '^https?://[^/?#]')),
a AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY company_id, page ORDER BY loaded_at, evidence_id NULLS FIRST) = 1),
b AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY company_id, coalesce(site, page) ORDER BY loaded_at, evidence_id NULLS FIRST) <= CASE WHEN site = domain THEN 4 ELSE 2 END),
w AS (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY loaded_at, evidence_id NULLS FIRST) AS position,
    coalesce(sum(coalesce(least(length(excerpt), 2000), 0)) OVER (PARTITION BY company_id ORDER BY loaded_at, evidence_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM b)
SELECT company_id, evidence_id, position::BIGINT AS position, length(substr(excerpt, 1, least(2000, 20000 - before)::BIGINT)) AS n_chars
FROM w WHERE position <= 12 AND before < 20000""")
def evidence_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = latest_by(table(spark, sf_dir, "company_records").select("company_id", "snapshot_id", "domain"), ["company_id"], F.col("snapshot_id"))
    items = table(spark, sf_dir, "evidence_items").filter(F.col("deleted_at").isNull()).select("company_id", "evidence_id", "url", "excerpt", "loaded_at").distinct()
    rows = items.join(latest.select("company_id", "domain"), "company_id", "left")
    out = evidence.bundle(rows, F.col("domain"), [F.col("loaded_at")])
    return out.select("company_id", "evidence_id", F.col("position").cast("long").alias("position"), F.length("excerpt_used").cast("long").alias("n_chars"))


@query(f"""{_RESOLVED},
f AS (SELECT company_id, any_value(domain) AS domain, CASE WHEN min(k) = max(k) THEN min(k) END AS country, count(DISTINCT provider) AS n_sources, count(*) AS n_records,
    coalesce(bool_or(k NOT IN ('US', 'CA')), false) AS abroad FROM x GROUP BY 1)
SELECT company_id, n_sources, n_records FROM f WHERE NOT abroad AND (country IS NULL OR country IN ('US', 'CA'))
ORDER BY domain IS NULL, coalesce(country IN ('US', 'CA'), false) DESC, n_sources DESC, n_records DESC, company_id LIMIT 200""")
def research_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    companies = identity.resolve(_records(spark, sf_dir)).companies.withColumn("n_sources", F.size("discovery_sources").cast("long"))
    return evidence.research_order(companies, 200).select("company_id", "n_sources", "n_records")


@query("""
WITH c AS (SELECT company_id, name FROM company_records QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY snapshot_id DESC) = 1)
SELECT company_id, f AS family, trim(regexp_replace(coalesce(name, '') || ' ' || p, '[\\s\\x{a0}]+', ' ', 'g')) AS query FROM c,
  (VALUES (0, 'products services markets'), (1, 'branches locations employees'), (2, 'quotation estimating tender projects')) AS t(f, p)""")
def research_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = latest_by(table(spark, sf_dir, "company_records").select("company_id", "snapshot_id", "name"), ["company_id"], F.col("snapshot_id"))
    latest = latest.withColumn("name", F.regexp_replace("name", r"[\s ]+", " "))
    return evidence.research_requests(latest)


@query("""
SELECT contact_id, usable FROM (SELECT DISTINCT contact_id, lower(trim(work_email)) AS usable FROM contact_records)
WHERE regexp_full_match(usable, '[^@\\s]+@[^@\\s.]+(\\.[^@\\s.]+)+') AND split_part(usable, '@', -1) NOT IN
 ('aol.com','gmail.com','googlemail.com','hotmail.com','icloud.com','live.com','me.com','msn.com','outlook.com','proton.me','protonmail.com','yahoo.com','ymail.com')""")
def work_emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "contact_records").select("contact_id", text.usable_work_email(F.col("work_email")).alias("usable"))
    return rows.filter(F.col("usable").isNotNull()).distinct()


def _title_sql(x: str) -> str:
    first = lambda pairs: "CASE " + " ".join(f"WHEN regexp_matches({x}, '{p}') THEN '{n}'" for n, p in pairs) + " END"
    president = f"CASE WHEN regexp_matches({x}, '\\bpresident\\b') AND NOT contains({x}, 'vice president') THEN 'president' END"
    senior = f"CASE WHEN regexp_matches({x}, '{contacts.SENIOR}') THEN {first(contacts.WORK)} END"
    deputy = f"CASE WHEN regexp_matches({x}, '{contacts.MANAGER}') THEN {first(contacts.WORK + contacts.PLACES)} END"
    direct = f"coalesce({first(contacts.DIRECT)}, {president})"
    return f"coalesce('direct_decision_maker:' || {direct}, 'functional_decision_maker:' || {senior}, 'operational_deputy:' || {deputy})"


_TITLE = "nullif(trim(regexp_replace(regexp_replace(replace(replace(lower(title), '&', ' and '), '.', ''), '[^\\p{L}\\p{N}]+', ' ', 'g'), ' +', ' ', 'g')), '')"
_REASON = f"SELECT DISTINCT title, reason FROM (SELECT title, {_title_sql('t')} AS reason FROM (SELECT title, {_TITLE} AS t FROM contact_records WHERE title IS NOT NULL))"


@query(f"SELECT title, reason, CASE reason[1] WHEN 'd' THEN 1 WHEN 'f' THEN 2 WHEN 'o' THEN 3 END AS rank FROM ({_REASON})")
def title_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "contact_records").select("title").filter(F.col("title").isNotNull()).distinct()
    return rows.withColumn("reason", contacts.title_reason(F.col("title"))).withColumn("rank", contacts.title_rank(F.col("reason")))


_NAME = "nullif(trim(regexp_replace(lower(full_name), '[\\s\\x{a0}]+', ' ', 'g')), '')"
_PROFILE = "CASE WHEN regexp_matches(lower(trim(profile_url)), '^https?://[^/?#]') THEN 'https://' || regexp_replace(regexp_extract(lower(trim(profile_url)), '^https?://([^/?#:]+)', 1), '^www\\.', '') || coalesce(nullif(regexp_replace(regexp_replace(regexp_extract(trim(profile_url), '^[a-zA-Z]+://[^/?#]+([^?#]*)', 1), '/+', '/', 'g'), '/$', ''), ''), '/') END"


@query(f"""
WITH l AS (SELECT * FROM contact_records QUALIFY row_number() OVER (PARTITION BY contact_id ORDER BY observed_at DESC NULLS LAST, company_id NULLS LAST, title NULLS LAST, full_name NULLS LAST, profile_url NULLS LAST, company_domain NULLS LAST) = 1),
r AS (SELECT contact_id, company_id, {_title_sql('t')} AS reason, {_NAME} AS nm,
    coalesce('profile:' || {_PROFILE}, 'name_domain:' || {_NAME} || '|' || nullif(lower(trim(company_domain)), '')) AS key FROM (SELECT *, {_TITLE} AS t FROM l)),
k AS (SELECT *, CASE reason[1] WHEN 'd' THEN 1 WHEN 'f' THEN 2 WHEN 'o' THEN 3 END AS rank,
    CASE split_part(reason, ':', 2) WHEN 'estimating' THEN 0 WHEN 'inside_sales' THEN 1 WHEN 'operations' THEN 2 WHEN 'sales' THEN 3 WHEN 'commercial' THEN 4
      WHEN 'branch' THEN 5 WHEN 'regional' THEN 6 ELSE 7 END AS rel FROM r WHERE reason IS NOT NULL AND key IS NOT NULL AND company_id IS NOT NULL),
o AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY company_id, key ORDER BY rank, rel, nm NULLS LAST, contact_id) = 1)
SELECT company_id, contact_id, reason, row_number() OVER (PARTITION BY company_id ORDER BY rank, rel, nm NULLS LAST, contact_id)::INT AS position FROM o
QUALIFY position <= 3""")
def selected_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "contact_records").select("contact_id", "company_id", "full_name", "title", "profile_url", "company_domain", "observed_at")
    tie = [F.col(c).asc_nulls_last() for c in ("company_id", "title", "full_name", "profile_url", "company_domain")]
    latest = latest_by(rows, ["contact_id"], F.col("observed_at"), tie)
    return contacts.select_contacts(latest).select("company_id", "contact_id", "reason", "position")


@query(f"""
SELECT contact_id, row_number() OVER (ORDER BY company_final_score DESC NULLS LAST, decision_rank NULLS LAST, {_NAME} NULLS LAST, contact_id) AS place
FROM (SELECT * FROM contact_records QUALIFY row_number() OVER (PARTITION BY contact_id ORDER BY observed_at DESC NULLS LAST, company_final_score DESC NULLS LAST, decision_rank NULLS LAST, full_name NULLS LAST) = 1)""")
def publication_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every contact in the report, by its latest version: a sort into ranges and offsets, no task holds all."""
    rows = table(spark, sf_dir, "contact_records").select("contact_id", "company_final_score", "decision_rank", "full_name", "observed_at")
    tie = [F.col("company_final_score").desc_nulls_last(), F.col("decision_rank").asc_nulls_last(), F.col("full_name").asc_nulls_last()]
    order = contacts.publication_order(*map(F.col, ("company_final_score", "decision_rank", "_name", "contact_id")))
    latest = latest_by(rows, ["contact_id"], F.col("observed_at"), tie).withColumn("_name", text.normalize_person_name(F.col("full_name")))
    return numbered(latest, order, "place").select("contact_id", "place")


@query("""
WITH e AS (SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_id, value FROM events),
u AS (SELECT event_type AS provider, k AS request_count, CASE WHEN event_type = 'error' AND k % 17 = 0 THEN NULL ELSE 1.0 * k / 8 END AS cost_usd FROM e)
SELECT provider, grouping(provider)::TINYINT AS is_total, sum(request_count)::BIGINT AS request_count,
  CASE WHEN count(cost_usd) = count(*) THEN round(sum(cost_usd), 10) END AS cost_usd FROM u GROUP BY GROUPING SETS ((provider), ())""")
def usage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    cost = F.when(~((F.col("event_type") == "error") & (k % 17 == 0)), k / 8)
    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("provider"), k.alias("request_count"), cost.alias("cost_usd"))
    return ledger.usage_totals(events, "provider", ["request_count"], ["cost_usd"])


_RUNNING = "PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


@query(f"""
WITH e AS (SELECT event_id, user_id, ts, CAST(json_extract(props, '$.k') AS BIGINT) / 8 AS amount FROM events),
f AS (SELECT *, coalesce(sum(amount) OVER ({_RUNNING}) <= 40 + 1e-12, false) AS fits FROM e)
SELECT event_id, bool_and(fits) OVER ({_RUNNING}) AS admitted FROM f""")
def budget_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.get_json_object("props", "$.k").cast("long") / 8
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", amount.alias("amount"))
    return ledger.admitted_prefix(events, ["user_id"], ["ts", "event_id"], "amount", F.lit(40.0)).select("event_id", "admitted")


@query(f"SELECT event_id, sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) OVER ({_RUNNING})::BIGINT AS cursor FROM events")
def call_cursor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.call_cursor(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") != "error").select("event_id", "cursor")


_STATES = "CASE status WHEN 'active' THEN 0 ELSE 1 END"


@query(f"""
WITH s AS (SELECT DISTINCT company_id, snapshot_id, status FROM company_records),
l AS (SELECT company_id, snapshot_id, {_STATES} AS rank_now, lag({_STATES}) OVER (PARTITION BY company_id ORDER BY snapshot_id) AS rank_before FROM s)
SELECT company_id, snapshot_id FROM l WHERE rank_now < rank_before""")
def state_regressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "company_records").select("company_id", "snapshot_id", "status").distinct()
    rank = F.when(F.col("status") == "active", 0).otherwise(1)
    return ledger.regressions(rows, ["company_id"], ["snapshot_id"], rank).select("company_id", "snapshot_id")


@query("""
WITH r AS (SELECT request_id, max_results_total AS total, len(queries) AS slots, unnest(generate_series(0, len(queries) - 1)) AS slot FROM discovery_requests WHERE len(queries) > 0)
SELECT request_id, slot::INT AS slot, (total // slots + CASE WHEN slot < total % slots THEN 1 ELSE 0 END)::BIGINT AS share FROM r""")
def allocation_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "discovery_requests").select("request_id", "max_results_total", F.size("queries").alias("slots"), F.posexplode("queries").alias("slot", "q"))
    return rows.select("request_id", "slot", ledger.allocate(F.col("max_results_total"), F.col("slots"), F.col("slot")).cast("long").alias("share"))


@query("""
WITH a AS (SELECT request_id, count(*) AS n_expected FROM discovery_requests GROUP BY 1),
f AS (SELECT request_id, count(*) AS n_found FROM (SELECT DISTINCT * FROM discovery_exa) GROUP BY 1)
SELECT request_id, coalesce(n_expected, 0) AS n_expected, coalesce(n_found, 0) AS n_found FROM a FULL JOIN f USING (request_id)
WHERE coalesce(n_found, 0) <> 1 OR coalesce(n_expected, 0) = 0""")
def request_exactly_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.exactly_once(table(spark, sf_dir, "discovery_requests"), table(spark, sf_dir, "discovery_exa").distinct(), "request_id")


_DECISIONS = ("accepted", "uncertain", "rejected")
_STATUSES = ("active", "merged", "closed")


@query("""
SELECT s.status, """ + ", ".join(f"count(*) FILTER (final_decision = '{d}') AS {d}" for d in _DECISIONS) + f""" FROM (VALUES {", ".join(f"('{s}')" for s in _STATUSES)}) AS s(status)
LEFT JOIN (SELECT DISTINCT * FROM company_records) c ON c.status = s.status GROUP BY 1""")
def decision_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "company_records").select("snapshot_id", "status", "final_decision").distinct()
    return calibration.confusion(rows, "status", "final_decision", _STATUSES, _DECISIONS)


@query("""
SELECT final_decision, count(final_score) AS n, round(min(final_score), 6) AS low, round(max(final_score), 6) AS high, round(avg(final_score), 6) AS mean
FROM (SELECT DISTINCT snapshot_id, final_decision, final_score FROM company_records) WHERE final_decision IS NOT NULL GROUP BY 1""")
def score_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "company_records").select("snapshot_id", "final_decision", "final_score").distinct()
    return calibration.metric_summary(rows, "final_decision", "final_score", 6)


@query("""
SELECT DISTINCT snapshot_id, CASE WHEN status = 'active' AND final_decision = 'rejected' OR status <> 'active' AND final_decision = 'accepted' THEN 'critical' ELSE 'review' END AS kind
FROM company_records WHERE status = 'active' AND final_decision IN ('rejected', 'uncertain') OR status <> 'active' AND final_decision = 'accepted'""")
def decision_disagreements(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "company_records").select("snapshot_id", F.when(F.col("status") == "active", "A").otherwise("C").alias("label"), "final_decision")
    kinds = {"critical": [("A", "rejected"), ("C", "accepted")], "review": [("A", "uncertain")]}
    return calibration.disagreements(rows, "label", "final_decision", "snapshot_id", kinds)


@query("""
SELECT DISTINCT snapshot_id, CASE WHEN regexp_matches(coalesce(name, ''), '^\\s*[=+\\-@]') THEN '''' ELSE '' END || coalesce(name, '') AS cell,
  CASE WHEN final_score IS NULL THEN '' ELSE printf('%.2f', final_score) END AS score_cell,
  coalesce(array_to_string(review_reasons, ';'), '') AS reasons FROM company_records""")
def export_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "company_records").select("snapshot_id", "name", "final_score", "review_reasons").distinct()
    score = F.when(F.col("final_score").isNull(), "").otherwise(F.format_string("%.2f", "final_score"))
    return rows.select("snapshot_id", text.formula_safe(F.col("name")).alias("cell"), score.alias("score_cell"), F.coalesce(F.array_join("review_reasons", ";"), F.lit("")).alias("reasons"))


@query("""
WITH c AS (SELECT evidence_id, unnest(regexp_split_to_array(excerpt, '(?i)(?:[.!?;:\\n]+|\\b(?:and|but|however|whereas|while|yet)\\b)')) AS x
  FROM (SELECT DISTINCT evidence_id, excerpt FROM evidence_items WHERE evidence_id IS NOT NULL))
SELECT evidence_id, count(*) AS n_clauses FROM c WHERE trim(regexp_replace(x, '[\\s\\x{a0}]+', ' ', 'g')) <> '' GROUP BY 1""")
def clause_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "evidence_items").select("evidence_id", "excerpt").filter(F.col("evidence_id").isNotNull()).distinct()
    return rows.select("evidence_id", F.explode(text.clauses(F.col("excerpt"))).alias("c")).groupBy("evidence_id").agg(F.count("*").alias("n_clauses"))


@query("""
WITH l AS (SELECT sha256(company_id || ':' || final_decision) AS h FROM (SELECT * FROM company_records QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY snapshot_id DESC) = 1) WHERE final_decision = 'accepted')
SELECT sha256(count(*) || ':' || coalesce(sum(('0x' || h[:15])::BIGINT), 0) || ':' || coalesce(sum(('0x' || h[16:30])::BIGINT), 0)) AS fingerprint FROM l""")
def input_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A digest of the accepted companies as a set: the sums of two parts of their digests, so that none gathers them."""
    rows = table(spark, sf_dir, "company_records").select("company_id", "snapshot_id", "final_decision")
    kept = latest_by(rows, ["company_id"], F.col("snapshot_id")).filter(F.col("final_decision") == "accepted")
    return kept.agg(values.set_digest(F.concat("company_id", F.lit(":"), "final_decision")).alias("fingerprint"))


@query(f"""SELECT DISTINCT record_id, {_domain("website_url")} AS domain FROM ({_RECORDS})""")
def company_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).select("record_id", url.company_domain(F.col("website_url")).alias("domain")).distinct()


@query(f"""SELECT DISTINCT contact_id, {_PROFILE} AS profile FROM contact_records""")
def profile_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "contact_records").select("contact_id", url.profile_url(F.col("profile_url")).alias("profile")).distinct()


@query(f"""SELECT DISTINCT snapshot_id, {_company("name")} AS form, 'cmp_' || substr(sha256('fallback:' || {_company("name")}), 1, 24) AS digest FROM company_records""")
def company_name_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "company_records").select("snapshot_id", text.normalize_company_name(F.col("name")).alias("form"))
    return rows.withColumn("digest", values.digest_id("cmp_", F.concat(F.lit("fallback:"), "form"))).distinct()


def _bounded(pattern: str) -> str:
    """Word bounds spelt out, as those of SQL know ASCII letters only."""
    start, end = r"(^|[^\p{L}\p{N}_])", r"([^\p{L}\p{N}_]|$)"
    return re.sub(r"\\b(?=[\w(])", lambda _: start, pattern).replace(r"\b", end).replace("'", "''")


def _speaks(groups: tuple[tuple[str, ...], ...]) -> str:
    return " AND ".join(f"regexp_matches(c, '{_bounded('|'.join(patterns))}')" for patterns in groups)


_FACT_LIST = ", ".join(f"CASE WHEN {_speaks(groups)} THEN '{fact}' END" for fact, groups in vocabulary.PREDICATES.items())


@query(f"""
WITH e AS (SELECT DISTINCT company_id, evidence_id, excerpt FROM evidence_items WHERE company_id IS NOT NULL AND deleted_at IS NULL),
s AS (SELECT company_id, unnest(regexp_split_to_array(lower(excerpt), '(?i)(?:[.!?;:\\n]+|\\b(?:and|but|however|whereas|while|yet)\\b)')) AS c FROM e),
f AS (SELECT company_id, regexp_matches(c, '{_bounded(vocabulary.DENIAL)}') AS d, unnest([{_FACT_LIST}]) AS fact FROM s)
SELECT company_id, fact, count(*) FILTER (NOT d) AS stated, count(*) FILTER (d) AS denied FROM f WHERE fact IS NOT NULL GROUP BY 1, 2""")
def term_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "evidence_items").filter(F.col("deleted_at").isNull()).select("company_id", "evidence_id", "excerpt").distinct()
    return support.support(items, "company_id", "excerpt")
