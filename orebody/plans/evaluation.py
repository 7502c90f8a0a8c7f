"""Queries of extracted facts, their support and evaluated companies over whole tables, each with the SQL it must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebody.functions import text, values
from orebody.operators import calibration, contacts, facts, identity, ledger, propositions, ranking, vocabulary
from orebody.operators.topn import latest_by, numbered
from orebody.plans.domain import _PREPARED, ORACLE, QUERIES, _bounded, _records, query  # noqa: F401
from orebody.session import table
from orebody.sources.documents import within_size

COUNTED = ("branch_count", "employee_count")


def _latest(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return latest_by(table(spark, sf_dir, "company_records").select("company_id", "snapshot_id", *columns), ["company_id"], F.col("snapshot_id"))


_LATEST = "SELECT * FROM company_records QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY snapshot_id DESC) = 1"


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items that companies hold now, repeated rows once."""
    rows = table(spark, sf_dir, "evidence_items").filter(F.col("deleted_at").isNull() & F.col("evidence_id").isNotNull())
    return rows.select("company_id", "evidence_id", "title", "excerpt").distinct()


_ITEMS = "SELECT DISTINCT company_id, evidence_id, title, excerpt FROM evidence_items WHERE deleted_at IS NULL AND evidence_id IS NOT NULL"


def _told(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded answers: the counts of the latest snapshot, cited to the company's smallest and greatest item."""
    ends = _items(spark, sf_dir).groupBy("company_id").agg(F.min("evidence_id").alias("lo"), F.max("evidence_id").alias("hi"))
    rows = _latest(spark, sf_dir, "features").join(ends, "company_id", "left")
    cited = F.array_distinct(F.array_compact(F.array("lo", "hi")))
    none = F.struct(F.lit(None).cast("long").alias("value"), F.lit(0.0).alias("confidence"), F.array().cast("array<string>").alias("evidence_ids"))
    number = lambda k: F.get_json_object("features", f"$.{k}").cast("long")
    fact = lambda k: F.when(number(k).isNull(), none).otherwise(F.struct(number(k).alias("value"), F.lit(0.9).alias("confidence"), cited.alias("evidence_ids")))
    content = F.to_json(F.struct(F.struct(*[(fact(k) if k in COUNTED else none).alias(k) for k in vocabulary.FACT_KEYS]).alias("facts")), {"ignoreNullFields": "false"})
    choice = F.struct(F.lit("stop").alias("finish_reason"), F.struct(content.alias("content")).alias("message"))
    return rows.select("company_id", F.to_json(F.struct(F.array(choice).alias("choices"))).alias("body"))


_FACTS = f"""
WITH c AS ({_LATEST}), i AS ({_ITEMS}), e AS (SELECT company_id, min(evidence_id) AS lo, max(evidence_id) AS hi FROM i GROUP BY 1),
t AS (SELECT company_id, unnest(['branch_count', 'employee_count']) AS fact_key, unnest([json_extract_string(features, '$.branch_count'), json_extract_string(features, '$.employee_count')]) AS value FROM c),
f AS (SELECT t.*, lo, hi, CASE WHEN value IS NOT NULL AND lo IS NULL THEN 'unknown' END AS problem FROM t LEFT JOIN e USING (company_id))
"""


@query(f"""{_FACTS} SELECT company_id, fact_key, coalesce(value, 'null') AS value, CASE WHEN value IS NULL THEN 0.0 ELSE 0.9 END::DOUBLE AS confidence,
  CASE WHEN value IS NULL OR lo IS NULL THEN 0 WHEN lo = hi THEN 1 ELSE 2 END::INT AS n_cited, problem FROM f""")
def extracted_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = facts.answers(_told(spark, sf_dir)).filter(F.col("fact_key").isin(*COUNTED))
    return out.select("company_id", "fact_key", "value", "confidence", F.size("evidence_ids").alias("n_cited"), "problem")


def _any(phrases: tuple[str, ...]) -> str:
    return "|".join(p.replace(" ", r"\s+") for p in phrases)


def _counts(key: str) -> str:
    """A clause that supports the number v of a fact: with a unit, or tied to a concept."""
    bound = r"\s*([,=/\-–—:]\s*|\b(count|number|total|value|level|breadth|of|is|are|was|were|equals?|include|includes|including|comprise|comprises|comprising)\b\s*)*"
    forms = [
        f"'(^|[^\\d.])' || value || '\\s+({_any(vocabulary.UNITS[key])})\\b'",
        f"'(^|[^\\w.])' || value || '[^\\w.''][^A-Za-z0-9'']*({_any(vocabulary.CONCEPTS[key])})\\b'",
        f"'\\b({_any(vocabulary.CONCEPTS[key])}){bound}' || value || '([^\\w.]|$)'",
    ]
    return "(" + " OR ".join(f"regexp_matches(c, {p})" for p in forms) + ")"


def _speaks(key: str) -> str:
    """Terms, none of them within four words of a denial, and all groups of patterns."""
    inner, outer = r"[\p{L}\p{N}_'']", r"[^\p{L}\p{N}_'']"  # word bounds spelt out, as those of SQL know ASCII letters only
    start, end, gap = r"(^|[^\p{L}\p{N}_])", r"([^\p{L}\p{N}_]|$)", rf"{outer}+({inner}+{outer}+){{0,4}}"
    term, deny = f"({'|'.join(vocabulary.TERMS[key])})", vocabulary.DENIAL.removeprefix(r"\b").removesuffix(r"\b").replace("'", "''")
    near = f"regexp_matches(c, '{start}{deny}{gap}{term}{end}') OR regexp_matches(c, '{start}{term}{gap}{deny}{end}')"
    groups = " AND ".join("(" + " OR ".join(f"regexp_matches(c, '{_bounded(p)}')" for p in g) + ")" for g in vocabulary.PREDICATES[key])
    return f"regexp_matches(c, '{start}{term}{end}') AND NOT ({near}) AND {groups}"


_CLAUSES = f"SELECT company_id, evidence_id, unnest(regexp_split_to_array(lower(x), '(?i){vocabulary.CLAUSE_END}')) AS c FROM (SELECT company_id, evidence_id, unnest([title, excerpt]) AS x FROM i) WHERE x IS NOT NULL"


@query(f"""{_FACTS},
k AS ({_CLAUSES}),
s AS (SELECT DISTINCT f.company_id, fact_key FROM f JOIN k ON k.company_id = f.company_id AND k.evidence_id IN (lo, hi)
  WHERE {" OR ".join(f"(fact_key = '{key}' AND {_speaks(key)} AND {_counts(key)})" for key in COUNTED)})
SELECT f.company_id, f.fact_key, f.value, s.fact_key IS NOT NULL AS supported FROM f LEFT JOIN s ON s.company_id = f.company_id AND s.fact_key = f.fact_key
WHERE f.value IS NOT NULL AND f.company_id NOT IN (SELECT company_id FROM f WHERE problem IS NOT NULL)""")
def supported_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts that companies state, as far as the cited items support them."""
    items = _items(spark, sf_dir)
    told = facts.accepted(facts.answers(_told(spark, sf_dir)), items)
    out = propositions.supported(told, items).filter(F.col("value") != "null")
    return out.select("company_id", "fact_key", "value", "supported")


_PLAIN = tuple(k for k in vocabulary.FACT_KEYS if k not in ("pvf_relevant", *COUNTED, "manufacturer_count_or_breadth", "revenue_if_reliably_available"))


@query(f"""WITH i AS ({_ITEMS}), k AS ({_CLAUSES}), o AS (SELECT DISTINCT company_id FROM i),
y AS (SELECT company_id, unnest([{", ".join(f"CASE WHEN {_speaks(key)} THEN '{key}' END" for key in _PLAIN)}]) AS fact_key FROM k),
g AS (SELECT company_id, unnest([{", ".join(f"'{key}'" for key in _PLAIN)}]) AS fact_key FROM o)
SELECT g.company_id, g.fact_key, EXISTS (SELECT 1 FROM y WHERE y.company_id = g.company_id AND y.fact_key = g.fact_key) AS supported FROM g""")
def stated_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every company with evidence and every fact that is a truth value: whether any of its items supports it."""
    items = _items(spark, sf_dir)
    owned = items.select("company_id", "evidence_id").distinct()
    asked = owned.select("company_id", F.explode(F.array(*map(F.lit, _PLAIN))).alias("fact_key"), F.lit("true").alias("value"), F.array("evidence_id").alias("evidence_ids"))
    out = propositions.supported(asked, items)  # one item cited at a time, so that no list of a company's items is built
    return out.groupBy("company_id", "fact_key").agg(F.bool_or("supported").alias("supported"))


_REL = "(?:" + "|".join(vocabulary.RELATIONS["pvf_relevant"]) + ")"
_TGT = "(?:" + "|".join(vocabulary.CONCEPTS["pvf_relevant"]) + ")"


def _lead(pattern: str) -> str:
    """A pattern of what stands before a word, without its end and its first word bound, quoted for SQL."""
    return "(?:" + pattern.removesuffix("$").replace(r"\b", "").replace("'", "''") + ")"


def _marked(x: str, before: str, word: str) -> str:
    """SQL that puts ~ before a word that follows a pattern; twice, as matches that touch do not both count."""
    for _ in range(2):
        x = f"regexp_replace({x}, '((?:^|[^\\w~]){before})({word})($|[^\\w])', '\\1~\\2\\3', 'g')"
    return x


def _denied_relations(x: str) -> str:
    for pattern in vocabulary.RELATION_DENIED:
        x = _marked(x, _lead(pattern), _REL)
    for _ in range(4):  # a denial goes on to the next of at most five relations
        x = f"regexp_replace({x}, '(~{_REL}(?:{vocabulary.OBJECT_BRIDGE}{_TGT})?{vocabulary.COORDINATION})({_REL})($|[^\\w])', '\\1~\\2\\3', 'g')"
    return x


def _denied_concepts(x: str) -> str:
    for pattern in (*vocabulary.CONCEPT_DENIED, vocabulary.VERB_DENIED.replace("[a-z][", "~?[a-z][")):  # words between may be marked
        x = _marked(_marked(x, _lead(pattern), _TGT), _lead(pattern), _TGT)
    return x


_PAIR = f"{_REL}{vocabulary.OBJECT_BRIDGE}{_TGT}($|[^\\w])"


@query(f"""WITH i AS ({_ITEMS}), k AS ({_CLAUSES}),
m AS (SELECT company_id, evidence_id, {_denied_relations("c")} AS r, {_denied_concepts("c")} AS t, regexp_matches(c, '(^|[^\\w]){_REL}($|[^\\w])') AS acts FROM k),
v AS (SELECT company_id, evidence_id, bool_or(CASE WHEN acts THEN regexp_matches(r, '(^|[^\\w~]){_PAIR}') ELSE regexp_matches(t, '(^|[^\\w~]){_TGT}($|[^\\w])') END) AS yes,
  bool_or(regexp_matches(r, '~{_PAIR}')) AND NOT bool_or(regexp_matches(r, '(^|[^\\w~]){_PAIR}')) AS no FROM m GROUP BY 1, 2)
SELECT i.company_id, coalesce(bool_or(yes), false) AS relevant, coalesce(bool_or(no), false) AS denied FROM i LEFT JOIN v USING (company_id, evidence_id) GROUP BY 1""")
def relevance_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a company's evidence supports, or denies without contradiction, that it deals in pipe, valves and fittings."""
    items = _items(spark, sf_dir)
    owned = items.select("company_id", "evidence_id").distinct()
    asked = owned.select("company_id", F.lit("pvf_relevant").alias("fact_key"), F.explode(F.array(F.lit("true"), F.lit("false"))).alias("value"), F.array("evidence_id").alias("evidence_ids"))
    out = propositions.supported(asked, items).groupBy("company_id").agg(
        F.bool_or((F.col("value") == "true") & F.col("supported")).alias("relevant"), F.bool_or((F.col("value") == "false") & F.col("supported")).alias("denied")
    )
    return out


@query(f"""{_FACTS},
k AS ({_CLAUSES}),
s AS (SELECT DISTINCT f.company_id, fact_key FROM f JOIN k ON k.company_id = f.company_id AND k.evidence_id IN (lo, hi)
  WHERE {" OR ".join(f"(fact_key = '{key}' AND {_speaks(key)} AND {_counts(key)})" for key in COUNTED)}),
b AS (SELECT company_id FROM f WHERE problem IS NOT NULL)
SELECT c.company_id, CASE WHEN b.company_id IS NULL THEN coalesce(max(f.value) FILTER (f.fact_key = 'branch_count' AND s.fact_key IS NOT NULL), 'null') END AS branch_count,
  CASE WHEN b.company_id IS NULL THEN coalesce(max(f.value) FILTER (f.fact_key = 'employee_count' AND s.fact_key IS NOT NULL), 'null') END AS employee_count,
  CASE WHEN b.company_id IS NULL THEN 'completed' ELSE c.stage_status['extraction'] END AS extraction
FROM c JOIN f ON f.company_id = c.company_id LEFT JOIN s ON s.company_id = f.company_id AND s.fact_key = f.fact_key LEFT JOIN (SELECT DISTINCT company_id FROM b) b ON b.company_id = c.company_id
GROUP BY c.company_id, b.company_id, c.stage_status""")
def applied_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _items(spark, sf_dir)
    told = facts.accepted(facts.answers(_told(spark, sf_dir)), items)
    out = facts.applied(_latest(spark, sf_dir, "stage_status"), told, items)
    return out.select("company_id", *[F.col("features")[k].alias(k) for k in COUNTED], F.col("stage_status")["extraction"].alias("extraction"))


@query(f"""WITH i AS ({_ITEMS}), r AS (SELECT DISTINCT reason_id, company_id, unnest(evidence_ids) AS evidence_id FROM decision_reasons)
SELECT reason_id, evidence_id FROM r WHERE evidence_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM i WHERE i.company_id = r.company_id AND i.evidence_id = r.evidence_id)""")
def unretained_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citations, as written, of items that the company does not hold now."""
    rows = table(spark, sf_dir, "decision_reasons").select("company_id", F.col("reason_id").alias("fact_key"), F.array_compact("evidence_ids").alias("evidence_ids"))
    return facts.unretained(rows, _items(spark, sf_dir)).select(F.col("fact_key").alias("reason_id"), "evidence_id").distinct()


@query("""SELECT DISTINCT reason_id, array_to_string(list_sort(list_distinct(list_filter(coalesce(evidence_ids, []) || [code], lambda x: x IS NOT NULL))), '|') AS cited FROM decision_reasons""")
def citation_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "decision_reasons").select("reason_id", "evidence_ids", "code")
    return rows.select("reason_id", F.array_join(facts.citation_union(F.col("evidence_ids"), F.array("code")), "|").alias("cited")).distinct()


@query("""WITH n AS (SELECT company_id, evidence_id, count(*) AS n FROM evidence_items GROUP BY 1, 2)
SELECT company_id, coalesce(sum(n) FILTER (coalesce(evidence_id, '') = ''), 0)::BIGINT AS blank, sum(CASE WHEN coalesce(evidence_id, '') = '' THEN 0 ELSE n - 1 END)::BIGINT AS repeated
FROM n GROUP BY 1 HAVING blank > 0 OR repeated > 0""")
def evidence_id_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.item_problems(table(spark, sf_dir, "evidence_items").select("company_id", "evidence_id"))


@query("""SELECT DISTINCT snapshot_id, len(list_distinct(list_filter(list_transform(discovery_queries, lambda x: trim(lower(x), ' \t\n\r')), lambda x: x <> '')))::INT AS n_named,
  list_sort(json_keys(features)) = ['branch_count', 'employee_count'] AS whole FROM company_records""")
def distinct_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many distinct entries a list of names has, and whether the features have exactly the keys they should."""
    rows = table(spark, sf_dir, "company_records").select("snapshot_id", "discovery_queries", "features")
    whole = facts.exact_keys(F.try_parse_json("features"), COUNTED)
    return rows.select("snapshot_id", facts.distinct_entries(F.col("discovery_queries")).alias("n_named"), whole.alias("whole")).distinct()


@query("""
WITH d AS (SELECT DISTINCT company_id, snapshot_id, name, stage_status FROM company_records),
x AS (SELECT * FROM d WHERE stage_status['extraction'] = 'completed' QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY snapshot_id DESC) = 1),
b AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY snapshot_id) = 1)
SELECT b.company_id, coalesce(x.snapshot_id, b.snapshot_id) AS snapshot_id, x.company_id IS NOT NULL AS extracted FROM b LEFT JOIN x USING (company_id)""")
def extraction_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each company as its latest completed extraction left it, else as it was first recorded."""
    rows = table(spark, sf_dir, "company_records").select("company_id", "snapshot_id", "stage_status")
    done = F.coalesce(F.col("stage_status")["extraction"] == "completed", F.lit(False))
    best = rows.groupBy("company_id").agg(F.max(F.when(done, F.col("snapshot_id"))).alias("x"), F.min("snapshot_id").alias("b"))
    return best.select("company_id", F.coalesce("x", "b").alias("snapshot_id"), F.col("x").isNotNull().alias("extracted"))


_SORT = "trim(regexp_replace(lower(coalesce(nullif(normalized_name, ''), name)), '[\\s\\x{a0}]+', ' ', 'g'))"


@query(f"""
SELECT company_id, final_decision, row_number() OVER (ORDER BY CASE final_decision WHEN 'accepted' THEN 1 WHEN 'uncertain' THEN 2 WHEN 'rejected' THEN 3 ELSE 4 END,
  final_score DESC NULLS LAST, len(discovery_sources) / 2 DESC NULLS LAST, {_SORT}, company_id) AS place FROM ({_LATEST})""")
def ranked_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every company's place; the sources that saw it stand for its coverage."""
    rows = _latest(spark, sf_dir, "name", "normalized_name", "final_decision", "final_score", "discovery_sources")
    rows = rows.withColumn("coverage", F.size("discovery_sources") / 2)
    return ranking.ranked(rows).select("company_id", "final_decision", "place")


@query(f"""
WITH r AS (SELECT *, row_number() OVER (ORDER BY CASE final_decision WHEN 'accepted' THEN 1 WHEN 'uncertain' THEN 2 WHEN 'rejected' THEN 3 ELSE 4 END,
  final_score DESC NULLS LAST, len(discovery_sources) / 2 DESC NULLS LAST, {_SORT}, company_id) AS place FROM ({_LATEST}))
SELECT company_id, final_decision AS view, row_number() OVER (PARTITION BY final_decision ORDER BY place) AS place_in_view FROM r WHERE final_decision IN ('rejected', 'uncertain')""")
def decision_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two views of the ranking, in its order: places less those of the decisions before."""
    placed = ranked_companies(spark, sf_dir)
    starts = placed.groupBy("final_decision").agg((F.min("place") - 1).alias("before"))  # one row per decision
    views = placed.filter(F.col("final_decision").isin("rejected", "uncertain")).join(F.broadcast(starts), "final_decision")
    return views.select("company_id", F.col("final_decision").alias("view"), (F.col("place") - F.col("before")).alias("place_in_view"))


_CELL = "CASE WHEN regexp_matches(coalesce({0}, ''), '^\\s*[=+\\-@]') THEN '''' ELSE '' END || coalesce({0}, '')"
_EMPTY = {c: "''" for c in ranking.COMPANY_SHEET}
_SHEET = _EMPTY | {
    "company_id": _CELL.format("company_id"), "name": _CELL.format("name"), "domain": _CELL.format("coalesce(nullif(normalized_domain, ''), domain)"), "country": _CELL.format("country"),
    "policy_version": "'1'", "final_score": "CASE WHEN final_score IS NULL THEN '' ELSE printf('%.2f', final_score) END", "final_decision": "final_decision",
    "workload_score": "CASE WHEN final_score IS NULL THEN '' ELSE printf('%.2f', final_score) END", "workload_coverage": "printf('%.4f', len(discovery_sources) / 2)",
    "overall_coverage": "printf('%.4f', len(discovery_sources) / 2)", "review_reasons": "coalesce(array_to_string(review_reasons, ';'), '')", "rejection_reasons": "coalesce(array_to_string(rejection_reasons, ';'), '')",
} | {f"{c}_coverage": "'0.0000'" for c in ranking.COMPONENTS[1:]}


@query(f"""SELECT {", ".join(f"{x} AS {c}" for c, x in _SHEET.items())}, CASE WHEN status = 'active' THEN 'A' ELSE '' END AS manual_label,
  CASE WHEN status = 'active' THEN {_CELL.format("run_id")} ELSE '' END AS manual_notes FROM ({_LATEST})""")
def labelled_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 18 columns of every company with a label where one was given (here: to active ones)."""
    rows = _latest(spark, sf_dir, "name", "domain", "normalized_domain", "country", "final_score", "final_decision", "review_reasons", "rejection_reasons", "discovery_sources", "status", "run_id")
    cover = F.size("discovery_sources") / 2
    rows = rows.withColumns({
        "policy_version": F.lit("1"), "score_components": F.create_map(F.lit("workload"), F.col("final_score")),
        "coverage": F.create_map(F.lit("workload"), cover, F.lit("overall"), cover),
    })
    labels = rows.filter(F.col("status") == "active").select("company_id", F.lit("A").alias("manual_label"), F.col("run_id").alias("manual_notes"))
    return ranking.with_labels(ranking.company_sheet(rows), labels)


@query(f"""SELECT DISTINCT {", ".join(f"{_CELL.format(f'{c}::VARCHAR')} AS {c}" for c in ranking.CONTACT_SHEET if c != 'company_final_score')} FROM contact_records""")
def contact_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contacts' sheet; scores, whose shortest text form differs between engines, are left to its test."""
    return ranking.contact_sheet(table(spark, sf_dir, "contact_records")).drop("company_final_score").distinct()


@query(f"""{_PREPARED} SELECT record_id, row_number() OVER (ORDER BY record_id, provider, request_id, retrieved_at, raw_metadata) AS place FROM q WHERE dom IS NULL AND n IS NULL""")
def unresolved_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that belong to no company, in one order."""
    rows = identity.resolve(_records(spark, sf_dir)).unresolved
    return numbered(rows, [F.col(c) for c in ("record_id", "provider", "request_id", "retrieved_at", "raw_metadata")], "place").select("record_id", "place")


_PHRASES = ("inside sales", "bill of materials", "line items", "quote", "rfq", "team members")
_COUNTS = ", ".join(f"""len(regexp_extract_all(lower(excerpt), '\\b{p.replace(" ", "[\\s]+")}\\b'))::INT AS n_{p.replace(" ", "_")}""" for p in _PHRASES)


@query(f"SELECT DISTINCT evidence_id, {_COUNTS} FROM evidence_items WHERE evidence_id IS NOT NULL AND excerpt IS NOT NULL")
def phrase_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often phrases stand in a text as whole words, their spaces of any length."""
    rows = table(spark, sf_dir, "evidence_items").filter(F.col("evidence_id").isNotNull() & F.col("excerpt").isNotNull())
    return rows.select("evidence_id", *[text.phrase_count(F.col("excerpt"), p).alias(f"n_{p.replace(' ', '_')}") for p in _PHRASES]).distinct()


_EVENT = "SELECT event_id, event_type AS provider, 'op' AS operation, CAST(json_extract(props, '$.k') AS BIGINT) - 3 AS request_count, value AS exact_cost_usd FROM events"


@query(f"""SELECT event_id, CASE WHEN request_count < 0 THEN 'request_count' WHEN exact_cost_usd < 0 THEN 'exact_cost_usd' END AS problem FROM ({_EVENT})""")
def usage_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with each usage event, if anything."""
    k = F.get_json_object("props", "$.k").cast("long")
    events = table(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias("provider"), F.lit("op").alias("operation"), (k - 3).alias("request_count"), k.alias("input_tokens"), k.alias("output_tokens"),
        F.lit(None).cast("double").alias("estimated_cost_usd"), F.col("value").alias("exact_cost_usd"), F.col("props").alias("metadata"), F.col("ts").alias("recorded_at"),
    )
    return events.select("event_id", ledger.usage_problem().alias("problem"))


@query("""
WITH u AS (SELECT event_type AS provider, CAST(json_extract(props, '$.k') AS BIGINT) AS request_count FROM events
  UNION ALL SELECT provider, count(*) FROM discovery_exa GROUP BY 1, request_id)
SELECT provider, count(*) AS n_events, sum(request_count)::BIGINT AS request_count FROM u GROUP BY 1""")
def combined_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals over two ledgers taken together."""
    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("provider"), F.get_json_object("props", "$.k").cast("long").alias("request_count"))
    searches = table(spark, sf_dir, "discovery_exa").groupBy("provider", "request_id").agg(F.count("*").alias("request_count")).drop("request_id")
    return ledger.combined(events, searches).groupBy("provider").agg(F.count("*").alias("n_events"), F.sum("request_count").alias("request_count"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS DOUBLE) AS credits FROM events")
def reported_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credits from payloads that report them on one of several paths."""
    k = F.get_json_object("props", "$.k")
    nested = F.concat(F.lit('{"credits_consumed": null, "usage": {"credits_used": '), k, F.lit("}}"))
    payload = F.when(F.col("event_type") == "error", nested).otherwise(F.concat(F.lit('{"credits_used": '), k, F.lit("}")))
    return table(spark, sf_dir, "events").select("event_id", contacts.reported_credits(F.parse_json(payload)).alias("credits"))


_MAIL = """CASE WHEN regexp_full_match(lower(trim(work_email)), '[^@\\s]+@[^@\\s.]+(\\.[^@\\s.]+)+') AND split_part(lower(trim(work_email)), '@', -1) NOT IN
 ('aol.com','gmail.com','googlemail.com','hotmail.com','icloud.com','live.com','me.com','msn.com','outlook.com','proton.me','protonmail.com','yahoo.com','ymail.com') THEN lower(trim(work_email)) END"""


@query(f"""
WITH l AS (SELECT contact_id, arg_max(struct_pack(m := {_MAIL}), (observed_at, coalesce({_MAIL}, ''))).m AS mail FROM contact_records GROUP BY 1)
SELECT contact_id, mail AS work_email, CASE WHEN mail IS NOT NULL THEN 'clay' END AS email_source FROM l""")
def enriched_contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each contact with the address of the last result of its enrichment; the records stand for the results."""
    rows = table(spark, sf_dir, "contact_records").select("contact_id", "work_email", "observed_at")
    result = F.struct(F.col("work_email").alias("Work Email"))
    items = rows.select(F.col("observed_at").alias("position"), F.to_json(F.struct(F.col("contact_id").alias("id"), result.alias("result")), {"ignoreNullFields": "false"}).alias("item"))
    asked = rows.select("contact_id", F.lit(None).cast("string").alias("work_email"), F.lit(None).cast("string").alias("email_source")).distinct()
    return contacts.enriched(asked, items)


@query("""SELECT DISTINCT record_id, sha256('{"meta":' || replace(replace(raw_metadata, ': ', ':'), ', ', ',') || ',"record_id":"' || record_id || '"}') AS digest FROM discovery_exa""")
def stable_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A digest of each record that times of retrieval do not change."""
    whole = F.concat(F.lit('{"record_id": "'), "record_id", F.lit('", "meta": '), F.regexp_replace("raw_metadata", r"^\{", '{"retrieved_at": 1, '), F.lit(', "updated_at": "now"}'))
    rows = table(spark, sf_dir, "discovery_exa").select("record_id", whole.alias("whole")).distinct()
    return rows.select("record_id", F.sha2(values.canonical_text(F.col("whole"), ("created_at", "updated_at", "retrieved_at", "recorded_at")), 256).alias("digest")).distinct()


@query("SELECT doc_id, coalesce(strlen(text) > 2000, false) AS too_large, CASE WHEN strlen(text) <= 2000 THEN length(text) END AS n_left FROM documents")
def bodies_within_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = within_size(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", most=2000)
    return rows.select("doc_id", "too_large", F.length("text").cast("long").alias("n_left"))


@query("SELECT " + ", ".join(f"count(*) FILTER (final_decision = '{d}') AS {d}" for d in ranking.DECISIONS) + f" FROM ({_LATEST})")
def decision_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calibration.decision_counts(_latest(spark, sf_dir, "final_decision"), "final_decision", ranking.DECISIONS)


@query("""
WITH s AS (SELECT DISTINCT company_id, snapshot_id, status, domain FROM company_records),
l AS (SELECT *, CASE status WHEN 'active' THEN 0 ELSE 1 END AS r, lag(CASE status WHEN 'active' THEN 0 ELSE 1 END) OVER w AS r0, lag(domain) OVER w AS d0, row_number() OVER w AS n FROM s WINDOW w AS (PARTITION BY company_id ORDER BY snapshot_id))
SELECT company_id, snapshot_id FROM l WHERE n > 1 AND (r < r0 OR domain IS DISTINCT FROM d0)""")
def broken_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots that fall back behind the one before, or have another identity."""
    rows = table(spark, sf_dir, "company_records").select("company_id", "snapshot_id", "status", "domain").distinct()
    rank = F.when(F.col("status") == "active", 0).otherwise(1)
    return ledger.regressions(rows, ["company_id"], ["snapshot_id"], rank, constant=["domain"]).select("company_id", "snapshot_id")


@query("""
WITH l AS (SELECT contact_id, company_id, decision_rank, decision_reason, full_name FROM contact_records
  QUALIFY row_number() OVER (PARTITION BY contact_id ORDER BY observed_at DESC NULLS LAST, company_id NULLS LAST, decision_rank NULLS LAST, decision_reason, full_name NULLS LAST) = 1),
a AS (SELECT DISTINCT company_id FROM (SELECT * FROM company_records QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY snapshot_id DESC) = 1) WHERE final_decision = 'accepted'),
k AS (SELECT *, CASE split_part(decision_reason, ':', -1) WHEN 'estimating' THEN 0 WHEN 'inside_sales' THEN 1 WHEN 'operations' THEN 2 WHEN 'sales' THEN 3 WHEN 'commercial' THEN 4
  WHEN 'branch' THEN 5 WHEN 'regional' THEN 6 ELSE 7 END AS rel, nullif(trim(regexp_replace(lower(full_name), '[\\s\\x{a0}]+', ' ', 'g')), '') AS nm FROM l JOIN a USING (company_id) WHERE decision_rank IN (1, 2))
SELECT company_id, contact_id FROM k QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY decision_rank, rel, nm NULLS LAST, contact_id) <= 2""")
def two_of_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two leading contacts of ranks 1 and 2 of every accepted company."""
    rows = table(spark, sf_dir, "contact_records").select("contact_id", "company_id", "decision_rank", "decision_reason", "full_name", "observed_at")
    tie = [F.col(c).asc_nulls_last() for c in ("company_id", "decision_rank", "decision_reason", "full_name")]
    latest = latest_by(rows, ["contact_id"], F.col("observed_at"), tie)
    accepted = _latest(spark, sf_dir, "final_decision").filter(F.col("final_decision") == "accepted").select("company_id")
    return contacts.leading_of(latest, accepted).select("company_id", "contact_id")
