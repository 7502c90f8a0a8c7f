"""Whether cited evidence supports a fact: clauses are read for what they say a company does, has or lacks.

A clause is read once per fact into mentions: places of the relations ("sell", "serves") and of the concepts they act on.
Each relation is then known to be denied or not in one pass from left to right, as a denial carries over to the next
relation only through a coordination ("do not sell, stock or supply"). Values are compared with what stands beside the
concept. Clauses are split, filtered and their verdicts combined in the JVM; only clauses that hold a word of the fact
cross to Python, in Arrow batches.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebody.operators import vocabulary as v

_I = re.IGNORECASE
_DENIAL = re.compile(v.DENIAL, _I)
_CONCEPT_DENIED = [re.compile(p, _I) for p in v.CONCEPT_DENIED]
_VERB_DENIED = re.compile(v.VERB_DENIED, _I)
_RELATION_DENIED = [re.compile(p, _I) for p in v.RELATION_DENIED]
_COORDINATION = re.compile(v.COORDINATION, _I)
_OBJECT_BRIDGE = re.compile(v.OBJECT_BRIDGE, _I)
_VALUE_BRIDGE = re.compile(v.VALUE_BRIDGE, _I)
_ASCII_WORD = re.compile(r"[A-Za-z0-9']")
_WORD = re.compile(r"\b[\w']+\b")
VETOED = "pvf_relevant"
NEARBY = 4


class Mention(NamedTuple):
    start: int
    end: int


@lru_cache(maxsize=10_000)
def phrase(text: str) -> re.Pattern[str]:
    """A phrase as whole words, its spaces of any length."""
    return re.compile(r"(?<!\w)" + r"\s+".join(map(re.escape, text.split(" "))) + r"(?!\w)", _I)


def mentions(clause: str, phrases: Sequence[str]) -> list[Mention]:
    """Where the phrases stand, by where they begin."""
    return sorted((Mention(*m.span()) for p in phrases for m in phrase(p).finditer(clause)), key=lambda m: m.start)


class Reading:
    """One clause read for one fact."""

    def __init__(self, key: str, clause: str) -> None:
        self.clause = clause
        self.concepts = mentions(clause, v.CONCEPTS[key])
        self.relations = mentions(clause, v.RELATIONS.get(key, ()))
        ends = [r.end for r in self.relations]
        self.objects: dict[int, list[Mention]] = {}
        for c in self.concepts:
            nearest = bisect_right(ends, c.start) - 1  # the last relation that ends before the concept begins
            if nearest >= 0 and _OBJECT_BRIDGE.fullmatch(clause, ends[nearest], c.start):
                self.objects.setdefault(nearest, []).append(c)
        self.denied: list[bool] = []
        for n, r in enumerate(self.relations):
            self.denied.append(self._led_by(_RELATION_DENIED, r) or bool(n) and self.denied[-1] and self._coordinated(n))

    def _led_by(self, patterns: Sequence[re.Pattern[str]], what: Mention) -> bool:
        before = self.clause[: what.start]
        return any(p.search(before) for p in patterns)

    def _coordinated(self, n: int) -> bool:
        """Whether relation n is joined to the one before it, directly or by way of that one's object."""
        start = self.relations[n].start
        ends = [self.relations[n - 1].end, *(c.end for c in self.objects.get(n - 1, ()) if c.end <= start)]
        return any(_COORDINATION.fullmatch(self.clause, e, start) for e in ends)

    def acts(self, denied: bool) -> bool:
        """Whether some relation with an object is denied, or is not."""
        return any(self.denied[n] == denied for n in self.objects)

    def has(self, denied: bool, by_verb: bool = False) -> bool:
        """Whether some concept is denied, or is not, by what leads to it."""
        patterns = [*_CONCEPT_DENIED, _VERB_DENIED] if by_verb else _CONCEPT_DENIED
        return any(self._led_by(patterns, c) == denied for c in self.concepts)

    def counts(self, value: int | float) -> bool:
        """Whether the number is tied to a concept: no word between before it, only binding words after it."""
        number = re.compile(rf"(?<![\w.]){re.escape(format(value, 'g'))}(?![\w.])")
        for m in number.finditer(self.clause):
            for c in self.concepts:
                if m.end() <= c.start and not _ASCII_WORD.search(self.clause, m.end(), c.start):
                    return True
                if c.end <= m.start() and _VALUE_BRIDGE.fullmatch(self.clause, c.end, m.start()):
                    return True
        return False


def denied_nearby(clause: str, terms: Sequence[str]) -> bool:
    """Whether a denial stands within NEARBY words of one of the terms, on either side."""
    places = [Mention(*m.span()) for t in terms for m in re.finditer(rf"\b{re.escape(t)}\b", clause, _I)]
    for d in _DENIAL.finditer(clause):
        for p in places:
            first, second = sorted((Mention(*d.span()), p))
            if len(_WORD.findall(clause[first.end : second.start])) <= NEARBY:
                return True
    return False


def _with_unit(key: str, number: str, clause: str) -> bool:
    bare = rf"(?<![\d.]){re.escape(number)}(?![\d.])"
    if key == "revenue_if_reliably_available":
        stated = rf"{v.REVENUE}\s*(?:of|:|was|is)?\s*{v.CURRENCY}{bare}|{v.CURRENCY}{bare}\s*(?:in\s+)?{v.REVENUE}"
        return re.search(stated, clause.replace(",", ""), _I) is not None
    units = "|".join(map(re.escape, v.UNITS.get(key, ())))
    return bool(units) and re.search(rf"{bare}\s+(?:{units})\b", clause, _I) is not None


def _stated(key: str, value: object, clause: str, reading: Reading) -> bool:
    if isinstance(value, bool):
        return True
    if isinstance(value, int | float):
        return _with_unit(key, str(value), clause) or reading.counts(value)
    if isinstance(value, str):
        return value.casefold() in clause
    return isinstance(value, list) and bool(value) and all(x.casefold() in clause for x in value)


def judge(key: str, value: object, clause: str) -> tuple[bool, bool]:
    """(supports, vetoes) of one folded clause; only a denied relevance can be vetoed."""
    if key not in v.CONCEPTS:
        return False, False
    reading = Reading(key, clause)
    if key == VETOED and isinstance(value, bool):
        if not value:
            return reading.acts(denied=True), reading.acts(denied=False)
        return (reading.acts(denied=False) if reading.relations else reading.has(denied=False, by_verb=True)), False
    if value is False:
        return (reading.acts(denied=True) if reading.relations else reading.has(denied=True)), False
    spoken = any(re.search(rf"\b{re.escape(t)}\b", clause, _I) for t in v.TERMS[key]) and not denied_nearby(clause, v.TERMS[key])
    spoken = spoken and all(any(re.search(p, clause, _I) for p in group) for group in v.PREDICATES[key])
    return spoken and _stated(key, value, clause, reading), False


@lru_cache(maxsize=10_000)
def _value(text: str) -> object:
    return json.loads(text)


def _worth_reading(key: Column, clause: Column) -> Column:
    """Whether a clause holds a concept or term of its fact at all; without one it can support nothing."""
    test = F.lit(False)
    for fact in v.FACT_KEYS:
        words = "|".join(w.replace(" ", r"\s+") for w in sorted({*v.CONCEPTS[fact], *v.TERMS[fact]}))
        test = F.when(key == fact, clause.rlike(f"(?iU)\\b(?:{words})")).otherwise(test)
    return test


def clauses_of(text: Column) -> Column:
    return F.split(text, f"(?iU){v.CLAUSE_END}")


def supported(facts: DataFrame, items: DataFrame) -> DataFrame:
    """facts with ``supported``: whether the items that a fact cites, of its own company, support its value.

    ``facts``: company_id, fact_key, value (JSON text), evidence_ids; ``items``: company_id, evidence_id, title, excerpt.
    An unknown value (null or JSON null) needs no support; a value without citations, with citations of items that are
    not there, or of a key that is none has none. A denied relevance is supported by a clause that denies it and vetoed by
    any cited clause that states it.

    Facts meet their items by an equi-join, so a company with very many items is spread by item; clauses are filtered
    before they reach Python and verdicts are combined before the last shuffle. Repeated facts stay, extra columns pass.
    """
    key = ["company_id", "fact_key", "value", "evidence_ids"]
    asked = facts.filter(F.col("value").isNotNull() & (F.col("value") != "null")).select(*key).distinct()
    cited = asked.withColumn("evidence_id", F.explode(F.array_distinct("evidence_ids")))
    known = items.select("company_id", "evidence_id", F.array_compact(F.array("title", "excerpt")).alias("_texts")).distinct()
    clause = cited.join(known, ["company_id", "evidence_id"]).select(*key, F.explode("_texts").alias("_text")).select(*key, F.explode(clauses_of(F.col("_text"))).alias("_clause"))
    clause = clause.filter(_worth_reading(F.col("fact_key"), F.col("_clause"))).distinct()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, values, texts = (batch.column(n).to_pylist() for n in ("fact_key", "value", "_clause"))
            verdicts = [judge(k, _value(x), t.casefold()) for k, x, t in zip(keys, values, texts)]
            columns = [pa.array([y[n] for y in verdicts], pa.bool_()) for n in (0, 1)]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in key), *columns], [*key, "supports", "vetoes"])

    kinds = ", ".join(f"{n} {facts.schema[n].dataType.simpleString()}" for n in key)
    verdict = clause.mapInArrow(read, f"{kinds}, supports boolean, vetoes boolean").groupBy(*key).agg(F.bool_or("supports").alias("_for"), F.bool_or("vetoes").alias("_against"))
    same = [facts[n].eqNullSafe(verdict[n]) for n in key]
    joined = facts.join(verdict, same, "left").select(facts["*"], "_for", "_against")
    unknown = F.col("value").isNull() | (F.col("value") == "null")
    return joined.withColumn("supported", unknown | (F.coalesce("_for", F.lit(False)) & ~F.coalesce("_against", F.lit(False)))).drop("_for", "_against")


def canonical(facts: DataFrame) -> DataFrame:
    """Facts with ``supported`` and confidence, where what is not supported becomes the unknown: null, 0, no citations."""
    kept = F.col("supported")
    return facts.withColumns({
        "value": F.when(kept, F.col("value")).otherwise("null"),
        "confidence": F.when(kept, F.col("confidence")).otherwise(0.0),
        "evidence_ids": F.when(kept, F.col("evidence_ids")).otherwise(F.array().cast("array<string>")),
    })
