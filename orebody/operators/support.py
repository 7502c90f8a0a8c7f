"""Which propositions a company's evidence states, clause by clause, and which it denies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebody.functions.text import clauses
from orebody.operators.vocabulary import DENIAL, PREDICATES

def clause_flags(clause: Column, facts: Mapping[str, Sequence[Sequence[str]]] = PREDICATES) -> Column:
    """An array of (fact, denied), one for each fact that the lower-cased clause speaks of."""
    denied = clause.rlike(f"(?U){DENIAL}")
    spoken = []
    for fact, groups in facts.items():
        speaks = F.lit(True)
        for patterns in groups:
            speaks = speaks & clause.rlike(f"(?U){'|'.join(patterns)}")
        spoken.append(F.when(speaks, F.struct(F.lit(fact).alias("fact"), denied.alias("denied"))))
    return F.array_compact(F.array(*spoken))


def support(items: DataFrame, owner: str, text: str, facts: Mapping[str, Sequence[Sequence[str]]] = PREDICATES) -> DataFrame:
    """(owner, fact, stated, denied): how many clauses state or deny each fact; facts that no clause speaks of have no row.

    All of it runs in the JVM: clauses are split and tested where the text is read, counts are combined before the one
    shuffle by (owner, fact), so an owner that holds most texts is not gathered. Null texts and owners say nothing; every
    row counts, so pass distinct items.
    """
    said = items.filter(F.col(owner).isNotNull()).select(owner, F.explode(clauses(F.lower(text))).alias("_clause"))
    flags = said.select(owner, F.explode(clause_flags(F.col("_clause"), facts)).alias("_f"))
    return flags.groupBy(owner, F.col("_f.fact").alias("fact")).agg(F.count_if(~F.col("_f.denied")).alias("stated"), F.count_if("_f.denied").alias("denied"))
