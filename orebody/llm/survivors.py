"""One surviving record per duplicate group: truth discovery, and survival by a stated total order."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orebody.session import cut_lineage

# Claims of one field of an entity that a task holds, and sources whose reliabilities are broadcast.
CLAIMS_TOGETHER, SOURCES_TOGETHER = 1_000_000, 500_000
_WHITE = r"^[\s\u0085\p{Z}]+|[\s\u0085\p{Z}]+\z"


def trimmed(value: Column) -> Column:
    return F.regexp_replace(value, _WHITE, "")


def filled(entries: Column, fold: bool = False) -> Column:
    """How many distinct entries of an array are neither null nor blank; 0 for a null array."""
    clean = F.transform(entries, lambda x: F.lower(trimmed(x)) if fold else trimmed(x))
    return F.coalesce(F.size(F.array_distinct(F.filter(clean, lambda x: x.isNotNull() & (x != "")))), F.lit(0))


def instant(text: Column) -> Column:
    """ISO-8601 text with any offset as an instant; null where it is none."""
    return text.try_cast("timestamp")


@dataclass(frozen=True)
class Survival:
    """How good a row's value of a field is (null: not usable); the greatest measure survives."""

    measure: Column


def survive(df: DataFrame, group: str, row_id: str, updated: Column, fields: Mapping[str, Survival], least_rows: int = 2) -> DataFrame:
    """(group, field_name, row_id): per field the row whose value survives, for groups of at least ``least_rows``
    (1 or 2) distinct row ids.

    The order is measure, then ``updated`` (null is earliest), then row_id, all descending: a total one. Each field is a
    ``max`` over a struct, so a hot group is combined before the shuffle and never gathered; one shuffle serves all
    fields. Rows with a null group or row_id are left out, a field without a usable value has no row, repeated rows
    change nothing, an empty table gives none; extra columns are not read.
    """
    rows = df.select(
        F.col(f"`{group}`").alias("_g"),
        F.col(f"`{row_id}`").alias("_r"),
        *[F.when(f.measure.isNotNull(), F.struct(f.measure.alias("m"), updated.alias("u"), F.col(f"`{row_id}`").alias("r"))).alias(f"_f{k}") for k, f in enumerate(fields.values())],
    ).filter(F.col("_g").isNotNull() & F.col("_r").isNotNull())
    best = rows.groupBy("_g").agg(F.min("_r").alias("_lo"), F.max("_r").alias("_hi"), *[F.max(f"_f{k}").alias(f"_f{k}") for k in range(len(fields))])
    if least_rows > 1:
        best = best.filter(F.col("_lo") != F.col("_hi"))
    picks = F.array(*[F.struct(F.lit(name).alias("field_name"), F.col(f"_f{k}.r").alias("r")) for k, name in enumerate(fields)])
    out = best.select(F.col("_g").alias(group), F.explode(F.filter(picks, lambda x: x["r"].isNotNull())).alias("p"))
    return out.select(group, "p.field_name", F.col("p.r").alias(row_id))


def discover_truth(claims: DataFrame, prior: float = 0.8, prior_weight: float = 4.0, tolerance: float = 1e-3, rounds: int = 200) -> DataFrame:
    """(entity, field, value, support, confidence): the value of each entity's field that its sources support most.

    ``claims``: entity, field, value, source. Rounds alternate: a value's support is the sum of the log-odds of its
    sources' reliabilities, its confidence is its share of the exponentials of the supports of the same field; a source's
    reliability is the mean confidence of its claims, drawn to ``prior`` with the weight of ``prior_weight`` claims. They
    end when no reliability moves by ``tolerance``; if they do not within ``rounds``, that is an error. A support tie goes
    to the greater value.

    Claims repeated by a source count once; null entities, values or sources claim nothing. A round exchanges the claims
    once, by entity and field, and a sum per source and task; where a field of an entity has more than CLAIMS_TOGETHER
    claims, it exchanges sums by value instead, so that no task holds them. Reliabilities are broadcast up to
    SOURCES_TOGETHER sources, joined beyond it. Each round is cut from its lineage.
    """
    votes = cut_lineage(claims.select("entity", "field", F.col("value").cast("string").alias("value"), "source").dropna().distinct())
    most = votes.groupBy("entity", "field").count().agg(F.max("count").alias("most")).first().most or 0
    weigh = _within_fields if most <= CLAIMS_TOGETHER else _over_values
    trust = cut_lineage(votes.select("source").distinct().withColumn("trust", F.lit(prior)))
    known = F.broadcast if trust.count() <= SOURCES_TOGETHER else lambda df: df
    for _ in range(rounds):
        weighed = weigh(votes.join(known(trust), "source").withColumn("odds", F.ln(F.col("trust") / (1 - F.col("trust")))).drop("trust"))
        now = (F.sum("confidence") + prior * prior_weight) / (F.count("*") + prior_weight)
        moved = cut_lineage(trust.join(weighed.groupBy("source").agg(now.alias("now")), "source"))
        trust = moved.select("source", F.least(F.lit(0.999), F.greatest(F.lit(0.001), "now")).alias("trust"))
        if (moved.agg(F.max(F.abs(F.col("now") - F.col("trust"))).alias("d")).first().d or 0.0) < tolerance:
            best = F.max(F.struct("support", "value", "confidence")).alias("b")
            return weighed.groupBy("entity", "field").agg(best).select("entity", "field", "b.value", "b.support", "b.confidence")
    raise RuntimeError(f"reliabilities still move after {rounds} rounds")


def _within_fields(votes: DataFrame) -> DataFrame:
    """votes with support and confidence of their values, by windows over one exchange of the votes."""
    value, field = Window.partitionBy("entity", "field", "value"), Window.partitionBy("entity", "field")
    rows = votes.repartition("entity", "field").withColumns({"support": F.sum("odds").over(value), "_n": F.count(F.lit(1)).over(value)})
    rows = rows.withColumn("_scaled", F.exp(F.col("support") - F.max("support").over(field)))
    return rows.withColumn("confidence", F.col("_scaled") / F.sum(F.col("_scaled") / F.col("_n")).over(field)).drop("odds", "_n", "_scaled")


def _over_values(votes: DataFrame) -> DataFrame:
    """The same by sums that are combined before they are exchanged, and a join of the votes with their values."""
    field = Window.partitionBy("entity", "field")
    support = votes.groupBy("entity", "field", "value").agg(F.sum("odds").alias("support"))
    scaled = support.withColumn("_scaled", F.exp(F.col("support") - F.max("support").over(field)))
    values = scaled.withColumn("confidence", F.col("_scaled") / F.sum("_scaled").over(field)).drop("_scaled")
    return votes.drop("odds").join(values, ["entity", "field", "value"])
