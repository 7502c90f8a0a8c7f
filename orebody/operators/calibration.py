"""Agreement of two classifications, and summaries of a metric per class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebody.functions.values import round_exact


def confusion(df: DataFrame, label: str, decision: str, labels: Sequence[str], decisions: Sequence[str]) -> DataFrame:
    """One row per label, one count per decision, zeros included; rows of other labels or decisions are not counted."""
    counted = df.groupBy(label).agg(*[F.count_if(F.col(decision) == d).alias(d) for d in decisions])
    spine = df.sparkSession.createDataFrame([(x,) for x in labels], f"`{label}` string")
    return spine.join(counted, label, "left").na.fill(0, list(decisions))


def metric_summary(df: DataFrame, label: str, metric: str, digits: int) -> DataFrame:
    """(label, n, low, high, mean) over the known values of the metric, rounded half-even on their exact binary value, for
    labels that have rows."""
    low, high, mean = (round_exact(f(metric), digits) for f in (F.min, F.max, F.avg))
    return df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(metric).alias("n"), low.alias("low"), high.alias("high"), mean.alias("mean"))


def decision_counts(df: DataFrame, decision: str, decisions: Sequence[str]) -> DataFrame:
    """One row with a count per decision, zeros included."""
    return df.agg(*[F.count_if(F.col(decision) == d).alias(d) for d in decisions])


def disagreements(df: DataFrame, label: str, decision: str, key: str, kinds: dict[str, Sequence[tuple[str, str]]]) -> DataFrame:
    """(key, kind) of every row whose label and decision form one of the pairs of a kind."""
    pair = F.struct(F.col(label).alias("l"), F.col(decision).alias("d"))
    kind = F.coalesce(*[F.when(pair.isin(*[F.struct(F.lit(a).alias("l"), F.lit(b).alias("d")) for a, b in pairs]), F.lit(name)) for name, pairs in kinds.items()])
    return df.withColumn("kind", kind).filter(F.col("kind").isNotNull()).select(key, "kind").distinct()
