"""Append-only ledgers: totals, admission against a ceiling, cursors and progress."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orebody.functions.values import sum_if_all_known
from orebody.session import cut_lineage

# Rows of a group up to which one task sums it from its first row to its last; larger ones are summed piece by piece.
WHOLE_GROUP = 2_000_000


def running_sum(df: DataFrame, group: Sequence[str], order: Sequence[str], value: Column, name: str) -> DataFrame:
    """df with the sum of ``value`` over the rows of the group up to this one; null values add nothing, and rows before the
    first known value have null.

    A window by group, which streams over the sorted rows; groups of more than WHOLE_GROUP rows are sorted into ranges by
    group and order, summed within each range, and raised by the sums of the ranges before, so that no task reads more of
    them than a range. Rows equal in ``order`` are taken as they come, so pass a total order.
    """
    upto = lambda *keys: Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = df.withColumn(name, value)
    large = cut_lineage(df.groupBy(*group).count().filter(F.col("count") > WHOLE_GROUP).select(*group))  # few by definition
    if large.isEmpty():
        return rows.withColumn(name, F.sum(name).over(upto(*group)))
    same = lambda other: [rows[g].eqNullSafe(other[g]) for g in group]
    whole = rows.join(large, same(large), "left_anti").withColumn(name, F.sum(name).over(upto(*group)))
    ranged = cut_lineage(rows.join(large, same(large), "left_semi").repartitionByRange(*group, *order).withColumn("_range", F.spark_partition_id()))
    sums = ranged.groupBy(*group, "_range").agg(F.sum(name).alias("_sum"))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.withColumn("_carried", F.sum("_sum").over(before)).select(*[F.col(g).alias(f"_{g}") for g in group], F.col("_range").alias("_at"), "_carried")
    within = ranged.withColumn(name, F.sum(name).over(upto(*group, "_range")))
    joined = within.join(carried, [within["_range"] == carried["_at"], *[within[g].eqNullSafe(carried[f"_{g}"]) for g in group]], "left")
    total = F.when(F.col(name).isNotNull() | F.col("_carried").isNotNull(), F.coalesce(name, F.lit(0)) + F.coalesce("_carried", F.lit(0)))
    return whole.unionByName(joined.withColumn(name, total).select(*whole.columns))


def usage_totals(events: DataFrame, by: str, counts: Sequence[str], costs: Sequence[str], digits: int = 10) -> DataFrame:
    """Sums per value of ``by`` and over all (is_total): counts as they are, costs null as soon as one is unknown."""
    sums = [F.sum(c).alias(c) for c in counts] + [F.round(sum_if_all_known(F.col(c)), digits).alias(c) for c in costs]
    return events.groupingSets([[F.col(by)], []], F.col(by)).agg(F.grouping(by).alias("is_total"), *sums)


def admitted_prefix(requests: DataFrame, group: Sequence[str], order: Sequence[str], amount: str, ceiling: Column, slack: float = 1e-12) -> DataFrame:
    """Requests of each group, in order, as long as what is committed with them stays within the ceiling; the first that
    does not fit stops the rest. A null ceiling admits all; an unknown amount stops.

    Two running sums, of the amounts and of the requests that did not fit; a hot group is spread.
    """
    summed = running_sum(requests.withColumn("_ceiling", ceiling), group, order, F.col(amount), "_committed")
    fits = F.col("_ceiling").isNull() | F.coalesce(F.col(amount).isNotNull() & (F.col("_committed") <= F.col("_ceiling") + slack), F.lit(False))
    stopped = running_sum(summed.withColumn("_fits", fits), group, order, F.when(F.col("_fits"), 0).otherwise(1), "_stopped")
    return stopped.withColumn("admitted", F.col("_stopped") == 0).drop("_fits", "_ceiling", "_committed", "_stopped")


def call_cursor(events: DataFrame, group: Sequence[str], order: Sequence[str], counted: Column) -> DataFrame:
    """The running number of counted events per group, this one included; a hot group is spread."""
    return running_sum(events, group, order, F.when(counted, 1).otherwise(0), "cursor")


def regressions(states: DataFrame, key: Sequence[str], order: Sequence[str], rank: Column, constant: Sequence[str] = ()) -> DataFrame:
    """Rows whose rank is lower than that of the row before them under the same key, or that differ from it in a column
    that must stay as it is. The first row of a key has none before it."""
    before = Window.partitionBy(*key).orderBy(*order)
    kept = F.struct(*constant) if constant else F.lit(0)
    rows = states.withColumn("rank_now", rank).withColumns({"rank_before": F.lag("rank_now").over(before), "_kept": kept, "_first": F.row_number().over(before) == 1})
    rows = rows.withColumn("_before", F.lag("_kept").over(before))
    changed = ~F.col("_first") & ~F.col("_kept").eqNullSafe(F.col("_before"))
    return rows.filter((F.col("rank_now") < F.col("rank_before")) | changed).drop("_kept", "_before", "_first")


def allocate(total: Column, slots: Column, slot: Column) -> Column:
    """The share of slot number ``slot`` (from 0) when a total is split evenly and the first slots take the rest."""
    return F.floor(total / slots) + F.when(slot < total % slots, 1).otherwise(0)


def exactly_once(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Keys expected but not found, found but not expected, or found more than once: (key, n_expected, n_found)."""
    a = expected.groupBy(key).agg(F.count("*").alias("n_expected"))
    b = found.groupBy(key).agg(F.count("*").alias("n_found"))
    both = a.join(b, key, "full_outer").na.fill(0, ["n_expected", "n_found"])
    return both.filter((F.col("n_found") != 1) | (F.col("n_expected") == 0))


def usage_problem(counts: Sequence[str] = ("request_count", "input_tokens", "output_tokens"), costs: Sequence[str] = ("estimated_cost_usd", "exact_cost_usd")) -> Column:
    """The first thing wrong with a usage event, null for none: blank provider or operation, a count that is missing or
    negative, a cost that is negative or no number, metadata that is no JSON object, no time of recording."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) == ""
    checks = [(c, blank(c)) for c in ("provider", "operation")]
    checks += [(c, F.coalesce(F.col(c) < 0, F.lit(True))) for c in counts]
    endless = [float("inf"), float("nan")]
    checks += [(c, F.coalesce((F.col(c) < 0) | F.col(c).cast("double").isin(*endless), F.lit(False))) for c in costs]
    checks += [("metadata", ~F.coalesce(F.schema_of_variant(F.try_parse_json("metadata")).startswith("OBJECT"), F.lit(False))), ("recorded_at", blank("recorded_at"))]
    return F.coalesce(*[F.when(wrong, name) for name, wrong in checks])


def checked(events: DataFrame, problem: Column | None = None) -> DataFrame:
    """events, or an error when one that has a problem is read."""
    wrong = usage_problem() if problem is None else problem
    return events.withColumn("provider", F.when(wrong.isNull(), F.col("provider")).otherwise(F.raise_error(F.concat(F.lit("bad usage event: "), wrong)).cast("string")))


def combined(*ledgers: DataFrame) -> DataFrame:
    """All events of several ledgers, repeated ones as often as they stand in any."""
    out = ledgers[0]
    for more in ledgers[1:]:
        out = out.unionByName(more)
    return out
