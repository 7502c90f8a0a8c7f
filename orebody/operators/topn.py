"""Ordered picks per group: latest version of a key and the first N of a group; places of a whole table in one order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orebody.session import cut_lineage

_RANK = "__orebody_rank"
_PART = "__orebody_part"


def first_n(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank_as: str | None = None) -> DataFrame:
    """The first n rows of every group by a total order.

    A ``row_number`` window with a rank filter: Catalyst plans ``WindowGroupLimit`` before and after the exchange, so a
    task sends at most n rows of a group, however large the group is. Rows with a null group column form one group of
    their own; ties beyond ``order`` are decided by whichever row comes first, so pass a total order. An empty input
    gives an empty result; extra columns pass through; a column named like the internal rank is not allowed.
    """
    if n < 1:
        raise ValueError("n must be positive")
    name = rank_as or _RANK
    if name in df.columns:
        raise ValueError(f"column {name} exists already")
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col(name) <= n)
    return ranked if rank_as else ranked.drop(name)


def latest_by(df: DataFrame, key: Sequence[str], at: Column, tie: Sequence[Column] = ()) -> DataFrame:
    """The row of every key with the greatest ``at`` (null counts as earliest), then by ``tie``."""
    return first_n(df, key, [at.desc_nulls_last(), *tie], 1)


def numbered(df: DataFrame, order: Sequence[Column], place_as: str) -> DataFrame:
    """All rows with their place, from 1 and without gaps, in one order of the whole table.

    A range-partitioned sort, materialised once; a row's place is its position in its partition after the rows of the
    partitions before, so no task holds more than its range. Only a count per partition goes to the driver. Rows equal in
    ``order`` get places in no stated order, so pass a total order; a column already named ``place_as`` is refused.
    """
    if place_as in df.columns:
        raise ValueError(f"column {place_as} exists already")
    within, part = F.monotonically_increasing_id(), F.spark_partition_id()
    rows = cut_lineage(df.orderBy(*order)).withColumns({_PART: part, place_as: within})
    sizes = sorted((r[_PART], r.n) for r in rows.groupBy(_PART).agg(F.count("*").alias("n")).collect())
    before, offsets = 0, []
    for k, n in sizes:
        offsets.append((k, before - (k << 33) + 1))  # the ids of a partition begin at its number times 2 to the 33
        before += n
    starts = df.sparkSession.createDataFrame(offsets, f"{_PART} int, {_RANK} long")
    return rows.join(F.broadcast(starts), _PART).withColumn(place_as, F.col(place_as) + F.col(_RANK)).select(*df.columns, place_as)
