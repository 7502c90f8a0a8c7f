"""The N leading rows of every group, and the latest version of a key that may come before them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PLACE = "__orebody_place"


def leading(df: DataFrame, group: Sequence[str], score: Sequence[Column], identifier: Sequence[Column], n: int, place_as: str | None = None) -> DataFrame:
    """The first n rows of every group, by ``score`` and then by ``identifier``, which together should order totally.

    A row_number window under a filter on it: the optimiser's group limit cuts each task's rows of a group to n before
    the exchange and again behind it, so a group of any size sends n rows a task and none is gathered.

    Null group columns form a group of their own, rows equal in all of the order are taken as they come, fewer rows than
    n are all kept, an empty table gives none. Other columns pass through; one named like ``place_as`` is refused.
    """
    if n < 1:
        raise ValueError("n must be positive")
    name = place_as or _PLACE
    if name in df.columns:
        raise ValueError(f"column {name} exists already")
    ordered = Window.partitionBy(*[F.col(f"`{g}`") for g in group]).orderBy(*score, *identifier)
    kept = df.withColumn(name, F.row_number().over(ordered)).filter(F.col(name) <= n)
    return kept if place_as else kept.drop(name)


def versions(df: DataFrame, key: Sequence[str], at: Column, tie: Sequence[Column]) -> DataFrame:
    """Of each key the row latest by ``at`` (null is earliest), then first by ``tie``; planned like ``leading``."""
    return leading(df, key, [at.desc_nulls_last()], tie, 1)
