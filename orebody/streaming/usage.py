"""A usage ledger as a stream: dispatches counted once, totals kept up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT = "dispatch_id string, provider string, request_count bigint, cost_usd double, recorded_at timestamp"


def usage_stream(spark: SparkSession, path: str, files_per_trigger: int = 64) -> DataFrame:
    """New JSON-lines files of a folder as they arrive."""
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", files_per_trigger).json(path)


def once(events: DataFrame, late: str = "1 day") -> DataFrame:
    """Each dispatch once; its id is remembered for ``late``, so the state stays bounded."""
    return events.withWatermark("recorded_at", late).dropDuplicatesWithinWatermark(["dispatch_id"])


def totals(events: DataFrame, window: str = "1 hour") -> DataFrame:
    """Requests and cost per provider and window of recorded_at; cost is null as soon as one event's is unknown."""
    known = F.when(F.count("cost_usd") == F.count(F.lit(1)), F.sum("cost_usd"))
    return events.groupBy(F.window("recorded_at", window).alias("w"), "provider").agg(F.sum("request_count").alias("request_count"), known.alias("cost_usd"))
