"""Manual labels from a spreadsheet, checked before any of them is used."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REQUIRED = ("company_id", "manual_label")
LABELS = ("A", "B", "C")


def read_labels(spark: SparkSession, path: str, known: DataFrame, key: str = "company_id", most: int | None = None) -> DataFrame:
    """(company_id, manual_label, manual_notes), labels trimmed and in upper case.

    Fails on missing or repeated headers, rows of another length, text that is no UTF-8, blank, repeated, unknown or
    formula-like ids, labels other than A, B, C, and more than ``most`` rows.
    The checks are aggregates and one anti join; nothing is collected but their counts.
    """
    rows = spark.read.csv(path, header=True, multiLine=True, enforceSchema=False, mode="FAILFAST", escape='"', quote='"')
    header = [c.strip() for c in rows.columns]
    if len(set(header)) != len(header) or not set(REQUIRED) <= set(header):
        raise ValueError(f"labels need unique headers with {REQUIRED}: {header}")
    sheet = rows = rows.toDF(*header)
    notes = F.col("manual_notes") if "manual_notes" in header else F.lit(None).cast("string")
    rows = rows.select(F.trim(key).alias(key), F.upper(F.trim("manual_label")).alias("manual_label"), notes.alias("manual_notes"))
    whole = F.concat_ws("", *[F.col(f"`{c}`") for c in sheet.columns])
    torn = sheet.filter(F.contains(whole, F.lit("\ufffd"))).limit(1).count()
    bad = rows.agg(
        F.count("*").alias("n"),
        F.count_if(F.coalesce(F.col(key), F.lit("")) == "").alias("blank"),
        F.count_if(F.col(key).rlike(r"^[=+\-@]")).alias("formula"),
        F.count_if(~F.coalesce(F.col("manual_label").isin(*LABELS), F.lit(False))).alias("label"),
        (F.count(key) - F.count_distinct(key)).alias("repeated"),
    ).first()
    unknown = rows.join(known.select(key).distinct(), key, "left_anti").limit(1).count()
    problems = [name for name in ("blank", "formula", "label", "repeated") if bad[name]] + ["unknown"] * unknown + ["encoding"] * torn
    problems += ["rows"] * (most is not None and bad.n > most)
    if problems:
        raise ValueError(f"labels with problems: {', '.join(problems)}")
    return rows
