"""Sinks that never show half a result: written beside the target, then put in its place."""

from __future__ import annotations

import uuid
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orebody.functions.values import canonical_text
from orebody.sources.ledger_jsonl import RECORD_BYTES

# Rows of a file of JSON lines, so that files stay small enough to be read as one record each.
FILE_ROWS = 20_000


def _swap(spark: SparkSession, staged: str, target: str) -> None:
    jvm = spark.sparkContext._jvm
    new, old = jvm.org.apache.hadoop.fs.Path(staged), jvm.org.apache.hadoop.fs.Path(target)
    files = new.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    aside = jvm.org.apache.hadoop.fs.Path(f"{target}.old-{uuid.uuid4().hex}")
    had = files.exists(old)
    if had and not files.rename(old, aside) or not files.rename(new, old):
        raise OSError(f"could not put {staged} in place of {target}")
    if had:
        files.delete(aside, True)


def _drop(spark: SparkSession, folder: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _endless(value: Column, kind: T.DataType) -> Column:
    """Whether a value holds a floating number that is none, or infinite, at any depth."""
    if isinstance(kind, T.DoubleType | T.FloatType):
        return F.coalesce(F.isnan(value) | (F.abs(value) == float("inf")), F.lit(False))
    if isinstance(kind, T.StructType):
        return reduce(or_, [_endless(value[f.name], f.dataType) for f in kind], F.lit(False))
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.exists(value, lambda x: _endless(x, kind.elementType)), F.lit(False))
    if isinstance(kind, T.MapType):
        return F.coalesce(F.exists(F.map_values(value), lambda x: _endless(x, kind.valueType)), F.lit(False))
    return F.lit(False)


def canonical_lines(df: DataFrame, record_bytes: int = RECORD_BYTES) -> DataFrame:
    """The rows as JSON: keys sorted at every level, nulls kept, characters as they are. Numbers that are none, and records
    over the bound, are errors."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    line = canonical_text(F.to_json(row, {"ignoreNullFields": "false"}))
    endless = F.when(_endless(row, df.schema), F.lit("a number that is none"))
    checked = df.select(line.alias("value"), endless.alias("_wrong")).withColumn("_wrong", F.coalesce("_wrong", F.when(F.octet_length("value") > record_bytes, F.lit("a record over its bound"))))
    return checked.select(F.when(F.col("_wrong").isNull(), F.col("value")).otherwise(F.raise_error(F.col("_wrong"))).alias("value"))


def replace_json(df: DataFrame, target: str, record_bytes: int = RECORD_BYTES, file_rows: int = FILE_ROWS) -> None:
    """A folder of JSON lines in their canonical form, in files of ``file_rows`` at most, replaced as a whole; nothing is
    replaced when a row is wrong."""
    staged = f"{target}.new-{uuid.uuid4().hex}"
    try:
        canonical_lines(df, record_bytes).write.option("maxRecordsPerFile", file_rows).text(staged)
    except Exception:
        _drop(df.sparkSession, staged)
        raise
    _swap(df.sparkSession, staged, target)


def replace_csv(df: DataFrame, target: str, order: list | None = None) -> None:
    """A folder of CSV files with a header each, RFC 4180 quoting and LF; in ``order`` over the files' names when given."""
    staged = f"{target}.new-{uuid.uuid4().hex}"
    rows = df.orderBy(*order) if order else df
    rows.write.csv(staged, header=True, lineSep="\n", escape='"', quote='"', emptyValue="")
    _swap(df.sparkSession, staged, target)


def append_json(df: DataFrame, target: str, file_rows: int = FILE_ROWS) -> None:
    """More files in a folder of JSON lines; the committer makes all of them visible, or none."""
    df.write.mode("append").option("ignoreNullFields", "false").option("maxRecordsPerFile", file_rows).json(target)
