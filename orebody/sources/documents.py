"""Single documents: bounded JSON objects, the sheet of contacts read again, answers within their size, settings."""

from __future__ import annotations

import json
import os
import re
import shlex
from collections.abc import Mapping, Sequence
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT_BYTES = 16 * 1024 * 1024
BODY_BYTES = 2 * 1024 * 1024
_SETTING = re.compile(r"(?:export\s+)?([A-Za-z_][A-Za-z0-9_]*)\s*=\s*(.*)")


def _paths(spark: SparkSession, path: str):  # noqa: ANN202
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def read_document(spark: SparkSession, path: str, most: int = DOCUMENT_BYTES) -> dict[str, Any] | None:
    """The JSON object of one file; None if there is no file, an error if it is too large or holds anything else."""
    where, files = _paths(spark, path)
    if not files.exists(where):
        return None
    status = files.getFileStatus(where)
    if not status.isFile() or status.getLen() > most:
        raise ValueError(f"{path} is no file of at most {most} bytes")
    raw = spark.read.format("binaryFile").load(path).select("content").first().content
    try:
        document = json.loads(bytes(raw))
    except ValueError as e:
        raise ValueError(f"{path} is not JSON") from e
    if not isinstance(document, dict):
        raise ValueError(f"{path} holds no object")
    return document


def replace_document(spark: SparkSession, path: str, document: Mapping[str, Any]) -> None:
    """Write one JSON object beside its place, indented and with sorted keys, then put it there in one rename.

    Numbers that are none are refused before anything is written. Where a file is there already, a store that cannot
    rename over it has it removed just before: the new one is complete by then, under its own name.
    """
    text = json.dumps(document, indent=2, sort_keys=True, ensure_ascii=False, allow_nan=False) + "\n"
    target, files = _paths(spark, path)
    staged = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.new-{os.getpid()}")
    out = files.create(staged, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    local = target.toUri().getScheme() in (None, "file")
    if local:
        os.replace(staged.toUri().getPath(), target.toUri().getPath())
        return
    if files.exists(target):
        files.delete(target, False)
    if not files.rename(staged, target):
        raise OSError(f"could not put {staged} in place of {path}")


def read_sheet(spark: SparkSession, path: str, required: Sequence[str]) -> DataFrame:
    """The required columns of a CSV sheet or folder of them, nulls as ''; an error if one is missing, no rows if there is
    no file."""
    where, files = _paths(spark, path)
    if not files.exists(where):
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in required))
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"', quote='"')
    if missing := sorted(set(required) - set(rows.columns)):
        raise ValueError(f"{path} lacks {', '.join(missing)}")
    return rows.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in required])


def within_size(responses: DataFrame, body: str = "body", declared: str | None = None, most: int = BODY_BYTES) -> DataFrame:
    """responses with ``too_large``: whether the declared or the actual size of the body in bytes is over the bound; the
    body of one that is becomes null. A null body is not too large."""
    size = F.coalesce(F.octet_length(F.col(f"`{body}`")), F.lit(0))
    over = size > most
    if declared:
        over = over | F.coalesce(F.col(f"`{declared}`") > most, F.lit(False))
    return responses.withColumn("too_large", over).withColumn(body, F.when(~F.col("too_large"), F.col(f"`{body}`")))


def read_settings(path: str, environment: Mapping[str, str] | None = None) -> dict[str, str]:
    """Assignments of a settings file that the environment does not make already: the first of a name counts.

    Blank lines and comments are skipped, values may be quoted, and a space and # end a bare one; any other line is an
    error. No file gives none.
    """
    known = os.environ if environment is None else environment
    source = Path(path)
    found: dict[str, str] = {}
    for n, line in enumerate(source.read_text("utf-8-sig").splitlines() if source.exists() else (), 1):
        if not (line := line.strip()) or line[0] == "#":
            continue
        m = _SETTING.fullmatch(line)
        value = m[2].strip() if m else ""
        quoted = value[:1] in ("'", '"')
        try:
            parts = shlex.split(value, comments=True) if quoted else [value.partition(" #")[0].rstrip()]
        except ValueError:
            parts = []
        if m is None or len(parts) != 1:
            raise ValueError(f"line {n} of {path} is no assignment")
        found.setdefault(m[1], parts[0])
    return {k: x for k, x in found.items() if k not in known}
