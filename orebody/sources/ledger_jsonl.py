"""JSON-lines ledgers that a crash may have cut short: one torn last line without a line break is passed over, any other
bad line fails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RECORD_BYTES = 256 * 1024
FILE_BYTES = 16 * 1024 * 1024
# Lines that are taken out of a file at once.
PIECE_LINES = 1_000


def read_ledger(
    spark: SparkSession, path: str, schema: str | None = None, record_bytes: int = RECORD_BYTES, file_bytes: int = FILE_BYTES,
    all_bytes: int | None = None, all_rows: int | None = None,
) -> DataFrame:
    """(path, line_no, payload) of every line, or the parsed columns beside path and line_no when a schema is given.

    Blank lines are skipped. Fails on a line that is no JSON object, on a repeated key, on a line or file over its bound.
    A file is one record of the scan, because line numbers and the torn tail are properties of the file: its bound keeps
    that record small, so ledgers grow by files, and files are read in parallel. It is cut into pieces of PIECE_LINES, and
    these into lines, so that no line has the text of its file beside it. No files is an error of the scan; an empty file
    has no rows. ``all_bytes`` and ``all_rows`` bound the ledger as a whole, where it should have a bound: sizes
    are read from the files' listing, rows counted in a pass of their own.
    """
    if all_bytes is not None and (total := spark.read.format("binaryFile").load(path).agg(F.sum("length").alias("n")).first().n or 0) > all_bytes:
        raise ValueError(f"ledger {path} has {total} bytes, more than {all_bytes}")
    files = spark.read.format("binaryFile").load(path).select("path", "length", F.col("content").cast("string").alias("text"))
    sized = files.withColumn("text", F.when(F.col("length") <= file_bytes, F.col("text")).otherwise(F.raise_error(F.concat(F.lit("ledger file over its bound: "), "path"))))
    # What a generator is applied to must not be used beside it: it would be copied to every row. The second one holds a
    # higher-order function, which is not compiled: rows then leave it one by one, not once a file is through.
    piece = F.regexp_extract_all("text", F.lit(rf"(?:[^\n]*+(?:\n|\z)){{1,{PIECE_LINES}}}+"), F.lit(0))
    pieces = sized.select("path", F.posexplode(piece).alias("part", "piece"))
    line = lambda x, k: F.struct((F.col("part") * PIECE_LINES + k + 1).alias("line_no"), F.rtrim(x, F.lit("\n")).alias("line"), F.endswith(x, F.lit("\n")).alias("whole"))
    lines = pieces.select("path", F.inline(F.transform(F.split("piece", r"(?<=\n)"), line))).filter(F.trim("line") != "")
    parsed: Column = F.try_parse_json("line")
    torn = ~F.col("whole") & parsed.isNull()  # only the last line can lack its line break
    kind = F.schema_of_variant(parsed)  # null for what is no JSON
    good = F.coalesce(kind.startswith("OBJECT"), F.lit(False)) & (F.octet_length("line") <= record_bytes)
    where = F.concat(F.lit("bad ledger line "), "path", F.lit(":"), F.col("line_no").cast("string"))
    checked = lines.filter(~torn).withColumn("line", F.when(good, F.col("line")).otherwise(F.raise_error(where)))
    out = checked.select("path", "line_no", F.col("line").alias("payload"))
    if all_rows is not None and (rows := out.count()) > all_rows:
        raise ValueError(f"ledger {path} has {rows} rows, more than {all_rows}")
    return out if schema is None else out.select("path", "line_no", F.from_json("payload", schema).alias("r")).select("path", "line_no", "r.*")


def latest_records(ledger: DataFrame, key: str) -> DataFrame:
    """The last line of every key, files in order of their path: max_by is combined before the shuffle."""
    rest = [c for c in ledger.columns if c != key]
    best = F.max_by(F.struct(*rest), F.struct("path", "line_no")).alias("r")
    return ledger.filter(F.col(key).isNotNull()).groupBy(key).agg(best).select(key, "r.*")
