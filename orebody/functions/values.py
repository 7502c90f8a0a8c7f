"""Identifiers, instants, sums and JSON, with defined results for nulls."""

from __future__ import annotations

import json
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def digest_id(prefix: str, preimage: Column) -> Column:
    """prefix + the first 24 hex digits of SHA-256 of the preimage; null for null."""
    return F.concat(F.lit(prefix), F.substring(F.sha2(preimage, 256), 1, 24))


def set_digest(text: Column) -> Column:
    """An aggregate: the digest of a multiset of texts, whatever their order. Two parts of the SHA-256 of each are added up
    (exactly, in 38 digits), so it is combined before the shuffle and takes no room."""
    part = lambda at: F.conv(F.substring(F.sha2(text, 256), at, 15), 16, 10).cast("decimal(20,0)")
    total = lambda at: F.coalesce(F.sum(part(at)), F.lit(0).cast("decimal(30,0)")).cast("string")
    return F.sha2(F.concat_ws(":", F.count(text).cast("string"), total(1), total(16)), 256)


def canonical_text(text: Column, without: Sequence[str] = ()) -> Column:
    """JSON text in its canonical form: keys sorted at every level, no spaces, characters as they are, and without the
    keys named, wherever they stand. Null for null; an error for what is no JSON or holds a number that is none."""
    dropped = frozenset(without)

    def refuse(name: str) -> float:
        raise ValueError(f"{name} is no JSON number")

    @F.arrow_udf(T.StringType())
    def run(values: pa.Array) -> pa.Array:
        keep = lambda pairs: {k: x for k, x in pairs if k not in dropped}
        read = json.JSONDecoder(object_pairs_hook=keep, parse_constant=refuse).decode
        form = json.JSONEncoder(sort_keys=True, ensure_ascii=False, separators=(",", ":")).encode
        return pa.array([None if x is None else form(read(x)) for x in values.to_pylist()], pa.string())

    return run(text)


def instant(text: Column) -> Column:
    """ISO-8601 text with an offset as an instant; null without one or when malformed."""
    return F.when(text.rlike(r"(Z|[+-]\d\d:?\d\d)\s*$"), text.try_cast("timestamp"))


def sum_if_all_known(value: Column) -> Column:
    """The sum, or null as soon as one value is null."""
    return F.when(F.count(value) == F.count(F.lit(1)), F.sum(value))


def round_exact(value: Column, digits: int) -> Column:
    """Rounded half-even on the exact binary value, as IEEE arithmetic in Python does."""

    @F.arrow_udf(T.DoubleType())
    def run(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else round(v, digits) for v in values.to_pylist()], pa.float64())

    return run(value)


def text_at(value: Column, path: str) -> Column:
    """The string at a path of a VARIANT; null where there is none, another type, or nothing in it."""
    there = F.try_variant_get(value, path, "variant")
    return F.when(F.schema_of_variant(there) == "STRING", F.nullif(F.try_variant_get(value, path, "string"), F.lit("")))
