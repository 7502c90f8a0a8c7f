"""References to records that do not exist, found directly and handed down the foreign-key graph."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orebody.session import cut_lineage

_WHITE = r"[\s\u0085\p{Z}]+"
_EDGES = rf"^{_WHITE}|{_WHITE}\z"


@dataclass(frozen=True)
class Keyed:
    """A table of the graph: its record identifier and, for the report, the instant that names its period."""

    frame: DataFrame
    record_id: str
    time: Column | None = None


@dataclass(frozen=True)
class ForeignKey:
    """child.column (a value or an array of values) must lead to parent.parent_column.

    With ``since`` (and ``until``) the parent row must exist at the child's time: since <= time and
    (until is null or until > time). ``clean`` trims white space of any kind and lower-cases the child's value.
    """

    child: str
    column: str
    parent: str
    parent_column: str
    since: str | None = None
    until: str | None = None
    clean: bool = False

    @property
    def name(self) -> str:
        return f"{self.child}.{self.column}"


@dataclass
class Cascade:
    """references: one row per dangling reference (direct). records: every orphaned record with its level (0 = direct)."""

    references: DataFrame
    records: DataFrame
    rounds: int
    tables: Mapping[str, Keyed] = field(repr=False)

    def report(self, period: str = "month") -> DataFrame:
        """(table_name, period, direct, inherited): distinct orphaned records; period is null where no time is known."""
        return (
            self.records.withColumn("period", F.date_trunc(period, "at"))
            .groupBy("table_name", "period")
            .agg(F.count_if(F.col("level") == 0).alias("direct"), F.count_if(F.col("level") > 0).alias("inherited"))
        )


def _references(key: ForeignKey, table: Keyed) -> DataFrame:
    """(record_id, reference, at) of every entry that is one: null entries never are, and blank ones not when cleaned."""
    frame = table.frame
    value: Column = F.col(f"`{key.column}`")
    at = (table.time if table.time is not None else F.lit(None)).cast("timestamp_ntz")
    listed = isinstance(frame.schema[key.column].dataType, T.ArrayType)
    entry = F.explode(value.cast("array<string>")) if listed else value.cast("string")
    out = frame.select(F.col(f"`{table.record_id}`").cast("string").alias("record_id"), at.alias("at"), entry.alias("reference"))
    if key.clean:
        out = out.withColumn("reference", F.lower(F.regexp_replace("reference", _EDGES, ""))).filter(F.col("reference") != "")
    return out.filter(F.col("reference").isNotNull())


def _without_parent(references: DataFrame, parents: DataFrame, key: ForeignKey) -> DataFrame:
    """References to which no parent row answers.

    Without validity this is an anti join on distinct parent keys. With validity it is an as-of question, answered by
    one sorted pass and no interval join: per key and day, rows ordered by instant carry the running maximum of
    ``until`` over the items that have begun; the reference dangles where that maximum has passed. What earlier days
    leave behind comes from a daily pre-aggregate, so one key that holds most rows is still spread over its days.
    """
    if key.since is None:
        known = parents.select(F.col(f"`{key.parent_column}`").cast("string").alias("reference")).filter(F.col("reference").isNotNull()).distinct()
        return references.join(known, "reference", "left_anti")
    local = lambda c: F.col(f"`{c}`").cast("timestamp_ntz")
    far = F.lit("9999-12-31 23:59:59.999999").cast("timestamp_ntz")
    until = F.coalesce(local(key.until), far) if key.until else far
    items = parents.select(F.col(f"`{key.parent_column}`").cast("string").alias("reference"), local(key.since).alias("t"), until.alias("u"))
    items = items.filter(F.col("reference").isNotNull() & F.col("t").isNotNull() & (F.col("u") > F.col("t"))).withColumn("day", F.to_date("t"))
    asked = references.withColumn("t", F.col("at")).withColumn("day", F.to_date("t"))
    timeless = asked.filter(F.col("t").isNull()).select("record_id", "at", "reference")
    asked = asked.filter(F.col("t").isNotNull())
    daily = (
        items.select("reference", "day", "u")
        .unionByName(asked.select("reference", "day", F.lit(None).cast("timestamp_ntz").alias("u")))
        .groupBy("reference", "day")
        .agg(F.max("u").alias("u"))
    )
    before = Window.partitionBy("reference").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        daily.withColumn("u", F.max("u").over(before))
        .filter(F.col("u").isNotNull())
        .select("reference", "day", F.col("day").cast("timestamp_ntz").alias("t"), "u")
    )
    nothing = {"record_id": F.lit(None).cast("string"), "at": F.lit(None).cast("timestamp_ntz")}
    rows = (
        items.unionByName(carried)
        .withColumns(nothing | {"asks": F.lit(0)})
        .unionByName(asked.withColumns({"u": F.lit(None).cast("timestamp_ntz"), "asks": F.lit(1)}))
    )
    so_far = Window.partitionBy("reference", "day").orderBy("t", "asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    dangling = (
        rows.withColumn("u", F.max("u").over(so_far))
        .filter((F.col("asks") == 1) & (F.col("u").isNull() | (F.col("u") <= F.col("t"))))
        .select("record_id", "at", "reference")
    )
    return dangling.unionByName(timeless)


def orphan_cascade(tables: Mapping[str, Keyed], keys: Sequence[ForeignKey], max_rounds: int = 50) -> Cascade:
    """Direct orphans of every foreign key, then, round by round, the records that hang on orphaned ones.

    Each round semi-joins the children of the last round's newly orphaned records on their foreign key and keeps those
    not orphaned before; the loop ends when a round finds none (cycles therefore end too), or raises after max_rounds.
    A record is level 0 when one of its own references dangles, else one more than the parent it hangs on.

    Defined cases: null references are none; a null record id cannot be a parent and is reported under null; a null
    time means the parent cannot have existed then; repeated rows count once; empty tables give no orphans as children
    and leave every reference dangling as parents; columns other than those named are not read.
    """
    for key in keys:
        for name in (key.child, key.parent):
            if name not in tables:
                raise ValueError(f"unknown table {name}")
    found = []
    for key in keys:
        missing = _without_parent(_references(key, tables[key.child]), tables[key.parent].frame, key)
        found.append(missing.select(F.lit(key.child).alias("table_name"), F.lit(key.column).alias("column_name"), "record_id", "reference", "at").distinct())
    references = found[0]
    for more in found[1:]:
        references = references.unionByName(more)
    direct = references.groupBy("table_name", "record_id").agg(F.min("at").alias("at")).withColumn("level", F.lit(0))
    handed = [k for k in keys if any(x.child == k.parent and tables[x.child].record_id == k.parent_column for x in keys)]
    if not handed:
        return Cascade(references, direct, 0, tables)
    known = frontier = cut_lineage(direct)
    for level in range(1, max_rounds + 1):
        reached = None
        for key in handed:
            gone = frontier.filter((F.col("table_name") == key.parent) & F.col("record_id").isNotNull()).select(F.col("record_id").alias("reference"))
            hit = _references(key, tables[key.child]).join(gone, "reference", "left_semi")
            hit = hit.groupBy(F.lit(key.child).alias("table_name"), "record_id").agg(F.min("at").alias("at"))
            reached = hit if reached is None else reached.unionByName(hit)
        reached = reached.groupBy("table_name", "record_id").agg(F.min("at").alias("at"))
        fresh = reached.join(known.select("table_name", "record_id"), ["table_name", "record_id"], "left_anti").withColumn("level", F.lit(level))
        frontier = cut_lineage(fresh)
        if frontier.isEmpty():
            return Cascade(references, known, level, tables)
        known = known.unionByName(frontier)
    raise RuntimeError(f"no fixpoint after {max_rounds} rounds")
