"""Matching records of two sources that share no key: soft rules, solved as one convex problem by alternating directions.

Every record that may belong to a company site is a soft truth value in [0, 1]. Weighted rules (same site, same name,
region of the site, prior) are hinges on it, records of one name and region agree with each other (transitivity), and a
record or a region of one name belongs to one site at most (exclusivity). The sum of all hinges is minimised by the
alternating direction method of multipliers; the values are the confidences.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from orebody.functions.geo import REGIONS
from orebody.llm.components import components
from orebody.llm.naming import Name, edits, fold, parse
from orebody.llm.variants import segment_links
from orebody.session import cut_lineage

# Weights of the rules.
SITE_RULE, LINK_RULE, NAME_RULE, PRIOR_RULE, SUFFIX_RULE, ELSEWHERE_RULE, AGREE_RULE = 8.0, 4.0, 1.0, 0.3, 2.0, 1.5, 1.0
# Length of a step, and the greatest move of a value or gap between its copies at which the rounds end; a class that
# needs more than ROUNDS is an error, never a result.
STEP, TOLERANCE, ROUNDS = 1.0, 2e-4, 20_000
# Truths of a name class up to which a task solves it as a whole; larger classes are solved by all tasks together.
WHOLE_CLASS = 100_000
# Truths that a task gathers (whole classes) before it solves them in one go.
TOGETHER = 20_000
# Rounds between two cuts of the lineage.
EACH = 6
LEAST_TRUTH = 0.3
# A domain is a directory if records of at least so many different names show it and at most this share of them is like
# it: how often a record or a name repeats says nothing.
DIRECTORY_NAMES, DIRECTORY_SHARE = 5, 0.2

_CODES = {v: v for v in REGIONS.values()} | {fold(k): v for k, v in REGIONS.items()} | {v.lower(): v for v in REGIONS.values()}
_BLANK_NAMES = frozenset("home page untitled index welcome homepage unknown na none null".split())
_URL = re.compile(r"^(?:https?://)?(?:[^/@\s]*@)?([^/?#:\s]+)", re.I)
_COMPANY_LABEL = re.compile(r"^(.+)-([a-z]{2})$")

_PARSED = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("record_id", T.StringType()), T.StructField("form", T.StringType()),
    T.StructField("trade", T.StringType()), T.StructField("pieces", T.ArrayType(T.StringType())), T.StructField("cut", T.BooleanType()),
    T.StructField("domain", T.StringType()), T.StructField("base", T.StringType()), T.StructField("suffix", T.StringType()), T.StructField("linked", T.BooleanType()),
    T.StructField("fits", T.BooleanType()), T.StructField("city", T.StringType()), T.StructField("region", T.StringType()),
])


def domain_of(url: str | None) -> str | None:
    """The last two labels of the host of an http(s) address or bare host; None for other schemes and bare words."""
    if not url or (m := re.match(r"^\s*([a-z][a-z0-9+.-]*)://", url, re.I)) and m.group(1).lower() not in ("http", "https"):
        return None
    m = _URL.match(url.strip())
    labels = m.group(1).lower().strip(".").split(".") if m else []
    return ".".join(labels[-2:]) if len(labels) > 1 and all(labels) else None


@lru_cache(maxsize=50_000)
def site_parts(domain: str) -> tuple[str, str | None]:
    """The own part of a domain's label without connecting words, and the region that it ends in."""
    label = domain.rsplit(".", 1)[0]
    m = _COMPANY_LABEL.match(label)
    suffix = m.group(2).upper() if m and m.group(2).upper() in _CODES else None
    return parse(f"{m.group(1) if suffix else label}.x").core, suffix


def alike(name: Name, base: str) -> bool:
    """Whether a site's own part reads like the name: few edits in either order, a cut-short part, or many shared pairs."""
    orders = ["".join(name.words), "".join(name.words[::-1])]
    if base in orders:
        return True
    pairs = lambda s: {s[i : i + 2] for i in range(len(s) - 1)}
    a, b = pairs(name.core), pairs(base)
    if a and b and 2 * len(a & b) / (len(a) + len(b)) >= 0.6:
        return True
    return any(edits(joined, base, 4) <= 4 for joined in orders)


@lru_cache(maxsize=50_000)
def place(city: str | None, region: str | None) -> tuple[str | None, str | None]:
    """City and region code in one form; a region at the end of the city counts where none is given."""
    code = _CODES.get(fold(region).strip()) if region else None
    words = re.findall(r"[^\W\d_]+", fold(city)) if city else []
    if len(words) > 1 and len(words[-1]) == 2 and words[-1].upper() in _CODES and "," in city:
        code = code or words[-1].upper()
        words = words[:-1]
    return " ".join(words) or None, code


def _parsed(rows: DataFrame) -> DataFrame:
    names = ["source", "record_id", "name", "site", "link", "city", "region"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for source, record_id, text, site, link, town, area in zip(*(batch.column(k).to_pylist() for k in range(len(names)))):
                name = parse(text)
                if not name.words or _BLANK_NAMES.issuperset(name.words):
                    name = Name((), (), None)
                first, second = domain_of(site), domain_of(link)
                city, region = place(town, area)
                for domain, linked in ((first, False), (second, True)) if first != second else ((first, False),):
                    if domain is None and (linked or second):
                        continue
                    base, suffix = site_parts(domain) if domain else (None, None)
                    fits = alike(name, base) if name.words and base else None
                    out.append((source, record_id, name.core or None, name.trade, list(name.words) or None, any(name.cut), domain, base or None, suffix, linked, fits, city, region))
            columns = list(zip(*out)) or [()] * len(_PARSED)
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, to_arrow_schema(_PARSED).types)], _PARSED.names)

    return rows.select(*[F.col(c).cast("string").alias(c) for c in names]).mapInArrow(run, _PARSED)


def _found(rows: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """rows with the columns of ``known`` that belong to their key; rows without a key are spread, not sent to one task."""
    spread = F.coalesce(F.concat(F.lit("="), key), F.pmod(F.xxhash64("record_id"), F.lit(1 << 20)).cast("string"))
    return rows.withColumn("_key", spread).join(known.withColumn("_key", F.concat(F.lit("="), key)).drop(key), "_key", "left").drop("_key")


def _resolved(parsed: DataFrame) -> DataFrame:
    """One row per record: directories are no sites, the record's own site comes before the linked one, and a missing
    region is the one in which its city mostly lies."""
    names = parsed.filter(F.col("domain").isNotNull() & F.col("fits").isNotNull()).groupBy("domain", "form").agg(F.bool_or("fits").alias("fits"))
    shared = names.groupBy("domain").agg(F.count("*").alias("n"), F.avg(F.col("fits").cast("int")).alias("share"))
    shared = shared.filter((F.col("n") >= DIRECTORY_NAMES) & (F.col("share") <= DIRECTORY_SHARE)).select("domain", F.lit(True).alias("directory"))
    rows = _found(parsed, shared, "domain")
    own = F.when(F.col("directory").isNull() & F.col("base").isNotNull(), F.struct(F.col("linked"), F.col("base"), F.col("suffix"), F.col("fits")))
    keys = ["source", "record_id", "form", "trade", "pieces", "cut", "city", "region"]
    rows = rows.groupBy(*keys).agg(F.min(own).alias("site"))
    lies = rows.filter(F.col("city").isNotNull() & F.col("region").isNotNull()).groupBy("city", "region").agg(F.count("*").alias("n"))
    mostly = lies.groupBy("city").agg(F.max_by("region", F.struct("n", "region")).alias("usual"), F.max("n").alias("most"), F.sum("n").alias("all"))
    mostly = mostly.filter(F.col("most") >= 0.8 * F.col("all")).select("city", "usual")
    out = _found(rows, mostly, "city")
    return out.select(
        "source", "record_id", "form", "trade", "pieces", "cut", F.coalesce("region", "usual").alias("region"),
        F.col("site.base").alias("base"), F.col("site.suffix").alias("suffix"), F.col("site.linked").alias("linked"), F.col("site.fits").alias("fits"),
    )


def _name_classes(rows: DataFrame) -> DataFrame:
    """(form, name_class): names and site labels that are spellings of one another."""
    named = rows.filter(F.col("form").isNotNull()).select("form", "pieces", "cut", "trade")
    labels = rows.filter(F.col("base").isNotNull()).select(
        F.col("base").alias("form"), F.array("base").alias("pieces"), F.lit(False).alias("cut"), F.lit(None).cast("string").alias("trade")
    )
    sited = rows.filter(F.col("fits")).select(F.col("form").alias("a"), F.col("base").alias("b")).distinct()
    classes = components(segment_links(named.unionByName(labels).distinct()).select("a", "b").unionByName(sited))
    return classes.select(F.col("node").alias("form"), F.col("component").alias("name_class"))


def _settle(holder: np.ndarray, group: np.ndarray, held: np.ndarray, up: np.ndarray, down: np.ndarray) -> np.ndarray:
    """The minimiser of all hinges of some whole classes.

    holder: the owner of each truth; group: its site and region of the class, -1 without a region; held: the region of
    each group. Every term has copies of its own of the truths it speaks of, and multipliers for them: the hinges of a
    truth, the agreement of a truth with its region (a copy of both), exclusivity of an owner and of a region. A round
    moves each term's copies to the term's minimum (all closed forms), takes the truth as the mean of its copies, and adds
    to the multipliers what they differ.
    """
    placed = np.flatnonzero(group >= 0)
    g, groups = group[placed], len(held)
    owners, regions = int(holder.max(initial=-1)) + 1, int(held.max(initial=-1)) + 1
    of_owner, of_region = np.bincount(holder, minlength=owners), np.bincount(held, minlength=regions)
    x, z = np.full(len(holder), 0.5), np.full(groups, 0.5)
    u1, u2, u3 = np.zeros(len(x)), np.zeros(len(placed)), np.zeros(len(x))
    ub, uz = np.zeros(len(placed)), np.zeros(groups)
    terms, members = np.full(len(x), 2.0), np.bincount(g, minlength=groups) + 1.0
    terms[placed] += 1
    most = AGREE_RULE / STEP
    for _ in range(ROUNDS):
        x1 = np.clip((STEP * (x - u1) + up) / (STEP + up + down), 0, 1)
        va, vb = x[placed] - u2, z[g] - ub
        move = np.clip((va - vb) / 2, -most, most)
        a, b = va - move, vb + move
        v3, vz = x - u3, z - uz
        x3 = v3 - (np.maximum(0, np.bincount(holder, v3, owners) - 1) / of_owner)[holder]
        z3 = vz - (np.maximum(0, np.bincount(held, vz, regions) - 1) / np.maximum(1, of_region))[held]
        total = x1 + u1 + x3 + u3
        total[placed] += a + u2
        before, before_z = x, z
        x = np.clip(total / terms, 0, 1)
        z = np.clip((np.bincount(g, b + ub, groups) + z3 + uz) / members, 0, 1)
        gaps = x1 - x, x3 - x, a - x[placed], b - z[g], z3 - z, x - before, z - before_z
        u1, u3, u2, ub, uz = u1 + gaps[0], u3 + gaps[1], u2 + gaps[2], ub + gaps[3], uz + gaps[4]
        if max(np.abs(d).max(initial=0) for d in gaps) < TOLERANCE:
            return x
    raise RuntimeError(f"values still move after {ROUNDS} rounds")


def _settle_rows(rows: pa.Table) -> pa.RecordBatch:
    number = lambda *keys: np.unique(np.stack(keys), axis=1, return_inverse=True)
    code = lambda c: rows.column(c).combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(False).astype(np.int64)
    klass, owner, region, anchor = (code(c) for c in ("name_class", "owner", "region", "anchor"))
    holder = number(klass, owner)[1].ravel()
    placed = np.flatnonzero(region >= 0)
    group = np.full(len(klass), -1)
    kinds, group[placed] = (lambda u: (u[0], u[1].ravel()))(number(klass[placed], region[placed], anchor[placed]))
    held = number(kinds[0], kinds[1])[1].ravel()
    weight = lambda c: rows.column(c).to_numpy().astype(float)
    value = _settle(holder, group, held, weight("up"), weight("down"))
    columns = [rows.column(c).combine_chunks() for c in ("name_class", "owner", "region", "anchor")]
    return pa.RecordBatch.from_arrays([*columns, pa.array(value)], ["name_class", "owner", "region", "anchor", "value"])


def _solve_whole(truths: DataFrame) -> DataFrame:
    """Classes that fit a task: one exchange by class, all rounds inside the task, many classes at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            kept.append(batch)
            if sum(b.num_rows for b in kept) < TOGETHER:
                continue
            rows = pa.Table.from_batches(kept)
            names = rows.column("name_class")
            end = int(np.argmax(np.asarray(names.to_pylist(), object) == names[-1].as_py()))  # the last class may go on
            if end:
                yield _settle_rows(rows.slice(0, end))
                kept = rows.slice(end).combine_chunks().to_batches()
        if kept:
            yield _settle_rows(pa.Table.from_batches(kept))

    schema = "name_class string, owner string, region string, anchor string, value double"
    return truths.repartition("name_class").sortWithinPartitions("name_class").mapInArrow(run, schema)


def _solve_spread(truths: DataFrame) -> DataFrame:
    """The same rounds for classes beyond a task, as windows by owner and by site and region, never by class."""
    own = truths.select("name_class", "owner", "region", "anchor", "up", "down", F.lit(1).alias("kind"))
    regions = truths.filter(F.col("region").isNotNull()).select("name_class", F.concat(F.lit("region:"), "region").alias("owner"), "region", "anchor").distinct()
    regions = regions.withColumns({"up": F.lit(0.0), "down": F.lit(0.0), "kind": F.lit(0)})
    zero = dict.fromkeys(("u1", "u2", "u3", "ub"), F.lit(0.0))
    state = cut_lineage(own.unionByName(regions).withColumns({"value": F.lit(0.5), **zero}))
    holders = Window.partitionBy("name_class", "kind", "owner")
    agree = Window.partitionBy("name_class", "anchor", "region")
    is_region, placed = F.col("kind") == 0, F.col("region").isNotNull()
    col, most = F.col, F.lit(AGREE_RULE / STEP)
    for k in range(1, ROUNDS + 1):
        v3 = col("value") - col("u3")
        state = state.withColumns({
            "before": col("value"),
            "x1": F.greatest(F.lit(0.0), F.least(F.lit(1.0), (STEP * (col("value") - col("u1")) + col("up")) / (STEP + col("up") + col("down")))),
            "x3": v3 - F.greatest(F.lit(0.0), F.sum(v3).over(holders) - 1) / F.count(F.lit(1)).over(holders),
        })
        state = state.withColumn("centre", F.max(F.when(is_region, col("value"))).over(agree))
        va, vb = col("value") - col("u2"), col("centre") - col("ub")
        state = state.withColumn("move", F.when(placed, F.greatest(-most, F.least(most, (va - vb) / 2))))
        state = state.withColumns({"a": va - col("move"), "b": vb + col("move")})
        backed = F.sum(F.when(~is_region, col("b") + col("ub"))).over(agree)
        of_region = (backed + col("x3") + col("u3")) / (F.count(F.when(~is_region, 1)).over(agree) + 1)
        alone = col("x1") + col("u1") + col("x3") + col("u3")
        value = F.when(is_region, of_region).when(placed, (alone + col("a") + col("u2")) / 3).otherwise(alone / 2)
        state = state.withColumn("value", F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)))
        state = state.withColumn("centre", F.max(F.when(is_region, col("value"))).over(agree))
        gap = {"u1": F.when(is_region, 0.0).otherwise(col("x1") - col("value")), "u2": F.when(is_region | ~placed, 0.0).otherwise(col("a") - col("value")),
               "u3": col("x3") - col("value"), "ub": F.when(is_region | ~placed, 0.0).otherwise(col("b") - col("centre"))}
        worst = F.greatest(F.abs(col("value") - col("before")), *map(F.abs, gap.values()))
        state = state.withColumns({u: col(u) + d for u, d in gap.items()} | {"worst": worst})
        if k % EACH == 0:
            state = cut_lineage(state)
            if (state.agg(F.max("worst").alias("d")).first().d or 0.0) < TOLERANCE:
                return state.filter(~is_region).select("name_class", "owner", "region", "anchor", "value")
    raise RuntimeError(f"values still move after {ROUNDS} rounds")


def solve(truths: DataFrame) -> DataFrame:
    """truths with ``value``: the minimiser of all hinges, by alternating directions.

    ``truths``: name_class, owner (the record class), region, anchor, up, down. A truth has squared hinges up/2 * max(0,
    1 - x)^2 and down/2 * max(0, x)^2, agrees with the truth of its region at AGREE_RULE * |x - z|, and the truths of an
    owner, and of a region, add up to one at most. All of it stays within a name class: classes of up to WHOLE_CLASS
    truths are solved within tasks, larger ones by windows over all of them; both take the same rounds until no value and
    no copy is off by TOLERANCE, and fail rather than return what has not settled.
    """
    large = truths.groupBy("name_class").count().filter(F.col("count") > WHOLE_CLASS).select("name_class")
    large = cut_lineage(large)  # at most the number of truths over WHOLE_CLASS
    if large.isEmpty():
        return _solve_whole(truths)
    whole = _solve_whole(truths.join(large, "name_class", "left_anti"))
    return whole.unionByName(_solve_spread(truths.join(large, "name_class", "left_semi")))


def link_records(records: DataFrame) -> DataFrame:
    """(source, record_id, company, confidence): the company that each record is taken to belong to.

    ``records``: source, record_id, name, site, link (another address of the record), city, region. Names are brought
    into classes of spellings by the segment join; within a class, the sites that its records show are the companies, or
    the class itself where it shows none. Records of one class, site and region are one owner of truths, so how many
    there are costs nothing; records without a site have a truth for every site of their class.

    Null or placeholder names with a site belong to the site; with neither name nor site a record belongs to none and
    does not come out. Repeated rows count once.
    """
    rows = cut_lineage(_resolved(cut_lineage(_parsed(records.distinct()))))
    classes = cut_lineage(_name_classes(rows))
    by_site = classes.select(F.col("form").alias("base"), F.col("name_class").alias("site_class"))
    by_name = classes.select("form", F.col("name_class").alias("form_class"))
    placed = _found(_found(rows, by_site, "base"), by_name, "form").withColumn("name_class", F.coalesce("site_class", "base", "form_class", "form"))
    placed = placed.filter(F.col("name_class").isNotNull())
    anchor = F.concat_ws("-", "base", "suffix")
    placed = cut_lineage(placed.select("source", "record_id", "name_class", "region", F.when(F.col("base").isNotNull(), anchor).alias("anchor"), "suffix", "linked"))
    group = ["name_class", "anchor", "suffix", "region"]
    owners = placed.groupBy(*group).agg(F.min("linked").alias("linked"), F.count("*").alias("n"))
    owners = owners.withColumn("owner", F.concat_ws("|", F.coalesce("anchor", F.lit("?")), F.coalesce("region", F.lit("?"))))
    sites = owners.filter(F.col("anchor").isNotNull()).groupBy("name_class", "anchor", "suffix").agg(F.sum("n").alias("weight"))
    sited = owners.filter(F.col("anchor").isNotNull()).withColumn("up", F.when(F.col("linked"), LINK_RULE).otherwise(SITE_RULE) + NAME_RULE).withColumn("down", F.lit(PRIOR_RULE))
    free = owners.filter(F.col("anchor").isNull()).select("name_class", "owner", "region").join(sites, "name_class", "left")
    free = free.withColumn("anchor", F.coalesce("anchor", F.lit("?")))
    here = F.coalesce(F.col("suffix") == F.col("region"), F.lit(False))
    there = F.coalesce(F.col("suffix") != F.col("region"), F.lit(False))
    free = free.withColumns({
        "up": F.lit(NAME_RULE) + F.when(here, SUFFIX_RULE).otherwise(0.0),
        "down": F.lit(PRIOR_RULE) + F.when(there, ELSEWHERE_RULE).otherwise(0.0),
    })
    columns = ["name_class", "owner", "region", "anchor", "up", "down"]
    solved = solve(cut_lineage(sited.select(*columns).unionByName(free.select(*columns))))
    weighed = solved.join(sites.select("name_class", "anchor", "weight"), ["name_class", "anchor"], "left")
    best = F.max(F.struct(F.round("value", 3).alias("value"), F.coalesce("weight", F.lit(0)).alias("weight"), F.col("anchor").alias("anchor"))).alias("b")
    chosen = weighed.groupBy("name_class", "owner").agg(best).filter(F.col("b.value") >= LEAST_TRUTH)
    owned = placed.withColumn("owner", F.concat_ws("|", F.coalesce("anchor", F.lit("?")), F.coalesce("region", F.lit("?")))).drop("anchor")
    company = F.concat_ws("/", "name_class", "b.anchor").alias("company")
    return owned.join(chosen, ["name_class", "owner"]).select("source", "record_id", company, F.col("b.value").alias("confidence"))


def matches(linked: DataFrame, one: str, other: str) -> DataFrame:
    """(record_id_a, record_id_b, confidence), a < b: records of the two sources that belong to one company."""
    best = linked.filter(F.col("record_id").isNotNull()).groupBy("source", "record_id", "company").agg(F.max("confidence").alias("c"))
    a = best.filter(F.col("source") == one).select("company", F.col("record_id").alias("x"), F.col("c").alias("cx"))
    b = best.filter(F.col("source") == other).select("company", F.col("record_id").alias("y"), F.col("c").alias("cy"))
    pairs = a.join(b, "company").select(F.least("x", "y").alias("record_id_a"), F.greatest("x", "y").alias("record_id_b"), F.least("cx", "cy").alias("confidence"))
    return pairs.groupBy("record_id_a", "record_id_b").agg(F.max("confidence").alias("confidence"))
