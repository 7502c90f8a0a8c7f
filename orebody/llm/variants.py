"""Variant spellings of names: a pigeonhole segment join with banded edit distance, and classes over its links."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import combinations, permutations, product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from orebody.llm.components import components
from orebody.llm.naming import TRADE, edits, host_label, numbers, parse
from orebody.session import cut_lineage

EDITS = 2
MOST_EDITS = 3
# Forms of fewer letters are one edit apart at most, and within one line of trade; below LEAST they must be equal.
SHORTEST = 8
LEAST = 4
# From this length on, names of one line of trade may be one edit further apart.
LONG = 13
# Letters that stay of a word cut short, and edits where one was cut short to meet another.
PREFIX = 4
CUT_EDITS = 1
# Names of so many words of their own or fewer are met in any order of them.
ANY_ORDER = 4

_FORM = T.StructType([
    T.StructField("owner", T.StringType()), T.StructField("form", T.StringType()), T.StructField("trade", T.StringType()),
    T.StructField("pieces", T.ArrayType(T.StringType())), T.StructField("cut", T.BooleanType()),
])


def segments(length: int, k: int = EDITS) -> list[tuple[int, int]]:
    """(start, length) of k + 1 segments of nearly equal length; the later ones take what is over."""
    base, over = divmod(length, k + 1)
    out, at = [], 0
    for i in range(k + 1):
        size = base + (i >= k + 1 - over)
        out.append((at, size))
        at += size
    return out


@lru_cache
def borders(k: int) -> list[tuple[int, bool, bool]]:
    """(segment, whether its first letter is swapped with the one before it, its last with the one behind it): keys of
    which any k edits leave one.

    An edit inside a segment damages that one, a swap across a border two. With such swaps undone the k + 1 segments hold
    fewer edits than there are segments, so one is whole with at most as many edits on its left as segments, and on its
    right; the plain keys and the fewest (greedily) swapped ones that meet all such cases are taken.
    """
    keys = [(i, x, y) for i in range(k + 1) for x, y in product((False, True), repeat=2) if (i or not x) and (i < k or not y)]
    cases = []
    for n in range(k + 1):
        for crossed in combinations(range(1, k + 1), n):
            for d in product(range(k - n + 1), repeat=k + 1):
                if sum(d) <= k - n:
                    cases.append({(i, i in crossed, i + 1 in crossed) for i in range(k + 1) if not d[i] and sum(d[:i]) <= i and sum(d[i:]) <= k - i})
    out = [key for key in keys if not any(key[1:])]
    while open_cases := [c for c in cases if c.isdisjoint(out)]:
        out.append(max(keys, key=lambda key: sum(key in c for c in open_cases)))
    return out


@lru_cache(maxsize=10_000)
def _index_plan(length: int, k: int) -> list[tuple[str, int, int, bool, bool]]:
    """(beginning of the key, start and end of the segment, swap before it, swap behind it) of every key of a length."""
    cut = segments(length, k)
    plan = [(f"{length}:{i}:", a, a + n, bool(before and n and a), bool(behind and n and a + n < length)) for i, before, behind in borders(k) for a, n in [cut[i]]]
    return list(dict.fromkeys(plan))


def index_keys(s: str, k: int = EDITS) -> list[str]:
    """One key per segment: length, number and text; and those of segments with a swap across a border undone."""
    out = {}
    for head, a, b, before, behind in _index_plan(len(s), k):
        part = s[a:b]
        if before:
            part = s[a - 1] + part[1:]
        if behind:
            part = part[:-1] + s[b]
        out[head + part] = None
    return list(out)


@lru_cache(maxsize=10_000)
def _probe_plan(size: int, k: int | Callable[[int], int], longer: int) -> list[tuple[str, int, int]]:
    """(beginning of the key, start, end) of every piece that is looked up for a string of a size."""
    plan = []
    most = k if isinstance(k, int) else MOST_EDITS
    for length in range(max(1, size - most), size + longer + 1):
        near = k if isinstance(k, int) else k(length)
        more = size - length
        if more > near or length <= near:
            continue
        for i, (a, n) in enumerate(segments(length, near)):
            low = max(0, a - i, a + more - (near - i))
            high = min(size - n, a + i, a + more + (near - i))
            plan += [(f"{length}:{i}:", p, p + n) for p in range(low, high + 1)]
    return plan


def probe_keys(s: str, k: int | Callable[[int], int] = EDITS, longer: int = 0) -> list[str]:
    """Keys under which any string up to k edits away, and at most ``longer`` letters longer than s, has a segment; k may
    depend on that string's length.

    By the pigeonhole principle one of its k + 1 segments is untouched (swaps across borders undone) and stands in s,
    shifted by at most k; the window narrows with the number of segments on either side, as edits left of a segment and
    right of it add up.
    """
    return list(dict.fromkeys([head + s[a:b] for head, a, b in _probe_plan(len(s), k, longer)]))


def forms_of(owner: str, names: list[str | None], site: str | None) -> Iterator[tuple]:
    label = host_label(site)
    for name in dict.fromkeys(n for n in [*names, site if label else None] if n):
        x = parse(name)
        if x.words:
            yield owner, x.core, x.trade, list(x.words), any(x.cut)


def _forms(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, name, other, site = (batch.column(k).to_pylist() for k in range(4))
            out = [f for o, a, b, s in zip(owner, name, other, site) for f in forms_of(o, [a, b], s)]
            yield _rows(out, _FORM)

    return rows.select("owner", "name", "other", "site").mapInArrow(run, _FORM).distinct()


def _rows(out: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    columns = list(zip(*out)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, to_arrow_schema(schema).types)], schema.names)


_KEYS = T.StructType([
    T.StructField("form", T.StringType()), T.StructField("shown", T.StringType()), T.StructField("k", T.IntegerType()),
    T.StructField("probe", T.BooleanType()), T.StructField("marks", T.ArrayType(T.StringType())), T.StructField("keys", T.ArrayType(T.StringType())),
])
_PAIR = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType()), T.StructField("distance", T.IntegerType())])


def shown(pieces: list[str], cut: bool) -> tuple[set[str], set[str]]:
    """Under which spellings a form can be met: by any other, and (with one part cut short) by forms cut short themselves.

    Parts come in any order; of more than ANY_ORDER parts, in the given one, its reverse and the alphabetical one.
    """
    orders = set(permutations(pieces)) if len(pieces) <= ANY_ORDER else {tuple(pieces), tuple(pieces[::-1]), tuple(sorted(pieces))}
    whole = {"".join(order) for order in orders}
    if cut or len(pieces) < 2:
        return whole, set()
    return whole, {"".join(w[:PREFIX] if i == j else w for j, w in enumerate(order)) for order in orders for i in range(len(order)) if len(order[i]) > PREFIX}


def within_trade(length: int) -> int:
    """Edits at which forms of one line of trade are linked, by the length of the shorter."""
    return EDITS + 1 if length >= LONG else EDITS


def keys_of(form: str, trades: list[str], spellings: list[tuple[list[str], bool]]) -> Iterator[tuple[str, str, int, bool, list[str], list[str]]]:
    """(form, shown, k, probe, marks, keys): under which marks and keys a form is found, and looks for others.

    Forms that name lines of trade meet within each of them; forms that name none meet all. The mark of a key says which:
    a trade, - for forms without one, + for forms with some, looked up by those without. Spellings with a part cut short
    are many and looked for by few, so they are found under one mark each, and looked for under all that may hold them.
    """
    if len(form) >= SHORTEST:
        whole, short = set(), set()
        for pieces, cut in spellings:
            some, less = shown(list(pieces), cut)
            whole |= some
            short |= less
        near = within_trade(len(form))
        if trades:
            yield form, form, 0, True, trades, probe_keys(form, within_trade)
        yield form, form, 0, True, ["-"] if trades else ["-", "+"], probe_keys(form)
        if any(cut for _, cut in spellings):
            yield form, form, 0, True, [f"cut:{t}" for t in [*(trades or TRADE), "-"]], probe_keys(form, CUT_EDITS, CUT_EDITS)
        for s in whole:
            if trades and near == EDITS:
                yield form, s, EDITS, False, [*trades, "+"], index_keys(s)
            else:
                if trades:
                    yield form, s, near, False, trades, index_keys(s, near)
                yield form, s, EDITS, False, ["+" if trades else "-"], index_keys(s)
        for s in short - whole:
            yield form, s, CUT_EDITS, False, [f"cut:{t}" for t in trades or ["-"]], index_keys(s, CUT_EDITS)
    if LEAST <= len(form) <= SHORTEST and trades:  # the shortest of the others stand one edit away
        marks = [f"short:{t}" for t in trades]
        yield form, form, 0, True, marks, probe_keys(form, 1)
        for s in {s for pieces, _ in spellings for s in shown(list(pieces), True)[0]}:
            yield form, s, 1, False, marks, index_keys(s, 1)


def segment_links(forms: DataFrame) -> DataFrame:
    """(a, b, distance) of every two distinct forms that are spellings of one name.

    ``forms``: form, pieces, cut, trade. Two forms are linked at EDITS edits if they name a line of trade in common or one
    of them names none; from LONG letters on at one more within one trade; forms of fewer than SHORTEST letters at one
    edit, from LEAST letters on and within one trade. Parts may stand in another order, or one of them cut short (at
    CUT_EDITS) where the other form is written so. Numbers in them must be the same.

    Every form is indexed under the segments of its spellings and looked up under its own, all in one table of keys; forms
    that meet become distinct pairs, pass the JVM's banded Levenshtein distance (a swap counts two there, so twice as many
    are let through) and then the banded distance that counts a swap once. A key that many forms share is split by AQE.
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            form, trades, spellings = (batch.column(k).to_pylist() for k in range(3))
            for at in range(0, len(form), 500):
                ways = [[(x["pieces"], x["cut"]) for x in some] for some in spellings[at : at + 500]]
                found = (row for f, t, w in zip(form[at : at + 500], trades[at : at + 500], ways) for row in keys_of(f, t, w))
                yield _rows([(f, None if s == f else s, *rest) for f, s, *rest in found], _KEYS)  # null: shown as it is

    grouped = forms.groupBy("form").agg(F.collect_set("trade").alias("trades"), F.collect_set(F.struct("pieces", "cut")).alias("spellings"))
    keys = grouped.filter(F.length("form") >= LEAST).mapInArrow(keyed, _KEYS)
    keys = keys.select("form", "shown", "k", "probe", F.explode("marks").alias("mark"), "keys").select("form", "shown", "k", "probe", "mark", F.explode("keys").alias("key"))
    # Two keys of one hash only make a pair more to verify.
    keys = cut_lineage(keys.select("form", "shown", "k", "probe", F.xxhash64("mark", "key").alias("key")))
    probe = keys.filter("probe").select(F.col("form").alias("a"), "key")
    index = keys.filter("NOT probe").select(F.col("form").alias("b"), "shown", "k", "key")
    far = F.levenshtein("a", "shown", 2 * MOST_EDITS)
    near = probe.join(index, "key").withColumn("shown", F.coalesce("shown", "b")).filter((F.col("a") != F.col("b")) & (far >= 0) & (far <= 2 * F.col("k"))).select("a", "b", "shown", "k").distinct()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(k).to_pylist() for k in range(4)))
            yield _rows([(min(a, b), max(a, b), d) for a, b, s, k in rows if (d := edits(a, s, k)) <= k and numbers(a) == numbers(s)], _PAIR)

    return near.mapInArrow(verify, _PAIR).groupBy("a", "b").agg(F.min("distance").alias("distance"))


def variant_classes(df: DataFrame, owner: str, name: str, other: str, site: str) -> DataFrame:
    """(owner, class): owners whose names are spellings of one name share a class, named by a form of theirs.

    Names are folded and taken apart; what is their own is joined into one form. Distinct forms are linked as
    ``segment_links`` says, and the forms of one owner with each other, by way of the first of them: a name that millions
    of rows share is one form, never pairs. Equal forms are one, however short. Classes are the connected components.
    Null owners and names with no word of their own do not come out; repeated rows count once.
    """
    col = lambda c: F.col(f"`{c}`").cast("string")
    rows = df.select(col(owner).alias("owner"), col(name).alias("name"), col(other).alias("other"), col(site).alias("site")).filter(F.col("owner").isNotNull()).distinct()
    every = cut_lineage(_forms(rows))
    home = every.groupBy("owner").agg(F.min("form").alias("home"))
    same = every.join(home, "owner").filter(F.col("form") != F.col("home")).select(F.col("form").alias("a"), F.col("home").alias("b"))
    classes = components(segment_links(every).select("a", "b").unionByName(same))
    named = home.join(classes.withColumnRenamed("node", "home"), "home", "left")
    return named.select("owner", F.coalesce("component", "home").alias("class"))


def class_pairs(classes: DataFrame) -> DataFrame:
    """(a, b), a < b: every pair of owners of one class."""
    return classes.select(F.col("owner").alias("a"), "class").join(classes.select(F.col("owner").alias("b"), "class"), "class").filter("a < b").select("a", "b")
