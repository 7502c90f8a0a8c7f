import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from orebody.llm import linkage, naming, queries, survivors, variants
from orebody.llm.components import components


def slow_edits(a, b):
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            v = min(rows[-1][j] + 1, row[-1] + 1, rows[-1][j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, rows[-2][j - 2] + 1)
            row.append(v)
        rows.append(row)
    return rows[-1][-1]


def test_banded_distance_and_pigeonhole():
    rng = random.Random(1)
    for _ in range(3000):
        s = "".join(rng.choice("abc") for _ in range(rng.randint(4, 13)))
        t = list(s)
        for _ in range(rng.randint(0, 3)):
            p = rng.randrange(len(t))
            t[p : p + rng.randint(0, 1)] = rng.choice(["a", "b", "", "c"])
        t = "".join(t)
        for k in (2, 3):
            assert naming.edits(s, t, k) == min(slow_edits(s, t), k + 1)
        if len(t) >= 3 and naming.edits(s, t, 2) <= 2 and sorted(s) != sorted(t):
            long, short = (s, t) if len(s) >= len(t) else (t, s)
            plain = slow_edits(s, t)
            if plain <= 2 and not any(s[i : i + 2] == t[i : i + 2][::-1] and s[i] != s[i + 1] for i in range(min(len(s), len(t)) - 1)):
                assert not set(variants.probe_keys(long)).isdisjoint(variants.index_keys(short))


def test_segments_meet_across_swaps():
    a, b = "bokilickfavopack", "bokiilckfavopick"
    assert naming.edits(a, b, 2) == 2 and not set(variants.probe_keys(a)).isdisjoint(variants.index_keys(b))
    rng = random.Random(3)
    for _ in range(6000):
        s = [rng.choice("abcdefghij") for _ in range(rng.randint(8, 18))]
        t = list(s)
        for _ in range(rng.randint(1, 3)):
            p = rng.randrange(len(t) - 1)
            t[p : p + 2] = rng.choice([t[p : p + 2][::-1], t[p : p + 2][::-1], ["x", t[p + 1]], [t[p + 1]], ["x", *t[p : p + 2]]])
        long, short = sorted(("".join(s), "".join(t)), key=len, reverse=True)
        for k in (1, 2, 3):
            if naming.edits(long, short, k) <= k:
                assert not set(variants.probe_keys(long, k)).isdisjoint(variants.index_keys(short, k)), (long, short, k)
        if naming.edits(long, short, 1) <= 1:
            assert not set(variants.probe_keys(short, 1, 1)).isdisjoint(variants.index_keys(long, 1))


def test_segment_links_of_swaps_and_cut_forms(spark):
    forms = [("bokilickfavopack", ["bokilick", "favopack"], False), ("bokiilckfavopick", ["bokiilck", "favopick"], False), ("bokifavopak", ["boki", "favopak"], True),
             ("ecadgfhibjklm", ["ecadgfhibjklm"], False), ("ceadfghbijklm", ["ceadfghbijklm"], False)]
    schema = "form string, pieces array<string>, cut boolean, trade string"
    links = lambda *trades: {(r.a, r.b, r.distance) for r in variants.segment_links(spark.createDataFrame([(*f, t) for f in forms for t in trades], schema)).collect()}
    two = {("bokiilckfavopick", "bokilickfavopack", 2), ("bokifavopak", "bokilickfavopack", 1)}
    assert links(None) == two
    assert links("valve") == links("valve", "pump") == two | {("ceadfghbijklm", "ecadgfhibjklm", 3)}
    mixed = spark.createDataFrame([(*f, t) for f, t in zip(forms, ["valve", "pump", None, None, "pump"])], schema)
    assert {(r.a, r.b) for r in variants.segment_links(mixed).collect()} == {("bokifavopak", "bokilickfavopack")}
    assert variants.segment_links(mixed.limit(0)).isEmpty()


def test_links_against_brute_force(spark):
    rng = random.Random(11)
    forms = {}
    for _ in range(60):
        first = [rng.choice("abcdefgh") for _ in range(rng.randint(5, 16))]
        for _ in range(4):
            t = list(first)
            for _ in range(rng.randint(0, 3)):
                q = rng.randrange(len(t) - 1)
                t[q : q + 2] = rng.choice([t[q : q + 2][::-1], ["x", t[q + 1]], [t[q + 1]], ["x", *t[q : q + 2]]])
            forms.setdefault("".join(t), rng.choice(["valve", "pump", None]))
    df = spark.createDataFrame([(f, [f], False, t) for f, t in forms.items()], "form string, pieces array<string>, cut boolean, trade string")
    want = set()
    for a, b in combinations(sorted(forms), 2):
        n, s, t = min(len(a), len(b)), forms[a], forms[b]
        both = s is not None and s == t
        most = (3 if n >= 13 else 2) if both else 2 if s is None or t is None else 0
        if n < 8:
            most = 1 if both and n >= 4 and max(len(a), len(b)) <= 8 else 0
        if most and naming.edits(a, b, most) <= most:
            want.add((a, b))
    assert {(r.a, r.b) for r in variants.segment_links(df).collect()} == want and len(want) > 60


@pytest.mark.parametrize("name, words, trade", [
    (" D/B/A Firitack & Lubime (Pump Svcs), L.L.C. ", ("firitack", "lubime"), "pump"), ("Mech Contr., Soze.bekenim Co.", ("soze", "bekenim"), "mechanical"),
    ("tomozemfemaro.example", ("tomozemfemaro",), None), ("fopelux-tababir-group.example", ("fopelux", "tababir"), None),
    ("KolumethKemokond Instrument Int'l - Sainte-Foy", ("kolumeth", "kemokond"), "instrument"), ("Pump Services", (), "pump"), (None, (), None), ("  ", (), None),
])
def test_parse(name, words, trade):
    x = naming.parse(name)
    assert (x.words, x.trade) == (words, trade)


def test_variant_classes(spark):
    names = {
        "a": "Bokilick-Favopack Valve Company", "b": "FAVOPACK & BOKILCIK VALVE SUPPLY", "c": "Bokilickfavopack Ltd", "d": "Boki. Favopack Valve Sup.",
        "e": "Bokilick Nuzeke Valve Company", "f": "Tozonir Gipego Steel", "g": "Tozonir Gipegoo Boiler", "h": None, "i": "", "j": "Valve Supply Inc.",
        "k": "Bókilick + Favupack Valve",
    }
    rows = [(o, n, None, None, "x") for o, n in names.items()] * 2 + [(None, "Bokilick Favopack", None, None, "x")]
    df = spark.createDataFrame(rows, "owner string, name string, other string, site string, form string")
    classes = variants.variant_classes(df, "owner", "name", "other", "site")
    assert {(r.a, r.b) for r in variants.class_pairs(classes).collect()} == set(combinations("abcdk", 2))
    assert variants.variant_classes(df.limit(0), "owner", "name", "other", "site").count() == 0


def test_short_and_long_names(spark):
    names = {
        "a": "Apex Valve", "b": "APEX VALVES INC.", "c": "Apxe Valve Supply", "d": "Apxe Steel", "e": "Ab Valve", "f": "Ac Valve", "g": "AB Valves Ltd",
        "h": "Bokilick Favopack Nuzeke Tozonir Gipegolan Valve", "i": "Bokilick Favopack Nuzeke Tozonir Mifedarob Valve", "j": "Tozonir Pump", "k": "Tozonirr Pumps",
    }
    df = spark.createDataFrame([(o, n, None, None) for o, n in names.items()], "owner string, name string, other string, site string")
    pairs = {(r.a, r.b) for r in variants.class_pairs(variants.variant_classes(df, "owner", "name", "other", "site")).collect()}
    assert pairs == {*combinations("abcd", 2), ("e", "g"), ("j", "k")}  # c and d are of one form
    assert len(naming.parse(names["h"]).words) == 5


def test_order_numbers_and_single_letters(spark):
    names = {
        "a": "Bokilick Favopack Nuzekan Valve", "b": "Favopack Bokilick Nuzekan Valve Co", "c": "Nuzekan Bokilick Favopak Valves", "d": "Nuze. Favopack Bokilick Valve",
        "e": "Tozonirgan 66 Pump", "f": "Tozonirgan 99 Pump", "g": "TOZONIRGAN 66 PUMPS", "h": "Route 66 Steel", "i": "Route 99 Steel", "j": "Route 66 Stl.",
        "k": "B & K Valve", "l": "B and K Valves", "m": "K Valve",
    }
    df = spark.createDataFrame([(o, n, None, None) for o, n in names.items()], "owner string, name string, other string, site string")
    pairs = {(r.a, r.b) for r in variants.class_pairs(variants.variant_classes(df, "owner", "name", "other", "site")).collect()}
    assert pairs == {*combinations("abcd", 2), ("e", "g"), ("h", "j"), ("k", "l")}
    assert naming.parse("Joe's Valve").words == ("joe",)


def test_components(spark):
    links = spark.createDataFrame([(f"n{k:02}", f"n{k + 1:02}") for k in range(40)] + [("x", "y"), ("y", "x"), ("z", "z"), (None, "q")], "a string, b string")
    found = {r.node: r.component for r in components(links).collect()}
    assert found == {f"n{k:02}": "n00" for k in range(41)} | {"x": "x", "y": "x", "z": "z"}


RECORD = "source string, record_id string, name string, site string, link string, city string, region string"


def test_linkage(spark):
    rows = [
        ("exa", "a1", "Bokilick & Favopack Valve", "https://www.bokilickfavopack.example/", None, "Houston", "TX"),
        ("apify", "b1", "FAVOPACK BOKILCIK VALVE SUPPLY", None, "https://list.dir.example/r/1", "houston", "Texas"),
        ("apify", "b2", "Bokilick Favopack Valve", None, None, "Denver", None),
        ("exa", "a2", "Bokilick & Favopack Valve", "bokilickfavopack-co.example", None, "Denver", "Colorado"),
        ("apify", "b3", "Home", "http://shop.bokilickfavopack.example", None, "Tulsa", "OK"),
        ("apify", "b4", "Tozonir Gipego Steel", "ftp://tozonirgipego.example", None, None, None),
        ("exa", "a3", None, None, None, "Denver", "CO"),
        ("exa", "a4", "Tozonir-Gipego Stl", "https://list.dir.example/c/9", None, None, "ON"),
    ]
    rows += [("exa", f"d{k}", f"{x}bin {x}lor Pump", f"https://list.dir.example/c/{k}", None, "Denver", "CO") for k, x in enumerate(["Zora", "Mifi", "Kuve", "Dogo", "Pana", "Tuse"])]
    df = spark.createDataFrame(rows + rows[:2], RECORD)
    linked = linkage.link_records(df)
    pairs = {(r.record_id_a, r.record_id_b) for r in linkage.matches(linked, "exa", "apify").collect()}
    assert pairs == {("a1", "b1"), ("a2", "b2"), ("a1", "b3"), ("a4", "b4")}
    assert all(0.3 <= r.confidence <= 1 for r in linked.collect())
    assert "a3" not in {r.record_id for r in linked.collect()}
    assert linkage.link_records(df.limit(0)).count() == 0


TRUTH = "name_class string, owner string, region string, anchor string, up double, down double"


@pytest.mark.parametrize("weights, values", [
    ([(4, 0.3), (1, 0.3), (0.2, 2)], [0.715, 0.715, 0.545]), ([(9, 0.3), (0, 1.5), (0, 1.5), (0, 1.5)], [0.860, 0.222, 0.222, 0.222]),
])
def test_solver_on_one_region(spark, weights, values):
    truths = spark.createDataFrame([("c", f"o{k}", "r", "s", float(u), float(d)) for k, (u, d) in enumerate(weights)], TRUTH)
    found = [r.value for r in linkage.solve(truths).orderBy("owner").collect()]
    assert found == pytest.approx(values, abs=3e-3)


def hinges(rows, x):
    """The least sum of all hinges for given truths: the regions' own truths stand where they cost least."""
    cost = sum(u / 2 * max(0, 1 - v) ** 2 + d / 2 * max(0, v) ** 2 for (*_, u, d), v in zip(rows, x))
    groups = {}
    for (c, _, r, s, *_), v in zip(rows, x):
        if r is not None:
            groups.setdefault((c, r), {}).setdefault(s, []).append(v)
    for sites in groups.values():
        if len(sites) == 1:
            cost += min(sum(abs(v - z) for v in vs) for vs in sites.values() for z in vs)
        else:
            grid = [k / 200 for k in range(201)]
            (a, b) = sites.values()
            cost += min(sum(abs(v - z) for v in a) + sum(abs(v - y) for v in b) for z in grid for y in [min([q for q in grid if q <= 1 - z + 1e-9], key=lambda q: sum(abs(v - q) for v in b))])
    return cost


def test_solver_is_at_the_minimum(spark):
    rng = random.Random(8)
    rows = []
    for c in range(6):
        for o in range(3):
            region = rng.choice(["r", "q", None])
            for s in ("s", "t")[: rng.randint(1, 2)]:
                rows.append((f"c{c}", f"o{o}", region, s, rng.choice([0.0, 1.0, 4.0]), rng.choice([0.3, 1.5])))
    solved = {tuple(r[:4]): r.value for r in linkage.solve(spark.createDataFrame(rows, TRUTH)).collect()}
    assert len(solved) == len(rows)
    for c in range(6):
        mine = [r for r in rows if r[0] == f"c{c}"]
        x = [solved[r[:4]] for r in mine]
        least = hinges(mine, x)
        for o in {r[1] for r in mine}:
            assert sum(v for r, v in zip(mine, x) if r[1] == o) <= 1 + 5e-3
        for _ in range(300):
            y = [min(1, max(0, v + rng.gauss(0, rng.choice([0.02, 0.2])))) for v in x]
            if all(sum(v for r, v in zip(mine, y) if r[1] == o) <= 1 for o in {r[1] for r in mine}):
                assert hinges(mine, y) >= least - 0.02


def test_large_classes_are_solved_alike(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(f"c{c}", f"o{o}", rng.choice(["r", None]), s, rng.choice([0.0, 1.0, 4.0]), 0.3) for c in range(3) for o in range(3) for s in "st"]
    rows = [(c, o, {"o0": "r", "o1": "r", "o2": None}[o], s, u, d) for c, o, _, s, u, d in rows]
    truths = spark.createDataFrame(rows, TRUTH)
    whole = {tuple(r[:4]): r.value for r in linkage.solve(truths).collect()}
    monkeypatch.setattr(linkage, "WHOLE_CLASS", 2)
    monkeypatch.setattr(linkage, "TOLERANCE", 1e-3)  # fewer rounds of windows
    spread = {tuple(r[:4]): r.value for r in linkage.solve(truths).collect()}
    assert whole.keys() == spread.keys() and all(abs(whole[k] - spread[k]) < 1e-2 for k in whole)
    monkeypatch.setattr(linkage, "WHOLE_CLASS", 100)
    monkeypatch.setattr(linkage, "TOGETHER", 3)
    parts = {tuple(r[:4]): r.value for r in linkage.solve(truths).collect()}
    assert all(abs(whole[k] - parts[k]) < 2e-3 for k in whole)
    monkeypatch.setattr(linkage, "ROUNDS", 1)
    one = np.zeros(1, np.int64)
    with pytest.raises(RuntimeError, match="still move"):
        linkage._settle(one, one, one, np.full(1, 4.0), np.ones(1))


def test_survive(spark):
    schema = "company_id string, snapshot_id bigint, domain string, places array<string>, updated_at string, field_name string"
    rows = [
        ("c", 1, "a.example", ["X ", "x", "", None], "2025-01-01T00:00:00Z", "q"), ("c", 2, "n/a", ["x", "y"], "2025-01-01T02:00:00+03:00", "q"),
        ("c", 3, "b.example\n", None, None, "q"), ("c", 4, "b.example", ["y", "z"], "2025-01-01T00:00:00+00:00", "q"), ("c", 4, "b.example", ["y", "z"], "2025-01-01T00:00:00+00:00", "q"),
        ("d", 9, "d.example", ["x"], None, "q"), (None, 5, "e.example", [], None, "q"), ("e", 6, "-", [], None, "q"), ("e", 7, None, None, None, "q"),
    ]
    df = spark.createDataFrame(rows, schema)
    n = survivors.filled(F.col("places"), fold=True)
    fields = {"domain": survivors.Survival(F.when(F.col("domain").rlike(r"^[a-z.]+\z"), 1)), "places": survivors.Survival(F.when(n > 0, n))}
    args = ("company_id", "snapshot_id", survivors.instant(F.col("updated_at")), fields)
    assert {tuple(r) for r in survivors.survive(df, *args).collect()} == {("c", "domain", 4), ("c", "places", 4)}
    assert survivors.survive(df.limit(0), *args).count() == 0
    assert {tuple(r) for r in survivors.survive(df, *args, least_rows=1).collect()} >= {("d", "domain", 9)}


def test_truth_discovery(spark, monkeypatch):
    rng = random.Random(2)
    claims, truth = [], {}
    for e in range(80):
        truth[str(e)] = "t"
        for source, right in (("good", 0.95), ("fair", 0.9), ("bad1", 0.2), ("bad2", 0.2), ("bad3", 0.2)):
            claims.append((str(e), "f", "t" if rng.random() < right else rng.choice("xy"), source))
    claims += claims[:5] + [(None, "f", "t", "good"), ("0", "f", None, "good"), ("0", "f", "t", None)]
    df = spark.createDataFrame(claims, "entity string, field string, value string, source string")
    found = {r.entity: r.value for r in survivors.discover_truth(df).collect()}
    assert sum(found[e] == "t" for e in truth) >= 74 and len(found) == 80
    assert survivors.discover_truth(df.limit(0)).count() == 0
    exact = {tuple(r)[:3]: r.confidence for r in survivors.discover_truth(df).collect()}
    for name in ("CLAIMS_TOGETHER", "SOURCES_TOGETHER"):  # spread over values, and joined
        monkeypatch.setattr(survivors, name, 2)
        assert {tuple(r)[:3]: pytest.approx(r.confidence) for r in survivors.discover_truth(df).collect()} == exact
    with pytest.raises(RuntimeError, match="still move"):
        survivors.discover_truth(df, tolerance=0.0, rounds=2)


def test_truth_of_every_dealt_field(spark, tmp_path):
    schema = "company_id string, run_id string, domain string, country string, locations_if_known array<string>, discovery_records array<struct<record_id: string>>"
    rows = [
        ("c", "r1", "a.example", "US", ["X"], [("b ",), ("a",), ("a",), (" ",), (None,)]), ("c", "r2", "a.example", "US", ["x"], [("a",), ("b",)]),
        ("c", "r3", "a.example", "US", ["x"], [("z",)]), ("d", "r1", None, None, None, None), ("d", "r2", None, None, [], []),
    ]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "company_records.parquet"))
    found = {(r.company_id, r.field_name): r.value for r in queries.p5_truth(spark, str(tmp_path)).collect()}
    assert found == {("c", "discovery_records"): "a|b", ("c", "domain"): "a.example", ("c", "country"): "US", ("c", "locations_if_known"): "x"}
