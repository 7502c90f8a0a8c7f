import random

import pytest

from orebody.llm import canonical, encode, mojibake, pii, wordruns

REFERENCE = [
    (1, "Owner"), (8, "Branch Manager"), (10, "Estimator"), (11, "Buyer"), (14, "Controller"), (17, "Inside Sales Manager"),
    (34, "Operations Coordinator"), (45, "Vice President of Warehouse"), (46, "Director of Warehouse"), (51, "Director of Quality Assurance"),
]


@pytest.fixture(scope="module")
def matcher():
    return canonical.Matcher(canonical.title_aliases(REFERENCE))


@pytest.mark.parametrize("value, entry", [
    ("  BRANCH   MGR. ", 8), ("Mgr, Branch", 8), ("Directeur de succursale - Houston", 8), ("V.P., W/house (Canada)", 45), ("vice presdient of warehouse", 45),
    ("Dir\xa0of\xa0QA", 51), ("Buyer (MRO)", 11), ("buyre", 11), ("Co-ordinator Ops [acting]", 34), ("Owner & Founder | Valves", 1),
    ("buyer ohio", 11), ("Part-time Buyer", 11), ("Acting Branch Manager since 2019", 8), ("Owner New Jersey", 1), ("Byuer, night shift", 11), ("Night Porter", -1),
    ("Directr of Qualty Asurance and other things that were typd badly " + "inn teh longst of valeus" * 30, -1), ("Directr of Qualty Asurance, " + "inn teh longst of valeus " * 30, 51),
    ("Air Traffic Controller", -1), ("Film Director", -1), ("Certified Funeral Director at large", -1), ("???", -1), ("", -1), (None, -1), ("x" * 20_000, -1),
])
def test_titles(matcher, value, entry):
    assert matcher.match(value) == entry


def test_map_values_cases(spark):
    rows = spark.createDataFrame([("Owner", 1), ("owner.", 2), ("owner.", 2), (" ", 3), (None, 4), ("Poet", 5)], "title string, entry_id_2 int")
    out = canonical.map_values(rows, "title", REFERENCE, canonical.title_aliases(REFERENCE))
    assert sorted((r.entry_id_2, r.entry_id) for r in out.collect() if r.entry_id is not None) == [(1, 1), (2, 1), (2, 1), (5, -1)]
    assert out.filter("entry_id IS NULL").count() == 2
    assert canonical.map_values(rows.limit(0), "title", REFERENCE, {}).count() == 0
    with pytest.raises(ValueError):
        canonical.map_values(rows.withColumnRenamed("entry_id_2", "entry_id"), "title", REFERENCE, {})


@pytest.mark.parametrize("legacy", ["cp1252", "cp1250", "cp1251", "mac_roman", "cp437"])
def test_utf8_round_trip(legacy):
    text = "L’équipe prépare près de 12 pièces à Montréal; señal más rápida, größere Bögen – 20 °C."
    garbled = "".join(bytes([b]).decode(legacy, "ignore") or chr(b) for b in text.encode("utf-8"))
    fixed, undone, lost = mojibake.repair(garbled)
    assert fixed == text and undone and not lost


def test_layers_and_single_byte():
    text = "Le préposé vérifie où la forêt était « déjà »"
    for _ in range(3):
        text = text.encode("utf-8").decode("cp1252", "ignore") if False else "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in text.encode("utf-8"))
    assert mojibake.repair(text)[0] == "Le préposé vérifie où la forêt était « déjà »"
    assert mojibake.repair("La société emploie".encode("cp1252").decode("mac_roman"))[0] == "La société emploie"
    assert mojibake.repair("hдufig ohne MaЯangabe")[0] == "häufig ohne Maßangabe"
    assert mojibake.repair("L�essai") == ("L�essai", [], True)


@pytest.mark.parametrize("text", [
    None, "", "plain", "PRODUÇÃO E DISTRIBUIÇÃO", "ÂGE DU RÉSEAU", "façade Ã‑type", "Файл № 77 приложен. ", "仕様書は 12 枚", "la ñ 291", "12½ N·m, 1×14, § 5", "»Spaß« ™ ® ©",
    "see note ‡ below", "the letter я in Russian", "côte·à·côte", "la col·lecció de vàlvules", "de 20 ∞ à l’infini", "• voir ‡ – côté « nord »",
])
def test_clean_text_stays(text):
    assert mojibake.repair(text) == (text, [], False)


def test_signs_are_read_with_their_line():
    text = "Según la dirección – “nadie” cerrará la válvula a 128 °F; más rápido, ¡atención!"
    assert mojibake.repair(text.encode("cp1252").decode("mac_roman")) == (text, ["mac_roman>cp1252"], False)


def test_repair_rows(spark):
    rows = spark.createDataFrame([(1, "sociÃ©tÃ©", 9), (2, None, 9), (3, "", 9), (4, "ok é", 9), (1, "sociÃ©tÃ©", 9)], "doc_id bigint, text string, repaired int")
    assert sorted((r.doc_id, r.repaired) for r in mojibake.repair_texts(rows).collect()) == [(1, "société"), (1, "société")]
    assert mojibake.repair_texts(rows.limit(0)).count() == 0


def test_encoding_equals_library(spark):
    tiktoken = pytest.importorskip("tiktoken")
    path = f"{encode.TOKENIZERS}/byte_bpe_50k.tiktoken"
    ranks = encode.read_ranks(path)
    library = tiktoken.Encoding("own", pat_str=encode.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcdeéñ 0123,.'\n世😀ab") for _ in range(rng.randrange(80))) for _ in range(300)] + ["", None, "a" * 3000, " " * 500, "<|endoftext|>"]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    out = {r.doc_id: r.ids for r in encode.encode_texts(rows).collect()}
    assert out == {k: library.encode_ordinary(t or "") for k, t in enumerate(texts)}
    assert all(library.decode(out[k]) == (t or "") for k, t in enumerate(texts))


def test_words_and_alignment():
    assert wordruns.words("Ｆoo­bar, Ⅻ x²_é") == ["foobar", "xii", "x2", "é"]
    assert wordruns.words(None) == [] == wordruns.words(" ¡! ")
    a, b = "one two three four five six".split(), "zero one two four five six".split()
    assert wordruns.align(a, b) == (9, 3)
    assert wordruns.align(a, []) == (0, 0)


def test_leaks_against_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(40)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(30))) for k in range(6)] + [(9, "too short"), (10, None)]
    docs = [(k, " ".join(rng.choice(vocabulary) for _ in range(50))) for k in range(20)] + [(90, None), (91, "")]
    for k in range(20, 40):
        ws, n = items[k % 6][1].split(), rng.randrange(8, 16)
        docs.append((k, f"x y {', '.join(ws[3 : 3 + n]).upper()}! z"))
    frames = spark.createDataFrame(docs + docs[-1:], "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    runs = lambda t: {tuple(ws[i : i + 12]) for ws in [wordruns.words(t)] for i in range(len(ws) - 11)}
    grams = {k: runs(t) for k, t in items}
    want = {(d, k) for d, t in docs for k, g in grams.items() if g & runs(t)}
    found = wordruns.leaks(*frames)
    assert {(r.doc_id, r.item_id) for r in found.collect() if r.run >= 12} == want and want
    assert {(r.doc_id, r.item_id) for r in wordruns.leaks(*frames, edited=False).collect() if r.run >= 12} == want
    assert wordruns.leaks(frames[0].limit(0), frames[1]).count() == 0
    assert wordruns.leaks(frames[0].limit(0), frames[1], edited=False).count() == 0
    assert wordruns.leaks(frames[0], frames[1].limit(0)).count() == 0


def test_edited_copies_are_leaks(spark):
    item = [f"w{k}" for k in range(60)]
    copy = [f"changed{k}" if k % 10 == 9 else w for k, w in enumerate(item)]
    docs = spark.createDataFrame([(1, " ".join(["before", *copy, "after"])), (2, " ".join(item[:4] + ["x"] + item[5:9]))], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, " ".join(item))], "item_id bigint, text string")
    # A rarer passage of the same item in another document must not draw the seeds away.
    more = spark.createDataFrame([(3, " ".join(item[20:27])), (4, " ".join(copy)), (5, " ".join(copy))], "doc_id bigint, text string")
    found = {r.doc_id: (r.item_id, r.score, r.item_words, r.run) for r in wordruns.leaks(docs.union(more), items).collect()}
    assert found == {1: (7, 103, 60, 9), 3: (7, 14, 60, 7), 4: (7, 103, 60, 9), 5: (7, 103, 60, 9)}
    literal = wordruns.leaks(docs.union(more), items, edited=False)
    assert {r.doc_id for r in literal.collect() if r.run >= 12} == set()


@pytest.mark.parametrize("rate", [0.05, 0.1, 0.2])
def test_recall_of_edited_copies(spark, rate):
    rng = random.Random(int(rate * 100))
    word = lambda: rng.choice("valve pipe pump the of and order steel quote crew dock field".split()) + rng.choice(["", "s", "ed", str(rng.randrange(50))])
    items = [(k, [word() for _ in range(60)]) for k in range(40)]
    docs = []
    for k, ws in items:
        for n in range(3):
            copy = [e for w in ws for e in ([w] if rng.random() >= rate else rng.choice([[word()], [], [w, word()]]))]
            docs.append((k * 10 + n, " ".join([*(word() for _ in range(30)), *copy, *(word() for _ in range(30))])))
    frames = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(k, " ".join(ws)) for k, ws in items], "item_id bigint, text string")
    found = {r.doc_id for r in wordruns.leaks(*frames).collect() if r.item_id == r.doc_id // 10 and r.score >= r.item_words}
    assert len(found) >= 0.9 * len(docs)


def test_very_long_texts(spark):
    item = [f"w{k}" for k in range(60)]
    docs = spark.createDataFrame([(1, " ".join(["x"] * 50_000 + item + ["a"] * 50_000)), (2, "a " * 50_000), (3, "w1" * 50_000)], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, " ".join(item)), (8, "a a a a a a")], "item_id bigint, text string")
    assert {(r.doc_id, r.item_id, r.run) for r in wordruns.leaks(docs, items).collect()} == {(1, 7, 60), (1, 8, 6), (2, 8, 6)}
    long = "é" * 50_000 + " société" * 5_000
    garbled = long.encode("utf-8").decode("cp1252", "ignore")
    assert mojibake.repair(long)[1:] == ([], False) and mojibake.repair("ok é " * 20_000 + "sociÃ©tÃ©")[0].endswith(" société") and len(garbled) > len(long)


def test_items_in_blocks(spark, monkeypatch):
    docs = spark.createDataFrame([(k, " ".join(f"w{i}" for i in range(k, k + 30))) for k in range(12)], "doc_id bigint, text string")
    items = docs.toDF("item_id", "text")
    whole = {tuple(r) for r in wordruns.leaks(docs, items).collect()}
    monkeypatch.setattr(wordruns, "CHARACTERS_AT_ONCE", 400)
    assert {tuple(r) for r in wordruns.leaks(docs, items).collect()} == whole


NAMES = pii.Names(frozenset({"howard", "elise", "daniel"}), frozenset({"kestovic", "silverin"}))


@pytest.mark.parametrize("text, kinds", [
    ("write to a.b+c@mail.example or sales AT post DOT example DOT org", {"email"}), ("jorge [at] mail.example. Next", {"email"}),
    ("Call (604) 555-0140 ext. 3", {"phone"}), ("… 4125550194 …", {"phone"}), ("Torque 829-879-4860 in three passes; order 3666306366", set()),
    ("SSN 924 64 7037", {"id_number"}), ("his social, 946-54-9493, and", {"id_number"}), ("Part no. 348-37-4797", set()), ("passport no. XA577197", {"id_number"}),
    ("at 2394, avenue Belcastre, app. 3", {"street_address"}), ("850 HARROWGATE LOOP PKWY", {"street_address"}), ("Highway 294 at exit 54", set()),
    ("Ask for Howard Kestovic", {"person_name"}), ("Kestovic, Élise", {"person_name"}), ("signed É. Silverin", {"person_name"}), ("Mme Quenstrand", {"person_name"}),
    ("model Daniel 9439", set()), ("Daniel Silverin Valve Supply", set()), ("Howard.Kestovic@mail.example", {"email"}), (None, set()), ("", set()), ("7" * 50_000, set()),
])
def test_pii_kinds(text, kinds):
    assert {x.kind for x in pii.spans(text, NAMES)} == kinds


@pytest.mark.parametrize("text, kinds", [
    ("on file: 524-37-4797", {"id_number"}), ("on file: 666-37-4797", set()), ("on file: 000-12-3456", set()), ("Order no. 524-37-4797", set()),
    ("on file: 130 692 544", {"id_number"}), ("on file: 130 692 545", set()), ("dossier 1 85 05 78 006 084 91", {"id_number"}), ("dossier 1 85 05 78 006 084 92", set()),
    ("SSN 666 64 7037", {"id_number"}), ("rappelez le +33 1 23 45 67 89", {"phone"}), ("WhatsApp +52 55 1234 5678", {"phone"}), ("grew by +52 55", set()), ("Torque +49 1234 5678", set()), ("Ask for Howard Unheard today", {"person_name"}), ("Contact Elise Unheard.", {"person_name"}), ("Ask for Howard Valve", set()),
    ("valves for Howard County", set()), ("Contact Daniel Brand Supply", set()),
])
def test_checks_decide_on_unlabelled_numbers_and_unknown_family_names(text, kinds):
    assert {x.kind for x in pii.spans(text, NAMES)} == kinds


def test_redaction_and_checks(spark):
    rows = spark.createDataFrame([("r", "Howard Kestovic: 604-555-0140.", "k"), ("r", "Howard Kestovic: 604-555-0140.", "k"), ("s", None, "k"), (None, "a@b.example", "k")], "id string, t string, kinds string")
    out = {(r.row_id, r.redacted) for r in pii.find_personal(rows, "id", "t", NAMES).collect()}
    assert out == {("r", "[PERSON_NAME]: [PHONE]."), (None, "[EMAIL]")}
    assert pii.find_personal(rows.limit(0), "id", "t", NAMES).count() == 0
    assert pii.luhn("046454286") and not pii.luhn("046454287")
    people = spark.createDataFrame([("Ana Ruiz",), ("Ana  Ruiz, PE",), ("X",), (None,)], "n string")
    assert pii.known_names(people, "n") == pii.Names(frozenset({"ana"}), frozenset({"ruiz"}))


def test_no_name_is_left_out(spark, monkeypatch):
    people = spark.createDataFrame([("Ana Ruiz",), ("Ana Ruiz",), ("Tove Ekdal",), ("Bo Li",), ("J. Q",)], "n string")
    few = pii.known_names(people, "n")
    assert few == pii.Names(frozenset({"ana", "tove", "bo"}), frozenset({"ruiz", "ekdal", "li"}))
    monkeypatch.setattr(pii, "LISTED_NAMES", 3)
    many = pii.known_names(people, "n")
    assert "ana" in many.given and "ruiz" not in many.given and "li" in many.family and not many.family.isdisjoint({"x", "ekdal"}) and many.family.isdisjoint({"ana"})
    for text in ("Ask for Tove Ekdal", "Bo Li called", "Ana Ekdal", "Contact Bo Unheard", "the Ruiz Valve Company"):
        assert pii.spans(text, few) == pii.spans(text, many)
    rows = spark.createDataFrame([("r", "Bo Li called")], "id string, t string")
    assert [r.redacted for r in pii.find_personal(rows, "id", "t", many).collect()] == ["[PERSON_NAME] called"]
    monkeypatch.setattr(pii, "MOST_NAMES", 3)
    with pytest.raises(ValueError):
        pii.known_names(people, "n")
