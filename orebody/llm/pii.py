"""Personal information in free text: patterns propose spans, validators confirm them, neighbouring words adjust the score."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

KINDS = ("email", "phone", "id_number", "street_address", "person_name")
THRESHOLD = 0.6
# Name tokens up to which tasks hold them as words, beyond it as hashes of eight bytes, and the most that they hold: a
# larger table of names is refused rather than cut.
LISTED_NAMES, MOST_NAMES = 200_000, 8_000_000

# ---- validators ----------------------------------------------------------------------------------------------------


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def national_number(digits: str, grouped: str) -> float:
    """How sure digits without a label are a number of social security, insurance or tax, by how they are grouped:
    3-2-4 by area, group and serial, 3-3-3 by the check digit, the 15 of France by their key of mod 97."""
    if grouped == "324":
        area, group, serial = digits[:3], digits[3:5], digits[5:]
        taxpayer = area[0] == "9" and group[0] in "56789"
        return 0.6 if area not in ("000", "666") and (area[0] != "9" or taxpayer) and group != "00" and serial != "0000" else 0.0
    if grouped == "333":
        return 0.6 if luhn(digits) and digits[0] not in "08" else 0.0
    return 0.7 if (int(digits[:13]) + int(digits[13:])) % 97 == 0 else 0.0


def dialled(digits: str) -> float:
    """How sure ten digits are a North American number; the range kept for fiction is one that only telephones use."""
    if len(digits) == 11 and digits[0] == "1":
        digits = digits[1:]
    if len(digits) != 10 or digits[0] in "01" or digits[3] in "01":
        return -1.0
    return 0.3 if digits[3:8] == "55501" else 0.0


# ---- patterns ------------------------------------------------------------------------------------------------------

_SEP = r"[-. / ‐-―]"
_EMAIL = re.compile(r"(?:mailto:)?[\w.+'%-]+(?:@|＠|%40)(?:[\w-]+\.)+[^\W\d_]{2,}|(?:mailto:)?[\w.+'%-]+@[\w-]+\b(?=\s*\[?\(?dot)", re.I)
_SPELT = re.compile(
    r"[\w.+'-]+\s*(?:[\[({<]\s*(?:at|@|arobase|arroba|chez)\s*[\])}>]|\s(?:AT|arobase|arroba)\s|\sat\s(?=[\w-]+\s*(?:[\[({<]\s*(?:dot|point|punto)|\s(?:dot|point|punto)\s)))\s*"
    r"[\w-]+(?:\s*(?:[\[({<]\s*(?:dot|point|punto|\.)\s*[\])}>]\s*|\s(?:dot|DOT|point|punto)\s|\.)[\w-]+)+"
)
_PHONE = re.compile(rf"(?<![\w.,/-])(?:tel:)?(?:\+?1{_SEP}?)?(?:\([2-9]\d\d\)\s?|[2-9]\d\d{_SEP}?)[2-9]\d\d{_SEP}?\d{{4}}(?:\s*(?:ext\.?|x|poste|extension)\s*\d+)?(?![\w-]|[.,/]\d)", re.I)
_ABROAD = re.compile(r"(?<![\w.,/-])(?:tel:)?\+(?!1\b)[2-9]\d{0,2}(?:[ .\u2010-\u2015-]?\(?\d{1,4}\)?){2,7}(?![\w-]|[.,/]\d)")
_ID = re.compile(
    r"(?<!\w)(?:S\.?S\.?N\.?|S\.?I\.?N\.?|N\.?A\.?S\.?|SS\#|I\.?T\.?I\.?N\.?|T\.?I\.?N\.?|N\.?I\.?[FE]\.?|D\.?N\.?I\.?|C\.?U\.?R\.?P\.?|DL\#?"
    r"|(?i:social(?:\s+(?:security|insurance))?|assurance\s+sociale|seguro\s+social|seguridad\s+social|tax\s?payer|taxpayer\s+id|contribua\w+|contribuyente"
    r"|driv\w+(?:['’]s)?\s+licen[cs]e|permis\s+de\s+conduire|licencia\s+de\s+(?:conducir|manejo)|passport|passeport|pasaporte))"
    r"(?:\s*(?i:no\.?|n[o°º]\.?|number|num[ée]ro|n[úu]mero|num\.?|id|card|is|est|es|\#|:|,|\(|\.))*\s*"
    r"(?P<value>(?:[A-Z]{1,3}[- ]?)?\d[\d -]{4,14}\d|[A-Z]{1,4}\d{6,}[A-Z0-9]*)"
)
_BARE = re.compile(
    r"(?<![\w.,/#-])(?:(?P<g324>\d{3}(?P<s>[- \u2010-\u2015])\d\d(?P=s)\d{4})|(?P<g333>\d{3}(?P<t>[- \u2010-\u2015])\d{3}(?P=t)\d{3})"
    r"|(?P<g15>[12] ?\d\d ?(?:0[1-9]|1[0-2]) ?\d\d ?\d{3} ?\d{3} ?\d\d))(?![\w-]|[.,/ ]\d)"
)
_STREET = (
    r"(?:street|str?|avenue|ave?|road|rd|drive|dr|lane|ln|boulevard|blvd|court|ct|crt|way|parkway|pkwy|place|pl|terrace|ter|circle|cir|highway|hwy|square|sq|trail|trl|crescent|cres|loop|row|alley|plaza|close|mews|walk)"
)
_CAPITAL = r"(?:St\.|Ste\.|[A-ZÀ-ÖØ-Þ][\w'’-]*)"
_ADDRESS = re.compile(
    rf"(?<![\w.#/-])\d{{1,5}}[A-Za-z]?\s(?:(?:N|S|E|W|NE|NW|SE|SW|North|South|East|West|Nord|Sud|Est|Ouest)\.?\s)?(?:{_CAPITAL}\s){{1,4}}?(?i:{_STREET})\b\.?(?:\s(?:N|S|E|W|NE|NW|SE|SW)\b\.?)?"
)
_RUE = re.compile(
    rf"(?<![\w.#/-])\d{{1,5}}(?:\s?bis)?,?\s(?i:rue|avenue|av\.|boul\.|boulevard|bd|chemin|ch\.|place|all[ée]e|impasse|route|rang|quai|cours|mont[ée]e)\s(?:(?:de\sla|de\sl['’]|de|du|des|d['’]|l['’]|la|le)\s?)?{_CAPITAL}(?:[ -]{_CAPITAL}){{0,3}}"
)
_CALLE = re.compile(rf"(?<!\w)(?i:calle|avenida|av\.|avda\.|carrera|paseo|camino|calzada|plaza|bulevar)\s(?:(?:de\slas?|de\slos|del|de|la|las|los)\s)?{_CAPITAL}(?:\s{_CAPITAL}){{0,3}},?\s(?:(?i:n[.°º]*|núm\.?|no\.?|\#)\s?)?\d{{1,5}}\b")
_UNIT = re.compile(r",?\s(?:(?i:suite|ste|unit|apt|app|bureau|office|floor|piso|depto)\b\.?\s?\w+|#\s?\w+)")
_NAME_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")

# Words that, close before or after a span, make its kind more or less likely.
_MORE = {
    "phone": "call tel tél téléphone telephone phone phones cell mobile fax ring rings number numéro número desk contact dial whatsapp sms text answers llamar teléfono appelez joindre reach reached ext".split(),
}
_LESS = {
    "phone": "map torque order ticket heat sku lot part drawing invoice build bin model schedule serial quote weld pages rated cas item".split(),
    "id_number": "map torque order ticket heat sku lot part parts drawing invoice build bin model schedule serial quote weld pages rated cas item po ref reference catalog stock pièce commande référence facture pieza pedido factura".split(),
}
# Words before a known given name after which the next word is a name too, though no known one.
_PERSON = frozenset("contact attn attention dear signed foreman estimator buyer owner president manager engineer recruiter supervisor technician".split())
# Titles before a name.
_TITLES = frozenset("mr mrs ms miss dr prof mme mlle sr sra srta".split())
# What follows a name that belongs to a thing or a company.
_THINGS = frozenset(
    "inc ltd llc corp co company corporation limited valve valves pipe steel supply distribution equipment fittings pump pumps type brand model gasket coupling street avenue road drive"
    " instrument controls systems services group contractors manufacturing".split()
)


@dataclass(frozen=True)
class Span:
    start: int
    end: int
    kind: str


class Hashed:
    """A set of words held as sorted hashes; a word that is none of them is taken for one about once in 10 to the 12."""

    def __init__(self, words: Iterable[str]) -> None:
        self.held = np.unique(np.fromiter(map(xxh64_intdigest, words), np.uint64))

    def __contains__(self, word: str) -> bool:
        key = np.uint64(xxh64_intdigest(word))
        at = np.searchsorted(self.held, key)
        return bool(at < len(self.held) and self.held[at] == key)

    def isdisjoint(self, words: Iterable[str]) -> bool:
        return not any(w in self for w in words)


@dataclass(frozen=True)
class Names:
    """Folded name tokens: those that stand first and those that stand last in known names of people."""

    given: frozenset[str] | Hashed
    family: frozenset[str] | Hashed


def fold(word: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", word.casefold()) if not unicodedata.combining(c))


_DIGIT = re.compile(r"\D")
_WORDS = re.compile(r"[^\W\d_]+")


_STOP = re.compile(r"[.!?;…•*]+(?:\s|$)|[/|–—→\n]")


def _around(text: str, start: int, end: int, words: Iterable[str]) -> bool:
    """Whether the last three words before the span or the first after it, within its sentence, are among those given."""
    before, after = _STOP.split(text[max(0, start - 30) : start])[-1], _STOP.split(text[end : end + 14])[0]
    near = {w.lower() for w in _WORDS.findall(before)[-3:]} | {w.lower() for w in _WORDS.findall(after)[:1]}
    return not near.isdisjoint(words)


def _emails(text: str) -> Iterator[Span]:
    if "@" in text or "＠" in text or "%40" in text:
        for m in _EMAIL.finditer(text):
            yield Span(m.start(), m.end(), "email")
    low = text.lower()
    if "dot" in low or "[at" in low or "(at" in low or " AT " in text or "arobase" in low or "arroba" in low or "{at" in low or "<at" in low or "point" in low or "punto" in low:
        for m in _SPELT.finditer(text):
            tail = re.split(r"[^\w-]+", m.group())[-1]
            if 2 <= len(tail) <= 10 and tail.isalpha():
                yield Span(m.start(), m.end(), "email")


def _phones(text: str) -> Iterator[Span]:
    for m in _PHONE.finditer(text):
        run = re.split(r"(?i)\s*(?:ext|x|poste)", m.group())[0]
        score = 0.5 if not run.isdigit() else 0.35
        score += dialled(_DIGIT.sub("", run))
        if m.group().lower().startswith(("tel:", "+")) or len(run) < len(m.group()):
            score += 0.2
        score += 0.3 * _around(text, m.start(), m.end(), _MORE["phone"]) - 0.4 * _around(text, m.start(), m.end(), _LESS["phone"])
        if score >= THRESHOLD:
            yield Span(m.start(), m.end(), "phone")


def _phones_abroad(text: str) -> Iterator[Span]:
    """Numbers with the code of a country other than North America's: seven to thirteen digits behind it, of at most fifteen."""
    if "+" not in text:
        return
    for m in _ABROAD.finditer(text):
        score = 0.7 if 9 <= len(_DIGIT.sub("", m.group())) <= 15 else 0.0
        if score - 0.4 * _around(text, m.start(), m.end(), _LESS["phone"]) >= THRESHOLD:
            yield Span(m.start(), m.end(), "phone")


def _ids(text: str) -> Iterator[Span]:
    for m in _ID.finditer(text):
        value, label = m.group("value").strip(" -"), m.group()[: m.start("value") - m.start()].strip().lower()
        digits = _DIGIT.sub("", value)
        score = 0.6  # the label confirms: such numbers need not pass official checks (TESTDATA.md)
        if len(digits) < 6 or label in ("sin", "nas", "es") and not m.group()[:1].isupper():
            score = 0.0
        if score >= THRESHOLD:
            start = m.start("value")
            yield Span(start, start + len(value), "id_number")


def _bare_ids(text: str) -> Iterator[Span]:
    """Grouped numbers without a label, if they pass their check and no word before says that they number a thing."""
    for m in _BARE.finditer(text):
        score = national_number(_DIGIT.sub("", m.group()), "324" if m["g324"] else "333" if m["g333"] else "15")
        before = [w.lower() for w in _WORDS.findall(text[max(0, m.start() - 30) : m.start()])[-3:]]
        if score - 0.4 * (not set(before).isdisjoint(_LESS["id_number"])) >= THRESHOLD:
            yield Span(m.start(), m.end(), "id_number")


def _streets(text: str) -> Iterator[Span]:
    for pattern in (_ADDRESS, _RUE, _CALLE):
        for m in pattern.finditer(text):
            unit = _UNIT.match(text, m.end())
            yield Span(m.start(), unit.end() if unit else m.end(), "street_address")


def _people(text: str, names: Names) -> Iterator[Span]:
    """Given and family name in either order, initials with a family name, titles with a name; a known given name with
    an unknown word counts where no word of trade follows and the word before speaks of a person."""
    words = [(m.start(), m.end(), m.group(), fold(m.group())) for m in _NAME_WORD.finditer(text)]
    family = lambda w: w in names.family or "-" in w and all(p in names.family for p in w.split("-"))
    k = 0
    while k < len(words):
        s, e, w, f = words[k]
        if not w[0].isupper():
            k += 1
            continue
        nxt = words[k + 1] if k + 1 < len(words) else None
        far = words[k + 2] if k + 2 < len(words) else None
        gap = text[e : nxt[0]] if nxt else ""
        gap2 = text[nxt[1] : far[0]] if nxt and far else ""
        found = None
        if nxt and nxt[2][0].isupper():
            thing = bool(far) and far[3] in _THINGS and far[2][0].isupper() and gap2 in (" ", "-", " ")
            if gap.isspace() and len(gap) == 1 and f in names.given and family(nxt[3]) and not thing:
                found = 2
            elif far and gap.isspace() and f in names.given and len(nxt[2]) == 1 and gap2 in (". ", " ", ".") and far[2][0].isupper() and family(far[3]):
                found = 3
            elif gap == ", " and family(f) and nxt[3] in names.given:
                found = 2
            elif len(w) == 1 and gap in (". ", ".", " ") and family(nxt[3]) and not thing:
                found = 2
            elif f in _TITLES and gap in (". ", " ") and (family(nxt[3]) or nxt[3] in names.given or nxt[2][1:].islower() and not thing):
                found = 2
                if far and gap2 == " " and family(far[3]):
                    found = 3
            elif k and gap == " " and f in names.given and len(nxt[2]) > 2 and nxt[2][1:].islower() and nxt[3] not in _THINGS and not thing:
                last, led = words[k - 1][3], text[words[k - 1][1] : s] in (" ", ": ", ", ")
                if led and (last in _PERSON or last == "for" and k > 1 and words[k - 2][3] in ("ask", "asked", "asking")):
                    found = 2
        if found:
            yield Span(s, words[k + found - 1][1], "person_name")
            k += found
        else:
            k += 1


def spans(text: str | None, names: Names) -> list[Span]:
    """Non-overlapping spans in order; what begins first, and is longest, wins, addresses and numbers inside an e-mail
    address or names inside one do not count."""
    if not text:
        return []
    found: list[Span] = []
    taken: list[tuple[int, int]] = []

    def take(some: Iterable[Span]) -> None:
        for x in some:
            if all(x.end <= a or x.start >= b for a, b in taken):
                found.append(x)
                taken.append((x.start, x.end))

    take(_emails(text))
    if any(map(text.__contains__, "0123456789")):
        take(_ids(text))
        take(_streets(text))
        take(_phones(text))
        take(_phones_abroad(text))
        take(_bare_ids(text))
    parts = set(map(_quick, _WORDS.findall(text)))
    if not names.family.isdisjoint(parts) or not _TITLES.isdisjoint(parts) or not names.given.isdisjoint(parts):
        take(_people(text, names))
    return sorted(found, key=lambda x: x.start)


def _quick(word: str) -> str:
    return word.lower() if word.isascii() else fold(word)


def redact(text: str, found: list[Span]) -> str:
    out, at = [], 0
    for x in found:
        out += [text[at : x.start], f"[{x.kind.upper()}]"]
        at = x.end
    return "".join(out) + text[at:]


def known_names(people: DataFrame, full_name: str) -> Names:
    """The first and last tokens of a table of people's names, each of two letters or more: a gazetteer that tasks hold.

    Tokens are made distinct before the shuffle; a name of one row counts as any other. Up to LISTED_NAMES they are held
    as words, beyond it as hashes; more than MOST_NAMES (64 MB of hashes) are refused, as names left out would stay in
    the texts.
    """
    name = F.regexp_replace(F.trim(F.split(F.col(f"`{full_name}`"), ",")[0]), r"\s+", " ")
    token = F.split(name, " ")
    pairs = F.explode(F.array(F.struct(F.lit(True).alias("first"), F.lower(token[0]).alias("t")), F.struct(F.lit(False).alias("first"), F.lower(F.element_at(token, -1)).alias("t"))))
    rows = people.filter(F.size(token) > 1).select(pairs.alias("p")).select("p.first", "p.t").filter((F.length("t") > 1) & ~F.contains("t", F.lit("."))).distinct()
    top = rows.limit(MOST_NAMES + 1).toArrow()
    if top.num_rows > MOST_NAMES:
        raise ValueError(f"more name tokens than tasks should hold ({MOST_NAMES})")
    side = lambda first: (fold(t) for t in top.filter(pc.equal(top["first"], first))["t"].to_pylist())
    hold = frozenset if top.num_rows <= LISTED_NAMES else Hashed
    return Names(hold(side(True)), hold(side(False)))


_OUT = T.StructType([T.StructField("row_id", T.StringType()), T.StructField("kinds", T.ArrayType(T.StringType())), T.StructField("redacted", T.StringType())])


def find_personal(df: DataFrame, row_id: str, text: str, names: Names) -> DataFrame:
    """(row_id, kinds, redacted) of every row whose text holds personal information: its kinds, each once, and the text
    with [KIND] in place of each piece.

    A narrow Arrow map over whole texts; null and blank texts hold nothing. Repeated rows stay, null ids stay null; extra
    columns are not read. Every task holds the name tokens, which known_names bounds.
    """
    shared = df.sparkSession.sparkContext.broadcast(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            ids, kinds, texts = [], [], []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if found := spans(t, known):
                    ids.append(i)
                    kinds.append(sorted({x.kind for x in found}))
                    texts.append(redact(t, found))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(kinds, pa.list_(pa.string())), pa.array(texts, pa.string())], ["row_id", "kinds", "redacted"])

    narrow = df.select(F.col(f"`{row_id}`").cast("string").alias("row_id"), F.col(f"`{text}`").alias("text")).filter(F.col("text").isNotNull())
    return narrow.mapInArrow(run, _OUT)
