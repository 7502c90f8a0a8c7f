"""Names of organisations taken apart: what is their own, what is line of trade, legal form or place."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

# Legal forms, articles and connecting words, which tell no two organisations apart.
LEGAL = frozenset(
    "inc incorporated llc ltd limited corp corporation co company lp llp plc ulc ltee the group and et dba aka de la of y und n sa srl gmbh".split()
)
# Lines of trade by the word that leads them, with the forms in which that word is written.
TRADE = {
    "gasket": "gasket gaskets gskt gskts",
    "process": "process proc processes",
    "pump": "pump pumps pmp",
    "pipe": "pipe pipes pipefittings pf",
    "tube": "tube tubes tubing tb",
    "instrument": "instrument instruments instr instrumentation",
    "hydraulic": "hydraulic hydraulics hyd hydr",
    "plumbing": "plumbing plbg plumb",
    "valve": "valve valves vlv vlvs",
    "steel": "steel stl steels",
    "boiler": "boiler boilers blr",
    "industrial": "industrial industrials ind indl indus",
    "flow": "flow flowcontrol",
    "mechanical": "mechanical mechanicals mech",
    "actuator": "actuator actuators act",
}
# Words that follow the leading one.
TRADE_REST = frozenset(
    "manufacturing mfg mfrg systems system sys services service svcs svc serv fittings fitting ftgs ftg fabrication fabrications fab fabr international intl int"
    " components component comp comps wholesale whsl whs supply supplies sup sply splys distribution dist distributors technologies technology tech equipment equip eqpt"
    " control controls ctrl ctrls contractors contracting contr contrs automation auto autom".split()
)
_LEADS = {form: lead for lead, forms in TRADE.items() for form in forms.split()}
_LONG = [w for w in [*_LEADS, *TRADE_REST, *LEGAL] if len(w) >= 5]
_HOST = re.compile(r"^(?:https?://)?(?:www\.)?([a-z0-9][a-z0-9-]*(?:\.[a-z0-9-]+)+)/?$")
_CAMEL = re.compile(r"(?<=[a-zà-ÿ])(?=[A-ZÀ-Þ])")
_TOKEN = re.compile(r"[^\W_]+(?:['’.](?![^\W_]))?")


def edits(a: str, b: str, most: int) -> int:
    """Insertions, deletions, substitutions and swaps of neighbours between two words, in a band; most + 1 if more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    wide = most + 1
    older: list[int] = []
    row = [j if j <= most else wide for j in range(len(b) + 1)]
    for i, x in enumerate(a, 1):
        new = [wide] * (len(b) + 1)
        if i <= most:
            new[0] = i
        for j in range(max(1, i - most), min(len(b), i + most) + 1):
            y = b[j - 1]
            v = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, older[j - 2] + 1)
            new[j] = min(v, wide)
        if min(new) > most:
            return wide
        older, row = row, new
    return row[-1]


@dataclass(frozen=True)
class Name:
    """words: what is the organisation's own, as written but folded; cut: which of them are cut short."""

    words: tuple[str, ...]
    cut: tuple[bool, ...]
    trade: str | None

    @property
    def core(self) -> str:
        return "".join(self.words)


def fold(text: str) -> str:
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", text).casefold())
    return "".join(c for c in text if not unicodedata.combining(c))


def _shorter(word: str) -> set[str]:
    """The word and what it is without one of its letters: two words one edit apart share one of these."""
    return {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}


_NEAR: dict[str, list[int]] = {}
for _place, _known in enumerate(_LONG):
    for _form in _shorter(_known):
        _NEAR.setdefault(_form, []).append(_place)


@lru_cache(maxsize=100_000)
def _common(word: str) -> str | None:
    """The trade's leading word, '' for any other common word, None for a word of the organisation's own."""
    if word in _LEADS:
        return _LEADS[word]
    if word in LEGAL or word in TRADE_REST:
        return ""
    if len(word) >= 5:
        for place in sorted({p for form in _shorter(word) for p in _NEAR.get(form, ())}):
            if edits(_LONG[place], word, 1) <= 1:
                return _LEADS.get(_LONG[place], "")
    return None


def host_label(site: str | None) -> str | None:
    """The registrable label of a site or host name, or None."""
    m = _HOST.match(fold(site).strip()) if site else None
    return m.group(1).split(".")[-2] if m else None


def numbers(form: str) -> list[str]:
    """The numbers in a form, in order of size: spellings of one name never differ in them."""
    return sorted(re.findall(r"\d+", form))


def parse(name: str | None) -> Name:
    """Null, blank and wordless names have no words; numbers and single letters are words as any other."""
    if not name:
        return Name((), (), None)
    if label := host_label(name):
        words = [w for w in label.split("-") if w and _common(w) is None]
        return Name(tuple(words), (False,) * len(words), None)
    text = _CAMEL.sub(" ", unicodedata.normalize("NFKC", name))
    low = fold(text)
    low = re.sub(r"\b[da]\s?/\s?[bk]\s?/\s?a\b|\bd\.b\.a\.", " ", low)
    low = re.sub(r"\bl\.\s?l\.\s?c\b\.?", " llc ", low)
    low = re.sub(r"\bp\s?(?:&|\.|and)\s?f\b\.?", " pipefittings ", low)
    low = re.sub(r"\bint['’]?l\b", " intl ", low)
    low = re.sub(r"\bind['’]l\b", " industrial ", low)
    kept = re.sub(r"\s[-–—]\s.*$", "", low)
    trade = None
    for place in dict.fromkeys((kept, low)):
        out = []
        for found in _TOKEN.finditer(place):
            token = found.group()
            word = token.rstrip(".'’")
            lead = _common(word)
            if lead is None:
                if len(word) > 1 or place[found.start() - 1 : found.start()] not in ("'", "’"):  # no letter cut off by an apostrophe
                    out.append((word, not word.isdigit() and len(word) > 1 and (word != token and len(word) <= 6 or len(word) <= 4)))
            elif lead and trade is None:
                trade = lead
        if sum(len(w) for w, _ in out) >= 6:
            break
    return Name(tuple(w for w, _ in out), tuple(c for _, c in out), trade)
