"""Free-entered values mapped to a reference list: embedded mentions by automaton, the rest by token-set similarity."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator, Mapping, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from orebody.functions.geo import COUNTRIES, REGIONS
from orebody.llm.vocabulary import FILLERS, HELD, RANKS, WHOLE, WORK

UNMATCHED = -1
LEAST_SIMILARITY = 0.9
# Most rows of a reference list that tasks hold; a longer list is refused rather than broadcast.
MOST_ENTRIES = 200_000

# Letters of a value or word up to which a task remembers what it means; a longer word is no misspelt listed one.
LONGEST_REMEMBERED = 120

_PIECE = re.compile(r"[^\W_]+|[^\w\s]+|_+")
_DROPPED = re.compile(r"[.'’`´]")


def fold(value: str) -> str:
    """NFKC, lower case, no accents, no full stops or apostrophes."""
    text = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", value).casefold())
    return _DROPPED.sub("", "".join(c for c in text if not unicodedata.combining(c)))


def pieces(value: str) -> list[tuple[str, bool]]:
    """The words of a value without fillers, and whether punctuation stands before each."""
    out, parted = [], False
    for p in _PIECE.findall(fold(value)):
        if not p[0].isalnum():
            parted = True
        elif p not in FILLERS:
            out.append((p, parted))
            parted = False
    return out


_PLACES = frozenset(w for name in (*REGIONS, *COUNTRIES) if len(name) > 3 for w, _ in pieces(name))


def adds_nothing(words: Sequence[str]) -> bool:
    """Whether words only say where or when someone does a job."""
    return all(w in HELD or w in _PLACES or w.isdigit() for w in words)


def shortens(short: str, word: str) -> bool:
    """Whether a word is written short: its first three letters or more, or its first letter and, in order, others none of
    which is a vowel, at least three in all and the last within its last three."""
    if len(short) < 3 or len(short) >= len(word) or short[0] != word[0]:
        return False
    if word.startswith(short):
        return True
    at = 0
    for letter in short[1:]:
        at = word.find(letter, at + 1)
        if at < 0 or letter in "aeiouy":
            return False
    return at >= len(word) - 3


def one_edit(a: str, b: str) -> bool:
    """Whether one insertion, deletion, substitution or swap of neighbours turns a into b (or none is needed)."""
    if a == b:
        return True
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :] or a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :]
    return a[i:] == b[i + 1 :]


def edits(a: str, b: str) -> int:
    """Insertions, deletions, substitutions and swaps of neighbours between two words."""
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                row[j] = min(row[j], older[j - 2] + 1)
    return row[-1]


class Matcher:
    """Reference entries and their aliases, as an automaton and as token sets."""

    def __init__(self, aliases: Mapping[str, int]) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        self.trie: dict = {}
        self.sets: dict[frozenset[str], int] = {}
        words: dict[str, int] = {}
        self.by_word: dict[str, list[tuple[frozenset[str], int]]] = {}
        for alias, entry in aliases.items():
            ws = [w for w, _ in pieces(alias)]
            if not ws:
                continue
            self.automaton.add_word(f" {' '.join(ws)} ", (len(ws), entry))
            node = self.trie
            for w in ws:
                node = node.setdefault(w, {})
            node.setdefault("", entry)
            self.sets.setdefault(frozenset(ws), entry)
            for w in ws:
                words[w] = words.get(w, 0) + 1
        self.automaton.make_automaton()
        self.words = words
        for s, entry in self.sets.items():
            self.by_word.setdefault(min(s, key=lambda w: (words[w], w)), []).append((s, entry))
        self.near: dict[str, list[str]] = {}
        for w in words:
            if len(w) >= 4:
                for key in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
                    self.near.setdefault(key, []).append(w)
        self._remembered = lru_cache(maxsize=200_000)(self._corrected)

    def corrected(self, word: str) -> tuple[str, ...]:
        return self._remembered(word) if len(word) <= LONGEST_REMEMBERED else (word,)

    def _corrected(self, word: str) -> tuple[str, ...]:
        """The listed words that a word may stand for: itself and those that it shortens; if it is none, from four letters on, those
        one edit away, else, from seven, two edits away; most used first."""
        found = {w for w in self.words if shortens(word, w)}
        if word in self.words:
            return (word, *sorted(found, key=lambda w: (-self.words[w], w)))
        if len(word) >= 4:
            found |= {w for key in (word, *(word[:i] + word[i + 1 :] for i in range(len(word)))) for w in self.near.get(key, ()) if one_edit(w, word)}
        if not found and len(word) >= 7:
            found = {w for w in self.words if len(w) >= 7 and w[0] in word[:2] and abs(len(w) - len(word)) <= 2 and edits(w, word) <= 2}
        return tuple(sorted(found, key=lambda w: (sorted(w) != sorted(word), -self.words[w], w))) or (word,)

    def _mention(self, ws: list[str], parted: list[bool]) -> int | None:
        """Of the mentions, longest first and none over another, the one that begins the value, if whatever follows it is
        set off by punctuation or only says where or when."""
        starts, at = {}, 0
        for k, w in enumerate(ws):
            starts[at] = k
            at += len(w) + 1
        found = []
        for end, (n, entry) in self.automaton.iter(f" {' '.join(ws)} "):
            last = starts.get(end, len(ws))
            found.append((-n, last - n, entry))
        taken: list[tuple[int, int]] = []
        for less, first, entry in sorted(found):
            after = first - less
            if all(after <= a or first >= b for a, b in taken):
                taken.append((first, after))
                if first == 0:
                    return entry if self._ends(ws, parted, after) else None
        return None

    @staticmethod
    def _ends(ws: list[str], parted: list[bool], after: int) -> bool:
        return after == len(ws) or parted[after] or adds_nothing(ws[after:])

    def _corrected_mention(self, ws: list[str], parted: list[bool]) -> int | None:
        """The longest mention that begins the value once its words are corrected: a walk down the trie of all aliases,
        which follows every correction of a word that leads on."""
        best: tuple[int, int] | None = None
        walk = [(0, self.trie)]
        while walk:
            k, node = walk.pop()
            if "" in node and (best is None or k > best[0]) and self._ends(ws, parted, k):
                best = (k, node[""])
            if k < len(ws):
                walk += [(k + 1, node[w]) for w in reversed(self.corrected(ws[k])) if w in node]
        return best[1] if best else None

    def _similar(self, ws: list[str]) -> int | None:
        """The entry whose tokens are closest as a set: twice the shared tokens over all tokens of both."""
        have = frozenset(ws)
        best: tuple[float, int] | None = None
        rivals = set()
        for w in have:
            for s, entry in self.by_word.get(w, ()):
                score = 2 * len(s & have) / (len(s) + len(have))
                if best is None or score > best[0]:
                    best, rivals = (score, entry), {entry}
                elif score == best[0]:
                    rivals.add(entry)
        return best[1] if best and best[0] >= LEAST_SIMILARITY and len(rivals) == 1 else None

    def match(self, value: str | None) -> int:
        """The entry meant, or -1 for none; null, blank and wordless values mean none."""
        parts = pieces(value or "")
        if not parts:
            return UNMATCHED
        led = next((k for k, (w, _) in enumerate(parts) if w not in HELD), 0)
        ws, parted = [w for w, _ in parts[led:]], [p for _, p in parts[led:]]
        for look in (self._mention, self._corrected_mention):
            if (entry := look(ws, parted)) is not None:
                return entry
        fixed = [self.corrected(w)[0] for w in ws]
        ends = [k for k in range(1, len(fixed)) if parted[k]] + [len(fixed)]
        for end in sorted(ends, reverse=True):
            if (entry := self._similar(fixed[:end])) is not None:
                return entry
        return UNMATCHED


def initials(phrase: str) -> list[str]:
    """The first letters of a phrase of two words or more, together and apart."""
    letters = [w[0] for w, _ in pieces(phrase)]
    return ["".join(letters), " ".join(letters)] if len(letters) > 1 else []


def title_aliases(entries: Sequence[tuple[int, str]]) -> dict[str, int]:
    """Every way the vocabulary knows to write the given titles, their initials among them; a form that two titles share
    means neither. Words written short need no alias: they are corrected."""
    by_title = {title: entry for entry, title in entries}
    forms: dict[str, set[int]] = {}
    for entry, title in entries:
        forms.setdefault(title, set()).add(entry)
    for whole, ways in WHOLE.items():
        if whole in by_title:
            for way in [*ways, *initials(whole)]:
                forms.setdefault(way, set()).add(by_title[whole])
    for rank, short in RANKS.items():
        for work, ways in WORK.items():
            title = f"{rank} of {work}" if rank in ("Vice President", "Director") else f"{work} {rank}"
            if title in by_title:
                for r in [*short, *initials(rank)]:
                    for w in [*ways, *initials(work)]:
                        forms.setdefault(f"{r} {w}", set()).add(by_title[title])
                        forms.setdefault(f"{w} {r}", set()).add(by_title[title])
    joined: dict[str, set[int]] = {}
    for form, meant in forms.items():
        joined.setdefault(" ".join(w for w, _ in pieces(form)), set()).update(meant)
    exact = {" ".join(w for w, _ in pieces(title)): entry for entry, title in entries}
    return {form: exact.get(form, min(meant)) for form, meant in joined.items() if form in exact or len(meant) == 1}


def map_values(rows: DataFrame, value: str, entries: Sequence[tuple[int, str]], aliases: Mapping[str, int], out: str = "entry_id") -> DataFrame:
    """rows with the column ``out``: the entry that ``value`` means, -1 for none, null where it is null or blank.

    A narrow Arrow map; each batch matches its distinct values once, so hot spellings cost little. A value that is
    letter for letter an entry means it. Every task holds the reference list; above MOST_ENTRIES aliases it is refused.
    Repeated rows stay; a column already named ``out`` is refused.
    """
    if len(aliases) > MOST_ENTRIES:
        raise ValueError(f"{len(aliases)} aliases are more than tasks should hold ({MOST_ENTRIES})")
    if out in rows.columns:
        raise ValueError(f"column {out} exists already")
    shared = rows.sparkSession.sparkContext.broadcast(dict(aliases))
    exact = {title: entry for entry, title in entries}
    at = rows.columns.index(value)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value)
        find = lambda v: exact[v] if v in exact else matcher.match(v)
        remembered = lru_cache(maxsize=200_000)(find)
        known = lambda v: remembered(v) if len(v) <= LONGEST_REMEMBERED else find(v)
        for batch in batches:
            coded = batch.column(at).dictionary_encode()
            meant = pa.array([None if v is None or not v.strip() else known(v) for v in coded.dictionary.to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, meant.take(coded.indices)], [*batch.schema.names, out])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(out, T.LongType())]))
