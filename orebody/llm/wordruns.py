"""Evaluation texts inside training text: n-gram seeds, then local alignment of what lies around them."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEED = 5
RUN = 12
# Most evaluation rows and characters of theirs that a task holds at once; beyond either the items are searched in as
# many passes as needed.
ITEMS_AT_ONCE, CHARACTERS_AT_ONCE = 20_000, 40_000_000
# Texts whose words a task holds at once, and cells of the alignments that it works on together.
TEXTS_AT_ONCE, CELLS_AT_ONCE = 400, 200_000

_FORMAT = re.compile("[" + "".join(re.escape(chr(c)) for c in range(0x110000) if unicodedata.category(chr(c)) == "Cf") + "]")
_WORD = re.compile(r"[^\W_]+")
_ASCII_WORDS = "".join(chr(c).lower() if chr(c).isalnum() else " " for c in range(128))


class _Composed(Exception):
    pass


class _Letters(dict):
    """What each character is in the text of words: lower-cased compatibility letters and numbers, nothing for format
    characters, else a space. Characters that compose with their neighbours, or whose lower case depends on them, have no
    such form."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        kind = unicodedata.category(char)
        if kind[0] == "M" or char == "Σ" or 0x1100 <= code <= 0x11FF:
            raise _Composed
        shown = "" if kind == "Cf" else unicodedata.normalize("NFKC", char)
        if any(unicodedata.category(c)[0] == "M" for c in shown):
            raise _Composed
        self[code] = out = "".join(c if c.isalnum() else " " for c in shown.lower())
        return out


_LETTERS = _Letters()


def words(text: str | None) -> list[str]:
    """The longest runs of letters and numbers after removing format characters, NFKC and lower-casing; null has none."""
    if not text:
        return []
    if text.isascii():
        return text.translate(_ASCII_WORDS).split()
    try:
        return text.translate(_LETTERS).split()
    except _Composed:
        return _composed_words(text)


def _composed_words(text: str) -> list[str]:
    return _WORD.findall(unicodedata.normalize("NFKC", _FORMAT.sub("", text)).lower())


def align(a: list[str], b: list[str]) -> tuple[int, int]:
    """Smith-Waterman over words: (best local score, longest run of equal consecutive words)."""
    numbers = {w: k for k, w in enumerate(dict.fromkeys(a), 1)}
    of = lambda ws: np.array([numbers.get(w, 0) for w in ws], np.int64)
    score, run = align_all([of(a)], [of(b)])
    return int(score[0]), int(run[0])


def align_all(a: list[np.ndarray], b: list[np.ndarray], match: int = 2, miss: int = -1, gap: int = -1) -> tuple[np.ndarray, np.ndarray]:
    """align of many pairs of word numbers (0 equals nothing), pairs of like length at a time.

    Row by row over all of them; the gaps along a row are closed by a running maximum, as the gap cost is linear.
    """
    best, longest = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    order = sorted(range(len(a)), key=lambda k: len(b[k]))
    while order:
        some = [order.pop()]
        wide = len(b[some[0]])
        while order and (len(some) + 1) * (wide + 1) <= CELLS_AT_ONCE:
            some.append(order.pop())
        deep = max(len(a[k]) for k in some)
        x, y = np.full((len(some), deep), -1, np.int64), np.zeros((len(some), wide), np.int64)
        for row, k in enumerate(some):
            x[row, : len(a[k])], y[row, : len(b[k])] = a[k], b[k]
        steps = np.arange(1, wide + 1, dtype=np.int32) * gap
        score, run = np.zeros((len(some), wide + 1), np.int32), np.zeros((len(some), wide + 1), np.int32)
        top, far = np.zeros(len(some), np.int32), np.zeros(len(some), np.int32)
        for i in range(deep):
            same = y == x[:, i : i + 1]
            run[:, 1:] = np.where(same, run[:, :-1] + 1, 0)
            new = np.maximum(score[:, :-1] + np.where(same, match, miss), score[:, 1:] + gap)
            score[:, 1:] = np.maximum(0, np.maximum.accumulate(np.maximum(new, 0) - steps, axis=1) + steps)
            top, far = np.maximum(top, score.max(axis=1)), np.maximum(far, run.max(axis=1))
        best[some], longest[some] = top, far
    return best, longest


_COUNT = T.StructType([T.StructField("gram", T.LongType()), T.StructField("n", T.LongType())])
_PAIR = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("item_id", T.LongType()),
    T.StructField("score", T.LongType()), T.StructField("item_words", T.IntegerType()), T.StructField("run", T.IntegerType()),
])


def _regions(at: list[int], reach: int) -> list[tuple[int, int]]:
    """Stretches of reach words on both sides of the seeds, joined where they meet."""
    out: list[list[int]] = []
    for i in sorted(at):
        if out and i - reach <= out[-1][1]:
            out[-1][1] = i + reach
        else:
            out.append([max(0, i - reach), i + reach])
    return [(a, b) for a, b in out]


@dataclass(frozen=True)
class Items:
    """Evaluation rows as words, the number of each of their words, and the hashes of their n-grams, sorted."""

    rows: list[tuple[int, list[str]]]
    numbers: dict[str, int]
    held: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int, list[str]]]) -> Items:
        numbers = {w: k for k, w in enumerate(dict.fromkeys(w for _, ws in rows for w in ws), 1)}
        empty = cls(rows, numbers, np.zeros(0, np.int64))
        found = [empty.grams(empty.number(ws))[1] for _, ws in rows]
        return cls(rows, numbers, np.unique(np.concatenate(found)) if found else empty.held)

    def number(self, ws: list[str]) -> np.ndarray:
        return np.fromiter(map(self.numbers.get, ws, repeat(0)), np.int64, len(ws))

    def grams(self, numbers: np.ndarray, ends: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(places, hashes) of the n-grams whose words all occur in the items; none reaches over one of ``ends``."""
        count = len(numbers) - SEED + 1
        if count <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        whole = np.ones(count, bool)
        for k in range(SEED):
            whole &= numbers[k : k + count] > 0
        if ends is not None and len(ends):
            over = (ends[:, None] - np.arange(1, SEED)).ravel()
            whole[over[(over >= 0) & (over < count)]] = False
        places = np.flatnonzero(whole)
        hashed = np.zeros(len(places), np.uint64)
        for k in range(SEED):
            hashed = hashed * np.uint64(0x9E3779B97F4A7C15) + numbers[places + k].astype(np.uint64)
        return places, hashed.astype(np.int64)

    def hits(self, texts: list[str | None], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(numbers, ends, which, places, hashes): the numbers of the texts' words, one text after the other, where each
        ends, and for every n-gram of theirs among the sorted seeds its text, place and hash."""
        split = list(map(words, texts))
        ends = np.cumsum([len(ws) for ws in split])
        numbers = self.number(list(chain.from_iterable(split)))
        places, hashed = self.grams(numbers, ends)
        if not len(places) or not len(seeds):
            return numbers, ends, *(np.zeros(0, np.int64),) * 3
        same = seeds[np.minimum(np.searchsorted(seeds, hashed), len(seeds) - 1)] == hashed
        places, hashed = places[same], hashed[same]
        return numbers, ends, np.searchsorted(ends, places, "right"), places, hashed


def leaks(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", edited: bool = True) -> DataFrame:
    """(doc_id, item_id, score, item_words, run): every pair that shares a seed of the item, aligned.

    Every n-gram of 5 words of the items is a seed, looked up in every document: a narrow map over whole texts, against
    hashes of the items' n-grams; the texts are never shuffled. Each item is aligned with the text around its seeds:
    Smith-Waterman over words scores edited copies, and the longest run of equal consecutive words says whether a
    passage is held literally. A copy is missed only if no 5 consecutive words of it stayed as they were.

    With ``edited`` off only copies of 12 words and more need be found: of each 12-word window of an item the rarest
    n-gram (ties: the smallest hash) by document frequency over the whole corpus is its seed. A document that repeats a
    window holds all its n-grams, so no literal window is lost, but most edited copies are; the frequencies take one
    more narrow map, whose counts are combined before the shuffle.

    Items of fewer than 12 words are seeded by their n-grams (with ``edited`` off the rarest one), of fewer than 5 words
    not at all. Null, empty and blank texts have no words. Repeated rows count once. The evaluation table is collected in
    blocks bounded in rows and characters, so that what the tasks hold stays bounded however large it is.
    """
    docs = documents.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).filter(F.col("text").isNotNull())
    evals = items.select(F.col(f"`{item_id}`").cast("long").alias("item_id"), F.col(f"`{text}`").alias("text")).filter(F.col("text").isNotNull()).distinct()
    size = evals.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("characters")).first()
    blocks = max(1, -(-size.rows // ITEMS_AT_ONCE), -(-size.characters // CHARACTERS_AT_ONCE))
    out = None
    for block in range(blocks):
        rows = evals.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        held = Items.of([(r.item_id, words(r.text)) for r in rows])
        found = _aligned(docs, held, _seeds(held, None if edited else _frequency(docs, held)))
        out = found if out is None else out.unionByName(found)
    return out.groupBy("doc_id", "item_id").agg(F.max("score").alias("score"), F.max("item_words").alias("item_words"), F.max("run").alias("run"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[str]]]:
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
            part = batch.slice(at, TEXTS_AT_ONCE)
            yield part.column(0).to_pylist(), part.column(1).to_pylist()


def _frequency(docs: DataFrame, items: Items) -> dict[int, int]:
    """In how many documents each n-gram of the items stands: at most one row per n-gram of the block goes to the driver."""
    shared = docs.sparkSession.sparkContext.broadcast(items)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        seen = np.zeros(len(held.held), np.int64)
        for _, texts in _chunks(batches):
            _, _, which, _, hashed = held.hits(texts, held.held)
            once = np.unique(which * len(seen) + np.searchsorted(held.held, hashed))
            seen += np.bincount(once % max(1, len(seen)), minlength=len(seen))
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(held.held[some]), pa.array(seen[some])], _COUNT.names)

    counted = docs.mapInArrow(look, _COUNT).groupBy("gram").agg(F.sum("n").alias("n"))
    return {r.gram: r.n for r in counted.collect()}


def _seeds(items: Items, frequency: dict[int, int] | None) -> dict[int, list[int]]:
    """The items of each seed: all n-grams, or by frequency the rarest of every window that some document may hold."""
    out: dict[int, set[int]] = {}
    width = RUN - SEED + 1
    for item, ws in items.rows:
        gs = items.grams(items.number(ws))[1].tolist()
        if frequency is None:
            kept = set(gs)
        else:
            windows = [gs[i : i + width] for i in range(max(1, len(gs) - width + 1) if gs else 0)]
            kept = {min(w, key=lambda g: (frequency[g], g)) for w in windows if all(g in frequency for g in w)}
        for g in kept:
            out.setdefault(g, set()).add(item)
    return {g: sorted(x) for g, x in out.items()}


def _aligned(docs: DataFrame, items: Items, seeds: dict[int, list[int]]) -> DataFrame:
    spark = docs.sparkSession
    if not seeds:
        return spark.createDataFrame([], _PAIR)
    texts_of: dict[int, list[np.ndarray]] = {}
    for item, ws in items.rows:
        texts_of.setdefault(item, []).append(items.number(ws))
    shared = spark.sparkContext.broadcast((Items([], items.numbers, items.held), seeds, texts_of))

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, items_of, originals = shared.value
        known = np.sort(np.fromiter(items_of, np.int64, len(items_of)))
        for ids, texts in _chunks(batches):
            numbers, ends, which, places, hashed = held.hits(texts, known)
            at: dict[tuple[int, int], list[int]] = {}
            for doc, place, gram in zip(which.tolist(), places.tolist(), hashed.tolist()):
                for item in items_of[gram]:
                    at.setdefault((doc, item), []).append(place)
            starts = [0, *ends.tolist()]
            pairs = [
                (ids[doc], item, other, numbers[max(a, starts[doc]) : min(b + SEED, starts[doc + 1])])
                for (doc, item), found in at.items() for other in originals[item] for a, b in _regions(found, 2 * len(other))
            ]
            score, run = align_all([p[2] for p in pairs], [p[3] for p in pairs])
            columns = [p[0] for p in pairs], [p[1] for p in pairs], score, [len(p[2]) for p in pairs], run
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], _PAIR.names)

    return docs.mapInArrow(extend, _PAIR)
