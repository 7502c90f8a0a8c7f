"""Text decoded with the wrong encoding: found by a round trip through the encodings that could have garbled it.

A run of characters is re-encoded under each candidate legacy encoding and strictly decoded as the intended one; the
reading is taken when the garbling cost drops, and the result is tried again for further layers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEGACY = ("cp1252", "cp1250", "cp1251", "mac_roman", "cp437", "cp850", "iso8859_15")
SINGLE_BYTE = ("mac_roman", "cp1251", "cp437", "cp850")
MAX_LAYERS = 6
LONGEST_WORD = 40
LOST = "\ufffd"
_ASCII = frozenset(map(chr, range(128)))

# Code points that a repaired character may have: what people write, not what chance byte pairs spell.
_WRITTEN = (
    (0xA0, 0x17F), (0x300, 0x36F), (0x384, 0x3CE), (0x401, 0x45F), (0x1E00, 0x1EFF), (0x2010, 0x205E), (0x20A0, 0x20BF),
    (0x2100, 0x214F), (0x2150, 0x23FF), (0x2460, 0x27BF), (0x2B00, 0x2BFF), (0x3000, 0x30FF), (0x3400, 0x9FFF), (0xAC00, 0xD7A3),
    (0xFE0F, 0xFE0F), (0xFEFF, 0xFEFF), (0xFF00, 0xFFEF), (0x1F300, 0x1FAFF), (0x200B, 0x200D),
)


def _written(char: str) -> bool:
    code = ord(char)
    return any(a <= code <= b for a, b in _WRITTEN)


def _byte_table(codec: str) -> list[str]:
    """What each byte shows as under the codec; bytes it leaves undefined show as C1 controls, as lenient decoders do."""
    return [bytes([b]).decode(codec, "ignore") or chr(b) for b in range(256)]


@dataclass(frozen=True)
class _Codec:
    name: str
    to_byte: dict[str, int]
    pattern: re.Pattern[str]
    leads: frozenset[str]
    quick: re.Pattern[str]


@lru_cache(maxsize=None)
def _codec(name: str) -> _Codec:
    shown = _byte_table(name)
    to_byte = {chr(b): b for b in range(0x80, 0xA0)} if name == "cp1252" else {}
    to_byte |= {char: b for b, char in enumerate(shown)}
    chars = lambda a, b: "[" + "".join(re.escape(c) for c, x in to_byte.items() if a <= x <= b) + "]"
    more = chars(0x80, 0xBF)
    unit = f"(?:{chars(0xC2, 0xDF)}{more}|{chars(0xE0, 0xEF)}{more}{{2}}|{chars(0xF0, 0xF4)}{more}{{3}})"
    leads = frozenset(c for c, x in to_byte.items() if 0xC2 <= x <= 0xF4)
    return _Codec(name, to_byte, re.compile(f"{unit}+"), leads, re.compile(chars(0xC2, 0xF4) + more))


def _script(char: str) -> str:
    code = ord(char)
    if not char.isalpha():
        return ""
    return "latin" if code < 0x250 or 0x1E00 <= code <= 0x1EFF else "cyrillic" if 0x400 <= code <= 0x52F else "greek" if 0x370 <= code <= 0x3FF else "other"


def _as_utf8(text: str, codec: _Codec) -> tuple[str, int]:
    """text with every run that spells UTF-8 under the codec read as such, and how many runs that were."""
    changed = 0

    def read(m: re.Match[str]) -> str:
        nonlocal changed
        run = m.group()
        try:
            out = bytes(codec.to_byte[c] for c in run).decode("utf-8")
        except UnicodeDecodeError:
            return run
        if not all(_written(c) or c in codec.to_byte for c in out):  # what the codec shows itself may be the next layer
            return run
        before, after = text[max(0, m.start() - 2) : m.start()], text[m.end() : m.end() + 1]
        sides = {_script(c) for c in before[-1:] + after} - {""}
        if codec.name == "cp1251" and "cyrillic" in sides and len(out) < 2:
            return run  # a Cyrillic word, not a Latin letter in disguise
        if codec.name in ("cp437", "cp850") and (before[-1:] in "─═" and before or after in "─═" and after):
            return run  # a drawn box
        if len(before) == 2 and before.isupper() and out[0].islower() and run[0].isupper() and run[1:].isspace():
            return run  # a capital with a no-break space after it
        changed += 1
        return out

    return codec.pattern.sub(read, text), changed


_SIGNS = set("‚„∞∂√∫≠≥≤∑∏πΩ◊¸ˆ˙‰˜´¨¬˚˝˛ˇ˘¯ªº¿¡ﬂﬁ‡†‹›ÿ")


def _token_cost(token: str) -> int:
    """How garbled a white-space free token looks; remembered for words, not for long runs without white space."""
    return _word_cost(token) if len(token) <= LONGEST_WORD else _cost(token)


def _cost(token: str) -> int:
    """Mixed scripts, capitals and signs inside words, controls."""
    cost, scripts, last = 0, set(), ""
    for k, c in enumerate(token):
        if 0x80 <= ord(c) < 0xA0 or c == LOST:
            cost += 3
        s = _script(c)
        if s:
            scripts.add(s)
            if ord(c) > 0x7F and c.isupper() and last.islower():
                cost += 2
        if c in _SIGNS:
            following = token[k + 1 : k + 2]
            if last.isalpha() and (following.isalpha() or not following or c not in "ªº†‡") or last.isdigit() and c == "∞" or c in "ˆ¸‰" and following.isalpha():
                cost += 2
        elif "─" <= c <= "▟" and (last.isalpha() or token[k + 1 : k + 2].isalpha()):
            cost += 2
        last = c
    if len(scripts - {"other"}) > 1:
        cost += 3
    return cost


_word_cost = lru_cache(maxsize=200_000)(_cost)
_TOKEN = re.compile(r"\S+")


def _as_cp1252(text: str, name: str, suspects: dict[str, int]) -> tuple[str, int]:
    """Tokens of Western single-byte text that were shown under another single-byte encoding, where that lowers their cost."""
    codec, changed = _codec(name), 0

    def turn(token: str) -> str | None:
        try:
            out = bytes(codec.to_byte[c] for c in token).decode("cp1252")
        except (KeyError, UnicodeDecodeError):
            return None
        return out if all(ord(c) < 0x80 or _written(c) for c in out) else None

    def read(m: re.Match[str]) -> str:
        nonlocal changed
        token = m.group()
        cost = suspects.get(token)
        if cost and (out := turn(token)) and out != token and _token_cost(out) < cost:
            changed += 1
            return out
        return token

    lines = []
    for line in text.splitlines(keepends=True):
        before = changed
        out = _TOKEN.sub(read, line)
        if changed > before and (whole := turn(line)) and whole != out and _line_cost(whole) <= _line_cost(out) and changed - before >= min(2, _changes(out, whole)):
            out = whole
        lines.append(out)
    return "".join(lines), changed


def _line_cost(line: str) -> int:
    return sum(_token_cost(t) for t in line.split() if not t.isascii())


def _changes(one: str, other: str) -> int:
    return sum(a != b for a, b in zip(one.split(), other.split()))


def _weight(text: str) -> int:
    """The garbling cost of a whole reading: one for each character outside ASCII, three for those that Western texts rarely hold."""
    return sum(text.count(c) * (1 if c < "\u0100" or "\u2010" <= c <= "\u2044" or c > "\u20a0" else 3) for c in set(text) - _ASCII)


def repair(text: str | None) -> tuple[str | None, list[str], bool]:
    """(repaired text, encodings undone, whether anything stays lost).

    Null and ASCII texts come back as they are. Every candidate is applied for as many layers as it reads, the reading of
    least garbling cost is kept (the first candidate on a tie), and the search starts again on it until none changes
    anything. Then words of Western single-byte text shown as another single-byte encoding are read as such where their
    cost drops, and with them the signs of their line, if it as a whole decodes and costs no more. A sign or a letter by itself is no
    evidence: it is left. A replacement character cannot be undone: it counts as lost.
    """
    if text is None or text.isascii():
        return text, [], False
    undone: list[str] = []
    while len(undone) < MAX_LAYERS:
        there, readings = set(text), []
        for k, name in enumerate(LEGACY):
            layers, out = 0, text
            codec = _codec(name)
            if there.isdisjoint(codec.leads) or not codec.quick.search(text):
                continue
            while layers < MAX_LAYERS:
                after, changed = _as_utf8(out, codec)
                if not changed:
                    break
                layers, out = layers + 1, after
            if layers:
                readings.append((_weight(out), k, layers, name, out))
        if not readings:
            break
        _, _, layers, name, text = min(readings)
        undone += [f"{name}>utf_8"] * layers
    suspects = {t: cost for t in set(text.split()) if not t.isascii() and (cost := _token_cost(t))}
    if suspects:
        readings = [(-changed, k, n, out) for k, n in enumerate(SINGLE_BYTE) for out, changed in [_as_cp1252(text, n, suspects)] if changed]
        if readings:
            _, _, name, text = min(readings)
            undone.append(f"{name}>cp1252")
    return text, undone, LOST in text or any("\x80" <= c < "\xa0" and c != "\x85" for c in set(text))


_OUT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("repaired", T.StringType()),
    T.StructField("encodings", T.ArrayType(T.StringType())), T.StructField("lost", T.BooleanType()),
])


def repair_texts(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, repaired, encodings, lost) of every document with at least one garbled place; others do not come out.

    A narrow Arrow map: no shuffle, whole texts, and pure ASCII rows are dropped in the JVM before they reach Python.
    Null, empty and blank texts are not garbled. Repeated rows come out as often as they go in. Extra columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, *repair(t)) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            columns = list(zip(*(r for r in rows if r[2] or r[3]))) or [()] * 4
            kinds = (pa.int64(), pa.string(), pa.list_(pa.string()), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], _OUT.names)

    narrow = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return narrow.filter(F.col("text").rlike(r"[^\x00-\x7F]")).mapInArrow(run, _OUT)
