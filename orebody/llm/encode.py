"""Encoding of texts with a public byte-level BPE vocabulary by walking a prefix trie of the distinct words.

The encoding of a word by merges is the only sequence of tokens in which every neighbouring pair re-encodes to itself.
So the encoding of a prefix is fixed by its last token and a shorter prefix's encoding: a depth-first walk over the
sorted distinct words carries one last-token state per character position and computes each shared prefix once.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
# Fixed value: the word pattern that belongs to the vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Distinct words and token pairs that a task remembers; when full, they are forgotten and computed again.
REMEMBERED = 400_000
# Letters of a word beyond which it is encoded but not remembered, so that what is remembered is bounded in bytes too.
LONGEST_WORD = 64


class TrieEncoder:
    """Encodes words with merge ranks; remembers words and pairs up to a bound."""

    def __init__(self, ranks: dict[bytes, int], remembered: int = REMEMBERED) -> None:
        self.ranks, self.remembered = ranks, remembered
        self.longest = max(map(len, ranks))
        self.pairs: dict[tuple[bytes, bytes], bool] = {}
        self.known: dict[str, list[int]] = {}

    def _merged(self, left: bytes, right: bytes) -> bool:
        """Whether the two tokens stay two tokens when their bytes are encoded together, by plain merging."""
        key = (left, right)
        if (kept := self.pairs.get(key)) is None:
            parts = [bytes([b]) for b in left + right]
            while len(parts) > 1:
                rank, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 30), i) for i in range(len(parts) - 1))
                if rank == 1 << 30:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            if len(self.pairs) >= self.remembered:
                self.pairs.clear()
            kept = self.pairs[key] = parts == [left, right]
        return kept

    def learn(self, words: list[str]) -> None:
        """Encode distinct words: sorted, so that the walk visits the trie depth first; states[i] is the last token of
        the first i bytes, kept for as many bytes as the next word shares."""
        ranks, longest = self.ranks, self.longest
        states: list[bytes] = [b""]
        before = b""
        for raw, word in sorted((w.encode("utf-8"), w) for w in words):
            shared = len(os.path.commonprefix((before, raw)))
            del states[shared + 1 :]
            for end in range(shared + 1, len(raw) + 1):
                for start in range(max(0, end - longest), end):
                    token = raw[start:end]
                    if token in ranks and (not start or self._merged(states[start], token)):
                        states.append(token)
                        break
            before, ids, end = raw, [], len(raw)
            while end:
                token = states[end]
                ids.append(ranks[token])
                end -= len(token)
            self.known[word] = ids[::-1]

    def encode_batch(self, split: list[list[str]]) -> list[list[int]]:
        fresh = {w for ws in split for w in ws} - self.known.keys()
        if len(self.known) + len(fresh) > self.remembered:
            self.known.clear()
            fresh = {w for ws in split for w in ws}
        self.learn(list(fresh))
        known = self.known
        out = []
        for ws in split:
            ids: list[int] = []
            for w in ws:
                ids += known[w]
            out.append(ids)
        for w in fresh:
            if len(w) > LONGEST_WORD:
                del known[w]
        return out


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


_ENCODER: dict[str, TrieEncoder] = {}


def _encoder(name: str, ranks: Broadcast[dict[bytes, int]]) -> TrieEncoder:
    if name not in _ENCODER:
        _ENCODER[name] = TrieEncoder(ranks.value)
    return _ENCODER[name]


def encode_texts(df: DataFrame, doc_id: str = "doc_id", text: str = "text", vocabulary: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken") -> DataFrame:
    """(doc_id, ids): the token ids of every row, without special tokens; empty and null texts have an empty list.

    A narrow Arrow map with no shuffle: each batch adds its distinct new words to the task's encoder. Whole texts, one
    row out for each row in, repeated rows included; extra columns are not read. The vocabulary is read where the plan is
    made and broadcast: its size is fixed, whatever the corpus.
    """
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        split, encoder = regex.compile(PATTERN).findall, _encoder(vocabulary, shared)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for at in range(0, len(texts), 500):
                ids = encoder.encode_batch([split(t) if t else [] for t in texts[at : at + 500]])
                yield pa.RecordBatch.from_arrays([batch.column(0)[at : at + 500], pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    narrow = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    return narrow.mapInArrow(run, T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))]))
