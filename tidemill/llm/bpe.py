"""Problem 8: encoding a corpus with a public byte-level BPE tokenizer.

The vocabulary file is read once per Python worker from a path that is a parameter. A text is cut into words by the
tokenizer's pattern; a word's bytes form a doubly linked list of symbols, and the merges possible between neighbours wait
in a priority queue by rank. A queue entry whose two symbols have meanwhile changed is stale and is skipped. Merging costs
O(n log n) in the length of the word, so that a very long run of letters is no special case. Words repeat, so the ids of a
bounded number of short words are kept per worker (a cache, not a cap: others are merged again).
"""

from __future__ import annotations

import heapq
import json
import os
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folder of the public vocabulary files, and the one used by default.
FOLDER, VOCABULARY = "/opt/tokenizers", "byte_bpe_50k.json"
# Fixed value: the pre-tokenization pattern of this tokenizer.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words kept with their ids, and the length up to which they are kept.
CACHED, CACHED_LENGTH = 1 << 16, 64
#: Characters of text encoded into one output batch.
BATCH_CHARS = 1 << 21


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary: itself where it is printable, else the next
    free one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Tokenizer:
    """Byte-level BPE from a vocabulary file with ``model.vocab`` and ``model.merges``; special tokens are ordinary text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters = byte_letters()
        back = {c: b for b, c in letters.items()}
        raw = lambda s: bytes(back[c] for c in s)
        vocab = model["vocab"]
        known = set(letters.values())
        self.texts = {i: raw(t) for t, i in vocab.items() if set(t) <= known}
        self.single = [vocab[letters[b]] for b in range(256)]
        self.merges = {}
        for rank, m in enumerate(model["merges"]):
            left, right = m.split(" ") if isinstance(m, str) else m
            self.merges[vocab[left], vocab[right]] = (rank, vocab[left + right])
        self.words = regex.compile(PATTERN)
        self.cache: dict[str, list[int]] = {}

    def word(self, data: bytes) -> list[int]:
        """Ids of one word's bytes."""
        ids = [self.single[b] for b in data]
        n, merges = len(ids), self.merges
        if n < 2:
            return ids
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = []
        for i in range(n - 1):
            m = merges.get((ids[i], ids[i + 1]))
            if m:
                queue.append((m[0], i, ids[i], ids[i + 1], m[1]))
        heapq.heapify(queue)
        while queue:
            _, i, left, right, whole = heapq.heappop(queue)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # stale
            ids[i], ids[j] = whole, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                m = merges.get((whole, ids[k]))
                if m:
                    heapq.heappush(queue, (m[0], i, whole, ids[k], m[1]))
            h = before[i]
            if h >= 0:
                m = merges.get((ids[h], whole))
                if m:
                    heapq.heappush(queue, (m[0], h, ids[h], whole, m[1]))
        return [x for x in ids if x >= 0]

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text taken as it is, without special tokens; [] for empty and for null."""
        out: list[int] = []
        for w in self.words.findall(text) if text else ():
            ids = self.cache.get(w)
            if ids is None:
                ids = self.word(w.encode())
                if len(w) <= CACHED_LENGTH:
                    if len(self.cache) >= CACHED:
                        self.cache.clear()
                    self.cache[w] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids: their vocabulary strings one after the other."""
        return b"".join(self.texts[i] for i in ids).decode("utf-8", "replace")


@cache
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


def encode(documents: DataFrame, vocabulary: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids) of every row, one narrow pass without a shuffle; ids is empty for empty and null texts.

    Rows with null key keep it, repeated rows repeat; other columns are not read.
    """
    path = vocabulary or os.path.join(FOLDER, VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for b in batches:
            at, size, ids = 0, 0, []
            for n, x in enumerate(b.column(text).to_pylist(), 1):
                ids.append(t.encode(x))
                size += len(x or "")
                if size >= BATCH_CHARS or n == len(b):
                    yield pa.RecordBatch.from_arrays([b.column(key).slice(at, n - at), pa.array(ids, pa.list_(pa.int32()))], [key, "ids"])
                    at, size, ids = n, 0, []

    kind = documents.schema[key].dataType.simpleString()
    return documents.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str | None = None, key: str = "doc_id") -> DataFrame:
    """(key, text): vocabulary strings concatenated; the empty text for no ids."""
    path = vocabulary or os.path.join(FOLDER, VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for b in batches:
            texts = [t.decode(ids or []) for ids in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(key), pa.array(texts, pa.string())], [key, "text"])

    kind = encoded.schema[key].dataType.simpleString()
    return encoded.select(key, "ids").mapInArrow(run, f"`{key}` {kind}, text string")


def token_counts(spark: SparkSession, documents: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(lang, documents, tokens, chars) by language in lower case, over every row of the corpus in one pass: rows with null
    language are a group, null texts have no tokens and characters, repeated rows and null ids count like others."""
    path = vocabulary or os.path.join(FOLDER, VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for b in batches:
            texts = b.column("text").to_pylist()
            n, size = (pa.array(x, pa.int64()) for x in ([len(t.encode(x)) for x in texts], [len(x or "") for x in texts]))
            yield pa.RecordBatch.from_arrays([b.column("lang"), n, size], ["lang", "n", "size"])

    each = documents.select(F.lower("lang").alias("lang"), "text").mapInArrow(run, "lang string, n bigint, size bigint")
    return each.groupBy("lang").agg(F.count("*").alias("documents"), F.sum("n").alias("tokens"), F.sum("size").alias("chars"))
