"""Encoding of a corpus with a public byte-level BPE vocabulary.

Method: speculate and verify. A text is cut into words by the tokenizer's pattern; for each distinct
word of a batch a greedy longest match proposes tokens; all adjacent pairs of all proposals are tested
at once, as arrays, for compatibility (whether the merge rules would leave the two tokens side by side);
a proposal whose every pair is compatible is the encoding, and only the failing words are merged
exactly, pair by pair. Ids are those of the vocabulary; no special token is ever produced.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Folder of the public tokenizer files; a parameter of every operator here.
TOKENIZERS = os.environ.get("FOLIANT_TOKENIZERS", "/opt/tokenizers")
#: Distinct words whose encodings a worker keeps between batches.
KEPT_WORDS = 400_000
# Fixed value: how the tokenizer cuts text into words.
WORD_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file, by its rule."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown}
    hidden = [b for b in range(256) if b not in set(shown)]
    return letters | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """A vocabulary with its merges, ready to propose and verify."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters = byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        self.ids: dict[bytes, int] = {as_bytes(t): i for t, i in model["vocab"].items() if all(c in letters for c in t)}
        size = max(self.ids.values()) + 1
        rank_of: dict[tuple[int, int], tuple[int, int]] = {}
        self.rank = np.full(size, -1, np.int64)  # the rank of the merge that makes the token; -1: a byte
        self.left, self.right = np.arange(size, dtype=np.int64), np.arange(size, dtype=np.int64)
        made: set[bytes] = {t for t in self.ids if len(t) == 1}
        for r, m in enumerate(model["merges"]):
            a, b = (as_bytes(x) for x in (m.split(" ") if isinstance(m, str) else m))
            i, j, k = self.ids[a], self.ids[b], self.ids[a + b]
            rank_of[i, j] = (r, k)
            if a + b not in made:
                made.add(a + b)
                self.rank[k], self.left[k], self.right[k] = r, i, j
        self.pairs = rank_of
        keys = np.array([i * size + j for i, j in rank_of], np.int64)
        order = np.argsort(keys)
        self.size, self.pair_keys = size, keys[order]
        self.pair_ranks = np.array([r for r, _ in rank_of.values()], np.int64)[order]
        self.longest = {b: 0 for b in range(256)}
        for t in made:
            self.longest[t[0]] = max(self.longest[t[0]], len(t))
        self.pattern = regex.compile(WORD_PATTERN)
        self.known: dict[str, tuple[int, ...]] = {}

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match."""
        out, at, end, ids = [], 0, len(word), self.ids
        while at < end:
            stop = min(end, at + self.longest[word[at]])
            while (t := ids.get(word[at:stop])) is None:
                stop -= 1
            out.append(t)
            at = stop
        return out

    def ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair; a huge number where there is none."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], np.iinfo(np.int64).max)

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the merge rules keep each pair of tokens apart.

        The pieces that touch at the seam are followed back through their merges, the later merge first;
        if the two then at the seam could have been merged earlier than what was undone so far, the
        rules would have joined them.
        """
        a, b = a.astype(np.int64).copy(), b.astype(np.int64).copy()
        good = np.ones(len(a), bool)
        live = np.arange(len(a))
        # rank before which a seam merge would have come: of the left piece's next merge a tie goes left
        limit = np.full(len(a), np.iinfo(np.int64).max)
        while len(live):
            x, y = a[live], b[live]
            seam = self.ranks_of(x, y)
            bad = seam < limit[live]
            good[live[bad]] = False
            live, x, y = live[~bad], x[~bad], y[~bad]
            rx, ry = self.rank[x], self.rank[y]
            done = (rx < 0) & (ry < 0)
            live, x, y, rx, ry = live[~done], x[~done], y[~done], rx[~done], ry[~done]
            undo_left = rx > ry
            # equal merges run from left to right: the left one comes first, so the right one is undone first
            limit[live] = np.where(undo_left, rx, ry + 1)
            a[live] = np.where(undo_left, self.right[x], x)
            b[live] = np.where(undo_left, y, self.left[y])
        return good

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: again and again the adjacent pair of the least rank, leftmost first."""
        import heapq

        part = [self.ids[bytes((c,))] for c in word]
        n = len(part)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = []
        for i in range(n - 1):
            if found := self.pairs.get((part[i], part[i + 1])):
                heap.append((found[0], i, part[i], part[i + 1], found[1]))
        heapq.heapify(heap)
        gone = bytearray(n)
        while heap:
            _, i, x, y, made = heapq.heappop(heap)
            j = after[i]
            if gone[i] or part[i] != x or j < 0 or part[j] != y:
                continue
            part[i], gone[j] = made, 1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right >= 0 and (found := self.pairs.get((part[left], part[right]))):
                    heapq.heappush(heap, (found[0], left, part[left], part[right], found[1]))
        return [p for p, dead in zip(part, gone, strict=True) if not dead]

    def learn(self, words: list[str]) -> None:
        """Encode distinct words not met before: proposals, one check of all their pairs, exact merging of the rest."""
        if not words:
            return
        if len(self.known) + len(words) > KEPT_WORDS:
            self.known.clear()
        raw = [w.encode("utf-8", "replace") for w in words]
        proposals = [self.propose(r) for r in raw]
        sizes = np.fromiter((len(p) for p in proposals), np.int64, len(proposals))
        flat = np.fromiter((t for p in proposals for t in p), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(words)), sizes)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        failed = np.zeros(len(words), bool)
        failed[owner[inner][~self.compatible(flat[inner], flat[inner + 1])]] = True
        for w, r, p, f in zip(words, raw, proposals, failed, strict=True):
            self.known[w] = tuple(self.merge(r) if f else p)

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text; null and empty give an empty list."""
        cut = [self.pattern.findall(t) if t else [] for t in texts]
        fresh = {w for words in cut for w in words if w not in self.known}
        if len(self.known) + len(fresh) > KEPT_WORDS:
            fresh = {w for words in cut for w in words}
        self.learn(list(fresh))
        known = self.known
        return [[t for w in words for t in known[w]] for words in cut]


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def tokenizer_path(name: str = "byte_bpe_50k", folder: str | None = None) -> str:
    return f"{folder or TOKENIZERS}/{name}.json"


def with_token_ids(df: DataFrame, column: str = "text", name: str = "byte_bpe_50k", out: str = "ids", folder: str | None = None) -> DataFrame:
    """The table with the text column's token ids added; null and empty texts give an empty list."""
    path = tokenizer_path(name, folder)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = encoder(path)
        for s in batches:
            yield pd.Series(e.encode([t if isinstance(t, str) else None for t in s]), dtype=object)

    return df.withColumn(out, ids(F.col(column)))


def with_token_count(df: DataFrame, column: str = "text", name: str = "byte_bpe_50k", out: str = "n_tokens", folder: str | None = None) -> DataFrame:
    """The table with the text's number of tokens added; 0 for null and empty texts."""
    path = tokenizer_path(name, folder)

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = encoder(path)
        for s in batches:
            yield pd.Series([len(x) for x in e.encode([t if isinstance(t, str) else None for t in s])], dtype="int64")

    return df.withColumn(out, count(F.col(column)))
