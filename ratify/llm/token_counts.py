"""Token counts by rank-synchronous merging of ragged numpy arrays.

The pre-tokens of a batch lie end to end in one array with the sequence of
each symbol beside it.  A round looks up the rank of every adjacent pair,
takes the lowest rank of each sequence, merges all its occurrences (leftmost
first where they overlap) in every sequence at once, and lets go of sequences
without a pair.  What survives is counted.  A round's merges cannot make a
pair of a lower rank, because a vocabulary creates a symbol before the pairs
that hold it; so rounds equal one-at-a-time merging.  Sequences over
``LONG`` symbols use linked positions with one bucket for each rank, so that
a text without white space costs about its length, not its square.

Defined results: null or empty text has no tokens; an added token's string in
a text counts as that token, as is the library's default; repeated rows give
repeated rows; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from collections import defaultdict

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratify.llm.common import kept, map_texts, text_chunks

NONE = np.iinfo(np.int32).max
LONG = 2048


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself
    where it prints, else the next free code point from 256 on."""
    printing = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in printing]
    table = {b: chr(b) for b in printing} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [table[b] for b in range(256)]


class RankMerger:
    """Merge tables of a byte-level vocabulary file (.json) as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.byte_ids = np.array([vocab[c] for c in byte_alphabet()], dtype=np.int64)
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        added = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def surviving(self, pieces: list[bytes]) -> np.ndarray:
        """Number of symbols left of each piece."""
        counts = np.zeros(len(pieces), dtype=np.int64)
        short = [i for i, p in enumerate(pieces) if 0 < len(p) <= LONG]
        if short:
            counts[short] = self._ragged([pieces[i] for i in short])
        for i, p in enumerate(pieces):
            if len(p) > LONG:
                counts[i] = self._linked(self.byte_ids[np.frombuffer(p, np.uint8)])
        return counts

    def _ragged(self, pieces: list[bytes]) -> np.ndarray:
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        symbols = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        names, counts = np.arange(len(pieces)), sizes.copy()  # names: of the sequences still at work
        while symbols.size:
            starts = np.cumsum(sizes) - sizes
            rank = np.full(symbols.size, NONE, dtype=np.int32)
            rank[:-1] = self.rank_of(symbols[:-1], symbols[1:])
            rank[starts + sizes - 1] = NONE
            lowest = np.minimum.reduceat(rank, starts)
            hits = np.flatnonzero((rank == np.repeat(lowest, sizes)) & (rank != NONE))
            if hits.size:
                hits = hits[_every_second(np.diff(hits) == 1)]
            symbols[hits] = self.made[rank[hits]]
            keep = np.ones(symbols.size, dtype=bool)
            keep[hits + 1] = False
            sizes = sizes - np.add.reduceat(~keep, starts, dtype=np.int64)
            counts[names] = sizes
            open_ = lowest != NONE
            keep &= np.repeat(open_, np.diff(np.append(starts, symbols.size)))
            symbols, names, sizes = symbols[keep], names[open_], sizes[open_]
        return counts

    def _linked(self, symbols: np.ndarray) -> int:
        n = left = len(symbols)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        rank = np.append(self.rank_of(symbols[:-1], symbols[1:]), NONE).astype(np.int32)
        waiting: dict[int, list[np.ndarray]] = defaultdict(list)
        heap: list[int] = []

        def wait(at: np.ndarray) -> None:
            at = at[rank[at] != NONE]
            if not at.size:
                return
            at = at[np.argsort(rank[at], kind="stable")]
            values, first = np.unique(rank[at], return_index=True)
            for value, group in zip(values.tolist(), np.split(at, first[1:]), strict=True):
                if value not in waiting:
                    heapq.heappush(heap, value)
                waiting[value].append(group)

        if n > 1:
            wait(np.arange(n))
        while heap:
            value = heapq.heappop(heap)
            at = np.unique(np.concatenate(waiting.pop(value)))
            at = at[rank[at] == value]
            if not at.size:
                continue
            at = at[_every_second(after[at[:-1]] == at[1:])]
            gone = after[at]
            symbols[at], rank[gone], after[at] = self.made[value], NONE, after[gone]
            inner = after[at] < n
            before[after[at][inner]] = at[inner]
            left -= at.size
            near = np.unique(np.concatenate([at, before[at][before[at] >= 0]]))
            follows = after[near]
            ends = follows >= n
            rank[near] = np.where(ends, NONE, self.rank_of(symbols[near], symbols[np.where(ends, 0, follows)]))
            wait(near)
        return left


def _every_second(touching: np.ndarray) -> np.ndarray:
    """Mask of hits to merge when ``touching[i]`` says that hits i and i + 1 overlap:
    of each run of overlapping hits the first, third and so on."""
    at = np.arange(len(touching) + 1)
    begins = np.append(True, ~touching)
    return (at - np.maximum.accumulate(np.where(begins, at, 0))) % 2 == 0


def merger(path: str) -> RankMerger:
    return kept(RankMerger, path)


class BatchCounter:
    """Counts tokens of texts; groups texts into batches of about ``batch_chars``
    and remembers at most ``memory`` distinct pre-tokens between batches."""

    def __init__(self, path: str, pattern: str, batch_chars: int = 1 << 21, memory: int = 400_000):
        self.merge, self.pattern = merger(path), regex.compile(pattern)
        self.batch_chars, self.memory, self.known = batch_chars, memory, {}

    def __call__(self, texts) -> list:
        totals: list[int] = []
        held: list[tuple[int, list[str]]] = []
        chars = 0
        for text in texts:
            row, specials = len(totals), 0
            totals.append(0)
            for part in self.merge.added.split(text) if self.merge.added else [text]:
                specials += 1
                for chunk in text_chunks(part, self.batch_chars):
                    held.append((row, self.pattern.findall(chunk)))
                    chars += len(chunk)
                    if chars >= self.batch_chars:
                        self._settle(held, totals)
                        held, chars = [], 0
            totals[row] += max(0, specials - 1)
        self._settle(held, totals)
        return [totals]

    def _settle(self, held: list, totals: list[int]) -> None:
        if len(self.known) > self.memory:
            self.known.clear()
        fresh: set[str] = set()
        for _, pieces in held:
            fresh.update(pieces)
        new = [p for p in fresh if p not in self.known]
        self.known.update(zip(new, self.merge.surviving([p.encode() for p in new]).tolist(), strict=True))
        for row, pieces in held:
            totals[row] += sum(map(self.known.__getitem__, pieces))


def token_counts(docs: DataFrame, vocabulary: str | None = None, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text", pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every
    document, by the byte-level vocabulary file ``vocabulary``; cases as above."""
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    counted = map_texts(
        docs.select(id_col, text_col), functools.partial(_count_with_bytes, path, pattern),
        "n_bytes long, n_tokens long", id_col, text_col)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def _count_with_bytes(path: str, pattern: str):
    count = BatchCounter(path, pattern)

    def work(texts) -> list:
        sizes: list[int] = []

        def seen():
            for text in texts:
                sizes.append(len(text.encode()))
                yield text

        (totals,) = count(seen())
        return [sizes, totals]

    return work
