"""Byte-level BPE as a monoid: encodings of neighbours join into one.

Encoding is a tree reduction.  A text is halved at places that no pre-token
spans, down to leaves that are split into pre-tokens; a pre-token is halved
in its bytes, down to ``LEAF_BYTES`` that merge directly.  Two neighbouring
encodings of one pre-token join by encoding anew the bytes of a window around
the seam.  The window grows on a side until the last token outside and the
first token inside, taken as two, encode to themselves: a sequence of tokens
is the encoding of its bytes exactly if each adjacent pair is, so the tokens
outside are then final.  Decoding maps ids to bytes in leaves and
concatenates up the tree.

Defined results: null or empty text gives no ids and empty bytes; repeated
rows give repeated rows; an empty table gives an empty table; a text without
white space is one long pre-token and costs n log n; other columns are
ignored; ids that the vocabulary lacks make ``decode`` raise.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import struct

import numpy as np
import public_tokenizers
import regex
from pyspark.sql import DataFrame

from ratify.llm.common import kept, map_texts, middle_cut

#: Nodes up to LEAF_BYTES merge directly; those up to KNOWN_BYTES are remembered.
LEAF_BYTES = 3
KNOWN_BYTES = 6
LEAF_CHARS = 1 << 17
LEAF_IDS = 1 << 16
#: Entries that a worker remembers at most: pre-tokens (about 200 bytes each), and parts of them.
MEMORY_PIECES = 250_000
MEMORY = 100_000


class ByteBPE:
    """Encoder and decoder for a rank file (.tiktoken)."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        self.packed: dict[str, bytes] = {}   # pre-token -> its ids as little-endian words
        self.parts: dict[bytes, tuple] = {}    # nodes of up to KNOWN_BYTES -> their ids
        self.windows: dict[bytes, tuple] = {}  # windows around seams -> their ids
        self.pairs: dict[tuple, bool] = {}   # two ids -> encode to themselves

    # encoding ---------------------------------------------------------------
    def encode(self, text: str) -> bytes:
        """The ids of ``text`` as little-endian unsigned 32-bit words."""
        if len(text) > LEAF_CHARS:
            cut = middle_cut(text)
            if cut < len(text):
                return self.encode(text[:cut]) + self.encode(text[cut:])
        if len(self.packed) > MEMORY_PIECES:
            self.packed.clear()
        pieces = self.pattern.findall(text)
        for piece in set(pieces).difference(self.packed):
            self.packed[piece] = pack(self.piece(piece.encode()))
        return b"".join(map(self.packed.__getitem__, pieces))

    def piece(self, data: bytes) -> tuple:
        """The ids of one pre-token."""
        whole = self.ranks.get(data)
        return (whole,) if whole is not None else self._tree(data)

    def _tree(self, data: bytes) -> tuple:
        size = len(data)
        if size > KNOWN_BYTES:
            return self._join(self._tree(data[:size // 2]), self._tree(data[size // 2:]))
        known = self.parts.get(data)
        if known is None:
            half = size // 2
            self._remember(self.parts, data, known := self._merged(data) if size <= LEAF_BYTES else self._join(
                self._tree(data[:half]), self._tree(data[half:])))
        return known

    @staticmethod
    def _remember(memo: dict, key, value) -> None:
        if len(memo) > MEMORY:
            memo.clear()
        memo[key] = value

    def _join(self, left: tuple, right: tuple) -> tuple:
        i, j, step = len(left) - 1, 1, 1
        while True:
            middle = self._window(b"".join(map(self.tokens.__getitem__, left[i:] + right[:j])))
            grow_left = i > 0 and not self._settled(left[i - 1], middle[0])
            grow_right = j < len(right) and not self._settled(middle[-1], right[j])
            if not (grow_left or grow_right):
                return left[:i] + middle + right[j:]
            i = max(0, i - step) if grow_left else i
            j = min(len(right), j + step) if grow_right else j
            step *= 2

    def _window(self, data: bytes) -> tuple:
        if len(data) > 2 * KNOWN_BYTES:
            return self._merged(data)
        known = self.windows.get(data)
        if known is None:
            self._remember(self.windows, data, known := self._merged(data))
        return known

    def _settled(self, a: int, b: int) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            self._remember(self.pairs, (a, b), known := self._merged(self.tokens[a] + self.tokens[b]) == (a, b))
        return known

    def _merged(self, data: bytes) -> tuple:
        """Direct merging: the lowest rank first, the leftmost of equals."""
        if len(data) > 256:
            return self._merged_long(data)
        ranks, parts = self.ranks, [data[i:i + 1] for i in range(len(data))]
        near = [ranks.get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
        while (best := min((r for r in near if r is not None), default=None)) is not None:
            i = near.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del near[i]
            if i < len(near):
                near[i] = ranks.get(parts[i] + parts[i + 1])
            if i:
                near[i - 1] = ranks.get(parts[i - 1] + parts[i])
        return tuple(map(ranks.__getitem__, parts))

    def _merged_long(self, data: bytes) -> tuple:
        ranks, n = self.ranks, len(data)
        parts: list = [data[i:i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(data[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, size = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else n
            if j >= n or len(parts[i]) + len(parts[j]) != size or ranks.get(parts[i] + parts[j]) != rank:
                continue
            parts[i], parts[j], after[i] = parts[i] + parts[j], None, after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (r := ranks.get(parts[a] + parts[b])) is not None:
                    heapq.heappush(heap, (r, a, len(parts[a]) + len(parts[b])))
        return tuple(ranks[p] for p in parts if p is not None)

    # decoding ---------------------------------------------------------------
    def decode(self, packed: bytes) -> bytes:
        """The bytes that packed ids stand for."""
        n = len(packed) // 4
        if n > LEAF_IDS:
            half = n // 2 * 4
            return self.decode(packed[:half]) + self.decode(packed[half:])
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(packed, dtype="<u4").tolist()))


def pack(ids: tuple) -> bytes:
    """Ids as little-endian unsigned 32-bit words."""
    return struct.pack(f"<{len(ids)}I", *ids)


def coder(path: str, pattern: str) -> ByteBPE:
    return kept(ByteBPE, path, pattern)


def _encode(path: str, pattern: str):
    bpe = coder(path, pattern)

    def work(texts) -> list:
        ids = [bpe.encode(t) for t in texts]
        return [[len(x) // 4 for x in ids], ids]

    return work


def _decode(path: str, pattern: str):
    bpe = coder(path, pattern)
    return lambda packed: [[bpe.decode(x) for x in packed]]


def _digests(path: str, pattern: str):
    bpe = coder(path, pattern)

    def work(texts) -> list:
        out: list = [[], [], []]
        for text in texts:
            ids = bpe.encode(text)
            out[0].append(len(ids) // 4)
            out[1].append(hashlib.sha256(ids).hexdigest())
            out[2].append(hashlib.sha256(bpe.decode(ids)).hexdigest())
        return out

    return work


def _files(vocabulary: str | None, pattern: str | None) -> tuple[str, str]:
    return vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN


def encode(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (binary: little-endian unsigned 32-bit words) of every document."""
    return map_texts(docs, functools.partial(_encode, *_files(vocabulary, pattern)), "n_tokens long, ids binary",
                     id_col, text_col)


def decode(tokens: DataFrame, vocabulary: str | None = None, pattern: str | None = None, id_col: str = "doc_id",
           ids_col: str = "ids") -> DataFrame:
    """doc_id, data (binary: the bytes of the text) for packed ids as ``encode`` gives them."""
    return map_texts(tokens, functools.partial(_decode, *_files(vocabulary, pattern)), "data binary",
                     id_col, ids_col, kind="binary")


def encode_digests(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every document in one pass and keep only digests: doc_id,
    n_tokens, ids_sha256 and decoded_sha256; ids do not leave the worker."""
    return map_texts(docs, functools.partial(_digests, *_files(vocabulary, pattern)),
                     "n_tokens long, ids_sha256 string, decoded_sha256 string", id_col, text_col)
