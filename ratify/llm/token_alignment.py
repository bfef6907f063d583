"""Alignment of two tokenizers' tokens by their byte ranges, and how well id pairs agree corpus-wide.

Per batch, every token of all its documents is a row (document, start, end) of
a pandas frame, and ``merge_asof`` keyed by document finds for each token
start the other side's token that covers it.  Both directions together are all
overlaps.  An overlap whose ends are equal closes a group; the tokens between
two such places are one group, and every pair of its tokens is a link.

Counting needs no row for each document and pair.  A block (a bounded part of
an Arrow batch) keeps one list of its distinct id pairs with the number of its
documents that hold each; a document refers to places of that list.  Only the
lists are summed and joined over the corpus; their totals come back to the
block, where the documents add them up.  A pair that every document holds has
one row a block.

The ids are those of the public vocabulary files: the byte-level side is
merged by rank (``byte_bpe_50k.tiktoken``, the same ids as the .json), with
the .json's entries as token bytes, the other side by sentencepiece.

Defined results: texts that are null or empty, or whose tokens' bytes do not
make up a blank and the text, have no tokens and no groups; tie counts as
best; rows that repeat an id are documents of their own; an empty table gives
an empty table; other columns are ignored.  A group without inner common ends
costs the product of its distinct ids, as its links are those pairs.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratify.llm.common import arrow_schema, kept, map_arrow, materialise
from ratify.llm.token_counts import byte_alphabet

#: Bytes of text whose tokens are in one frame, and in one block; a longer text is one by itself.
FRAME_BYTES, BLOCK_BYTES = 1 << 20, 8 << 20
#: Pairs of a group up to which they are listed one by one.
WIDE = 1 << 12
BLOCKS = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "slots binary, times binary, pairs array<long>, holders array<int>")
FIGURES = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups_sha256 string")
ALIGNED = "doc_id long, a_ids array<int>, b_ids array<int>, a_in_group array<int>, b_in_group array<int>"


@dataclass(frozen=True)
class AlignParams:
    ranks: str = "byte_bpe_50k.tiktoken"
    entries: str = "byte_bpe_50k.json"
    pieces: str = "piece_bpe_32k.model"


def _digits(count: int) -> np.ndarray:
    """For each id its decimal digits as bytes, zeros before them, and a place for what follows."""
    table = np.zeros((count, len(str(count)) + 1), np.uint8)
    rest = np.arange(count)
    for place in range(table.shape[1] - 2, -1, -1):
        shown = (rest > 0) | (place == table.shape[1] - 2)
        table[:, place] = np.where(shown, 48 + rest % 10, 0)
        rest //= 10
    return table


class Tokens:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, params: AlignParams):
        path = public_tokenizers.path
        with open(path(params.ranks), "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.a = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path(params.pieces))
        with open(path(params.entries), encoding="utf-8") as file:
            vocab = json.load(file)["model"]["vocab"]
        byte_of = {c: i for i, c in enumerate(byte_alphabet())}
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for entry, i in vocab.items():
            self.a_bytes[i] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            raw = re.fullmatch("<0x([0-9A-F]{2})>", piece)
            self.b_bytes.append(bytes([int(raw[1], 16)]) if raw else piece.replace("▁", " ").encode())
        self.a_len, self.b_len = (np.array(list(map(len, t)), np.int64) for t in (self.a_bytes, self.b_bytes))
        self.digits = _digits(max(len(self.a_bytes), len(self.b_bytes)))

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The ids of each text by both; none where the bytes differ from a blank and the text."""
        none = np.zeros(0, np.int64)
        a_ids, b_ids = [], []
        for text, b in zip(texts, self.b.encode(texts, num_threads=1) if texts else [], strict=True):
            whole = f" {text}"
            a = self.a.encode_to_numpy(whole, disallowed_special=()).astype(np.int64) if text else none
            whole = whole.encode()
            # merging by rank only joins the text's own bytes, so the length tells whether all of them are there
            same = bool(text) and self.a_len[a].sum() == len(whole) and b"".join(map(self.b_bytes.__getitem__, b)) == whole
            a_ids.append(a if same else none)
            b_ids.append(np.array(b, np.int64) if same else none)
        return a_ids, b_ids


def _side(ids: list[np.ndarray], lengths: np.ndarray) -> tuple[pd.DataFrame, np.ndarray]:
    """The tokens of all texts with their byte ranges (texts end to end), and their ids."""
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int64)
    size = lengths[flat]
    end = np.cumsum(size)
    doc = np.repeat(np.arange(len(ids)), [len(i) for i in ids])
    return pd.DataFrame({"doc": doc, "start": end - size, "end": end, "token": np.arange(len(flat))}), flat


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """token_a, token_b, end_a, end_b of every overlapping pair: the covering token of each start, in both directions."""
    forth = pd.merge_asof(a, b, on="start", by="doc", suffixes=("_a", "_b"))
    back = pd.merge_asof(b, a.assign(begin=a["start"]), on="start", by="doc", suffixes=("_b", "_a"))
    back = back[back["begin"] < back["start"]]  # equal starts are in the other direction already
    columns = ["doc", "token_a", "token_b", "end_a", "end_b"]
    return pd.concat([forth[columns], back[columns]], ignore_index=True)


class Aligned:
    """Texts of a frame: tokens, groups (as token counts on both sides) and linked pairs."""

    def __init__(self, tokens: Tokens, texts: list[str]):
        self.tokens, self.texts = tokens, texts
        a_ids, b_ids = tokens.encode(texts)
        a, self.a = _side(a_ids, tokens.a_len)
        b, self.b = _side(b_ids, tokens.b_len)
        self.n_a, self.n_b = (np.array([len(i) for i in ids], np.int64) for ids in (a_ids, b_ids))
        pairs = overlaps(a, b)
        closing = pairs[pairs["end_a"] == pairs["end_b"]].sort_values("token_a")
        last_a, last_b = closing["token_a"].to_numpy(), closing["token_b"].to_numpy()
        self.in_a, self.in_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        self.doc = closing["doc"].to_numpy()
        self.groups = np.bincount(self.doc, minlength=len(texts))

    def links(self) -> np.ndarray:
        """Number of linked token pairs of each text."""
        return np.bincount(self.doc, weights=(self.in_a * self.in_b).astype(np.float64), minlength=len(self.texts)).astype(np.int64)

    def digests(self) -> list[str]:
        """The groups of each text as sha256 of their written form; '' without tokens."""
        n = len(self.in_a)
        order = np.argsort(np.concatenate((np.repeat(np.arange(n) * 2, self.in_a), np.repeat(np.arange(n) * 2 + 1, self.in_b))),
                           kind="stable")
        shown = self.tokens.digits[np.concatenate((self.a, self.b))[order]]
        shown[:, -1] = ord(",")
        ends = np.cumsum(np.stack((self.in_a, self.in_b), axis=1).ravel()) - 1
        shown[ends[::2], -1], shown[ends[1::2], -1] = ord("|"), ord(";")
        out, stops = [], np.cumsum(self.n_a + self.n_b)
        for size, stop in zip((self.n_a + self.n_b).tolist(), stops.tolist(), strict=True):
            own = shown[stop - size:stop].ravel()
            out.append(hashlib.sha256(own[own != 0][:-1].tobytes()).hexdigest() if size else "")
        return out

    def distinct_pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """text, pair (a id * number of b ids + b id), and how often it is linked there, in order of both."""
        count_b = len(self.tokens.b_bytes)
        area = len(self.tokens.a_bytes) * count_b
        first_a, first_b = np.cumsum(self.in_a) - self.in_a, np.cumsum(self.in_b) - self.in_b
        product = self.in_a * self.in_b
        plain = product <= WIDE
        many = np.where(plain, product, 0)
        group = np.repeat(np.arange(len(many)), many)
        step = np.arange(len(group)) - np.repeat(np.cumsum(many) - many, many)
        wide_b = self.in_b[group]
        keys = self.doc[group] * area + self.a[first_a[group] + step // wide_b] * count_b + self.b[first_b[group] + step % wide_b]
        keys, times = np.unique(keys, return_counts=True)
        found = [(keys, times)]
        for g in np.flatnonzero(~plain).tolist():
            a, n_a = np.unique(self.a[first_a[g]:first_a[g] + self.in_a[g]], return_counts=True)
            b, n_b = np.unique(self.b[first_b[g]:first_b[g] + self.in_b[g]], return_counts=True)
            found.append(((self.doc[g] * area + a[:, None] * count_b + b).ravel(), (n_a[:, None] * n_b).ravel()))
        if len(found) > 1:
            keys, at = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
            times = np.bincount(at, weights=np.concatenate([t for _, t in found])).astype(np.int64)
        return keys // area, keys % area, times


def parts(texts: list[str], most: int) -> Iterator[slice]:
    """Slices of about ``most`` bytes; a longer text is a slice of its own."""
    at = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield slice(at, i)
            at, size = i, 0
        size += len(text)
    if at < len(texts):
        yield slice(at, len(texts))


def _blocks(arrow: pa.Schema, params: AlignParams, batches):
    """Rows of BLOCKS: one for each document, and one a block with its pairs and their holders."""
    name = TaskContext.get().partitionId() << 32
    for batch in batches:
        tokens = kept(Tokens, params)
        texts = [t.as_py() or "" for t in batch.column(1)]
        for block in parts(texts, BLOCK_BYTES):
            own, columns, keys, docs, times = texts[block], [[] for _ in range(5)], [], [], []
            for part in parts(own, FRAME_BYTES):
                aligned = Aligned(tokens, own[part])
                for column, values in zip(columns, (aligned.n_a, aligned.n_b, aligned.groups, aligned.links(), aligned.digests()),
                                          strict=True):
                    column.extend(values)
                doc, key, often = aligned.distinct_pairs()
                docs.append(doc + part.start)
                keys.append(key)
                times.append(often)
            pairs, slot, holders = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
            slot, often = slot.astype("<u4"), np.concatenate(times)
            stops = np.searchsorted(np.concatenate(docs), np.arange(len(own) + 1)).tolist()
            n = len(own) + 1
            held = [slot[a:b].tobytes() for a, b in zip(stops, stops[1:])]  # noqa: B905, RUF007
            seen = [_narrow(often[a:b]) for a, b in zip(stops, stops[1:])]  # noqa: B905, RUF007
            made = [[name] * n, [*batch.column(0)[block.start:block.stop].to_pylist(), None], *([*c, None] for c in columns),
                    [*held, None], [*seen, None], [None] * (n - 1) + [pairs], [None] * (n - 1) + [holders.astype(np.int32)]]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(made, arrow, strict=True)], schema=arrow)
            name += 1


def _narrow(values: np.ndarray) -> bytes:
    """Counts in as few bytes each as the largest needs."""
    return values.astype(np.min_scalar_type(int(values.max()))).tobytes() if len(values) else b""


def _add_up(arrow: pa.Schema, docs: pa.Table, totals: pa.Table) -> pa.Table:
    """FIGURES of a block's documents from the totals of its pairs."""
    slot = totals.column("slot").to_numpy()
    count = np.zeros(int(slot.max()) + 1 if len(slot) else 0, np.int64)
    top = np.zeros(len(count), bool)
    count[slot], top[slot] = totals.column("total").to_numpy(), totals.column("top").to_numpy(zero_copy_only=False)
    best, summed = [], []
    for slots, times in zip(docs.column("slots").to_pylist(), docs.column("times").to_pylist(), strict=True):
        at = np.frombuffer(slots, "<u4")
        often = np.frombuffer(times, f"<u{len(times) // max(len(at), 1) or 1}").astype(np.int64)
        best.append(int(often[top[at]].sum()))
        summed.append(int((often * count[at]).sum()))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    return pa.Table.from_arrays([*(docs.column(c).combine_chunks() for c in names), pa.array(best, pa.int64()),
                                 pa.array(summed, pa.int64()), docs.column("groups_sha256").combine_chunks()], schema=arrow)


def _lean(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def alignment_figures(docs: DataFrame, params: AlignParams = AlignParams(), id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row."""
    blocks = materialise(map_arrow(_lean(docs, id_col, text_col), functools.partial(_blocks, arrow_schema(BLOCKS), params), BLOCKS), "aligned-blocks")
    listed = blocks.where("pairs IS NOT NULL").select(F.col("block").alias("of"), F.posexplode(F.arrays_zip("pairs", "holders")).alias("slot", "p")).select(
        "of", "slot", F.col("p.pairs").alias("pair"), F.col("p.holders").alias("holders"))
    totals = materialise(pair_totals(listed, _count_b(params)), "pair-totals")
    placed = listed.select("of", "slot", "pair").join(totals, "pair").select("of", "slot", "total", "top")
    add_up = functools.partial(_add_up, arrow_schema(FIGURES))
    return blocks.where("pairs IS NULL").drop("pairs", "holders").groupBy("block").cogroup(placed.groupBy("of")).applyInArrow(
        lambda own, counted: add_up(own, counted), FIGURES)


def _count_b(params: AlignParams) -> int:
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(params.pieces)).get_piece_size()


def pair_totals(listed: DataFrame, count_b: int) -> DataFrame:
    """pair, total (documents that hold it), top (no other pair of its A id has more)."""
    totals = materialise(listed.groupBy("pair").agg(F.sum("holders").alias("total")).withColumn(
        "a", F.expr(f"pair DIV {count_b}")), "pair-holders")
    most = totals.groupBy("a").agg(F.max("total").alias("most"))
    return totals.join(most, "a").select("pair", "total", (F.col("total") == F.col("most")).alias("top"))


def _aligned_rows(arrow: pa.Schema, params: AlignParams, batches):
    for batch in batches:
        tokens = kept(Tokens, params)
        texts = [t.as_py() or "" for t in batch.column(1)]
        for part in parts(texts, FRAME_BYTES):
            one = Aligned(tokens, texts[part])
            cut = lambda values, sizes: np.split(values.astype(np.int32), np.cumsum(sizes)[:-1])
            made = [cut(one.a, one.n_a), cut(one.b, one.n_b), cut(one.in_a, one.groups), cut(one.in_b, one.groups)]
            yield pa.RecordBatch.from_arrays([batch.column(0)[part.start:part.stop], *(
                pa.array(c, type=f.type) for c, f in zip(made, list(arrow)[1:], strict=True))], schema=arrow)


def alignments(docs: DataFrame, params: AlignParams = AlignParams(), id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """doc_id, the ids of both sides, and how many of each the groups hold, in order."""
    return map_arrow(_lean(docs, id_col, text_col), functools.partial(_aligned_rows, arrow_schema(ALIGNED), params), ALIGNED)
