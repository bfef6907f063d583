"""Benchmark decontamination with suffix arrays over the training texts.

Documents are cut into shards of a bounded number of words.  A task turns a
shard's words into the ids of the benchmark's vocabulary (0: not in it) and
builds the suffix array of the runs of known words that are long enough to
hold a window; a suffix outside such a run cannot begin one.  Every test
suffix is then binary-searched, all of them at once: word by word the interval
of training suffixes that agree with it narrows.  From ``window`` words on (an
item of fewer words is one window) every suffix that leaves the interval is a
verbatim match of the length reached, so each match is found once, with its
place and its longest extent.  Affected documents are removed by id and text.

The benchmark is the stated query set.  It goes to all shards in blocks: its
items are cut into pieces of bounded length that overlap by a window less one,
and a pass carries pieces of ``block_bytes`` at most (besides one piece), so
what is broadcast is bounded whatever the benchmark's size.  One block is
usual; the passes of several are merged by id and text.

Words are runs of ASCII letters and digits (A-Z as a-z) and of all other
characters beyond ASCII.

Defined results: null or empty text has no words and no match; an item
without words matches nothing; items that repeat an id count as one, a null
item id as the empty one; a row of null id is matched and removed by its text;
repeated rows give repeated rows; an empty documents table gives an empty
table, an empty benchmark leaves all clean; other columns are ignored by
``find_leaks`` and pass through ``decontaminate``.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratify.llm.common import arrow_schema, byte_chunks, map_arrow, materialise

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SPANS = "array<struct<first:int,last:int>>"
FOUND = "array<struct<item_id:string,n_words:int,doc_word:int,item_word:int>>"
LEAKS = f"doc_id long, text_key binary, n_words int, spans {SPANS}, found {FOUND}"
PIECES = "item_id string, need int, at int, words binary"
#: Matches that are expanded at once.
_PAIRS = 1 << 21


@dataclass(frozen=True)
class LeakParams:
    window: int = 10
    piece_words: int = 2000
    block_bytes: int = 32 << 20
    shard_bytes: int = 16 << 20


@dataclass
class Suite:
    """Test suffixes of one block: the words of all pieces end to end as vocabulary ids."""
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    words: np.ndarray = None
    starts: np.ndarray = None  # of the suffixes that are long enough, in ``words``
    left: np.ndarray = None    # words from there to the piece's end
    need: np.ndarray = None    # words that a match has at least
    item: np.ndarray = None    # index into ``items``
    place: np.ndarray = None   # word of the item
    items: list[str] = field(default_factory=list)
    least: int = 1

    @classmethod
    def of(cls, rows: list) -> Suite:
        suite, index, parts = cls(), {}, []
        starts, left, need, item, place = ([] for _ in range(5))
        total = 0
        for row in rows:
            words = bytes(row.words).split(b" ")
            ids = np.array([suite.vocabulary.setdefault(w, len(suite.vocabulary) + 1) for w in words], np.int32)
            many = len(ids) - row.need + 1
            own = index.setdefault(row.item_id, len(index))
            steps = np.arange(many)
            starts.append(total + steps)
            left.append(len(ids) - steps)
            need.append(np.full(many, row.need))
            item.append(np.full(many, own))
            place.append(row.at + steps)
            parts.append(ids)
            total += len(ids)
        join = lambda lists, kind=np.int64: np.concatenate(lists).astype(kind) if lists else np.zeros(0, kind)
        suite.words, suite.items = join(parts, np.int32), list(index)
        suite.starts, suite.left, suite.need, suite.item, suite.place = map(join, (starts, left, need, item, place))
        suite.least = int(suite.need.min()) if len(suite.need) else 1
        return suite


def text_words(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a bounded piece of it at a time."""
    for chunk in byte_chunks(data):
        yield _WORD.findall(chunk.lower())


def suffix_array(x: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``x`` in the order of their suffixes, as far as ``depth`` words tell them apart.

    Prefix doubling; only groups that are still equal are sorted again.  Zeros
    end a run: no suffix reads on behind one.
    """
    n = len(x)
    order = np.argsort(x, kind="stable")
    ranked = x[order]
    first = np.concatenate(([True], ranked[1:] != ranked[:-1])) | (ranked == 0)
    rank = np.empty(n + 1, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank[n] = -1
    reach = 1
    while reach < depth:
        alone = first & np.append(first[1:], True)
        open_ = np.flatnonzero(~alone)
        if not len(open_):
            break
        own = order[open_]
        key = rank[own] * (n + 1) + rank[np.minimum(own + reach, n)] + 1
        by = np.argsort(key, kind="stable")
        own, key = own[by], key[by]
        order[open_] = own
        fresh = np.concatenate(([True], key[1:] != key[:-1]))
        first[open_] = fresh
        rank[own] = open_[np.maximum.accumulate(np.where(fresh, np.arange(len(own)), 0))]
        reach *= 2
    return order


def _bound(x: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int, word: np.ndarray) -> np.ndarray:
    """First entry of each interval whose word at ``depth`` is not under ``word``."""
    low, high = low.copy(), high.copy()
    while len(at := np.flatnonzero(low < high)):
        middle = (low[at] + high[at]) >> 1
        under = x[order[middle] + depth] < word[at]
        low[at[under]] = middle[under] + 1
        high[at[~under]] = middle[~under]
    return low


def search(suite: Suite, x: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, ...]:
    """Matches as ranges of the suffix array: test suffix, first entry, last entry (exclusive), words."""
    asked = np.arange(len(suite.starts))
    low, high = np.zeros(len(asked), np.int64), np.full(len(asked), len(x))
    out = []
    depth = 0
    while len(asked):
        over = suite.left[asked] == depth
        if over.any():
            out.append((asked[over], low[over], high[over], np.full(over.sum(), depth)))
            asked, low, high = asked[~over], low[~over], high[~over]
        word = suite.words[suite.starts[asked] + depth]
        begin = _bound(x, order, low, high, depth, word)
        end = _bound(x, order, begin, high, depth, word + 1)
        wide = suite.need[asked] <= depth  # what leaves the interval now is a match of ``depth`` words
        for a, b in ((low, begin), (end, high)):
            some = wide & (a < b)
            out.append((asked[some], a[some], b[some], np.full(some.sum(), depth)))
        stay = begin < end
        asked, low, high = asked[stay], begin[stay], end[stay]
        depth += 1
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 4


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first, first + 1, ... for each pair, end to end."""
    return np.repeat(first - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum())


class _Shard:
    """The words of some texts, and what of the suite occurs in them."""

    def __init__(self, suite: Suite, texts: list[bytes]):
        get, zero = suite.vocabulary.get, itertools.repeat(0)
        parts, self.sizes = [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            for words in text_words(text):
                self.sizes[i] += len(words)
                parts.append(np.fromiter(map(get, words, zero), np.int32, len(words)))
            parts.append(np.zeros(1, np.int32))
        flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes + 1)[:-1]))
        self.spans: list[list] = [[] for _ in texts]
        self.found: list[list] = [[] for _ in texts]
        known = np.concatenate(([0], (flat != 0).view(np.int8), [0]))
        turn = np.diff(known)
        begin, end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
        long = end - begin >= suite.least
        begin, end = begin[long], end[long]
        if not len(begin) or not len(suite.starts):
            return
        places = _ranges(begin, end - begin + 1)  # with the zero behind each run
        x = flat[places]
        order = suffix_array(x, int(suite.left.max()))
        self._collect(suite, places, order, search(suite, x, order), len(flat))

    def _collect(self, suite: Suite, places: np.ndarray, order: np.ndarray, ranges: tuple, n: int) -> None:
        asked, low, high, words = ranges
        reach = np.zeros(n, np.int64)
        best = np.zeros((0, 5), np.int64)  # text, item, words, place in the text, place in the item
        size = high - low
        at = 0
        while at < len(asked):
            stop = max(at + 1, int(np.searchsorted(np.cumsum(size[at:]), _PAIRS)) + at)
            own = size[at:stop]
            place = places[order[_ranges(low[at:stop], own)]]
            test, length = np.repeat(asked[at:stop], own), np.repeat(words[at:stop], own)
            np.maximum.at(reach, place, length)
            text = np.searchsorted(self.starts, place, "right") - 1
            best = _best(np.concatenate((best, np.stack(
                [text, suite.item[test], length, place - self.starts[text], suite.place[test]], axis=1))))
            at = stop
        covered = np.arange(n) < np.maximum.accumulate(np.where(reach > 0, np.arange(n) + reach, 0))
        turn = np.diff(np.concatenate(([0], covered.view(np.int8), [0])))
        for first, last in zip(np.flatnonzero(turn == 1).tolist(), np.flatnonzero(turn == -1).tolist(), strict=True):
            text = int(np.searchsorted(self.starts, first, "right") - 1)
            begin = int(self.starts[text])
            self.spans[text].append({"first": first - begin, "last": last - begin})
        for text, item, length, place, of_item in best.tolist():
            self.found[text].append({"item_id": suite.items[item], "n_words": length, "doc_word": place, "item_word": of_item})


def _best(rows: np.ndarray) -> np.ndarray:
    """The longest match of each text and item; of equal ones the first."""
    text, item, length, place, of_item = rows.T
    rows = rows[np.lexsort((of_item, place, -length, item, text))]
    return rows[np.concatenate(([True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)))] if len(rows) else rows


def _shards(texts: list[bytes], most: int) -> Iterator[slice]:
    at = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield slice(at, i)
            at, size = i, 0
        size += len(text)
    if at < len(texts):
        yield slice(at, len(texts))


def _leaks(arrow: pa.Schema, suite, shard_bytes: int, batches):
    for batch in batches:
        texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column(1)]
        for own in _shards(texts, shard_bytes):
            shard = _Shard(suite.value, texts[own])
            keys = [hashlib.sha256(t).digest() for t in texts[own]]
            columns = [batch.column(0)[own.start:own.stop], keys, shard.sizes, shard.spans, shard.found]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)],
                schema=arrow)


def _pieces(arrow: pa.Schema, params: LeakParams, batches):
    step = params.piece_words - params.window + 1
    for batch in batches:
        rows = []
        for item, text in zip(*batch.to_pydict().values(), strict=True):
            words = list(itertools.chain.from_iterable(text_words((text or "").encode())))
            need = min(params.window, len(words))
            for at in range(0, max(len(words) - params.window + 1, 1), step) if words else ():
                rows.append({"item_id": item, "need": need, "at": at, "words": b" ".join(words[at:at + params.piece_words])})
        yield pa.RecordBatch.from_pylist(rows, schema=arrow)


def benchmark_pieces(benchmark: DataFrame, params: LeakParams, item_col: str = "item_id",
                     text_col: str = "text") -> tuple[DataFrame, int]:
    """Pieces of the items with the ``block`` that carries each, and the number of blocks."""
    if not 0 < params.window <= params.piece_words:
        raise ValueError("a piece has to hold a window")
    lean = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item_id"),
                            F.col(text_col).alias("text"))
    pieces = materialise(map_arrow(lean, functools.partial(_pieces, arrow_schema(PIECES), params), PIECES), "benchmark-pieces")
    total, most = pieces.agg(F.sum(F.length("words")), F.max(F.length("words"))).first()
    blocks = max(1, -(-(total or 0) // params.block_bytes))
    while True:
        dealt = pieces.withColumn("block", F.pmod(F.xxhash64("item_id", "at", "words"), F.lit(blocks)))
        if blocks == 1:
            return dealt, blocks
        largest = dealt.groupBy("block").agg(F.sum(F.length("words")).alias("n")).agg(F.max("n")).first()[0]
        if largest <= 2 * params.block_bytes + most:
            return dealt, blocks
        blocks *= 2


def _merged(passes: list[DataFrame]) -> DataFrame:
    """One row for each document from the passes over several blocks."""
    rows = functools.reduce(DataFrame.unionByName, passes)
    grouped = rows.groupBy("doc_id", "text_key", "n_words").agg(
        (F.count(F.lit(1)) / len(passes)).cast("int").alias("copies"), F.flatten(F.collect_list("spans")).alias("spans"),
        F.flatten(F.collect_list("found")).alias("found"))
    joined = F.expr(f"""aggregate(array_sort(spans), cast(array() AS {SPANS}), (kept, x) ->
        CASE WHEN size(kept) > 0 AND element_at(kept, -1).last >= x.first
        THEN concat(slice(kept, 1, size(kept) - 1), array(named_struct('first', element_at(kept, -1).first,
             'last', greatest(element_at(kept, -1).last, x.last))))
        ELSE concat(kept, array(x)) END)""")
    longest = F.expr("transform(array_distinct(transform(found, f -> f.item_id)), i -> "
                     "array_max(filter(found, f -> f.item_id = i)))")
    return grouped.withColumn("_copy", F.explode(F.sequence(F.lit(1), "copies"))).select(
        "doc_id", "text_key", "n_words", joined.alias("spans"), longest.alias("found"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, params: LeakParams = LeakParams(), id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """doc_id, text_key (sha256), n_words, spans (runs of hit words) and found (item_id, n_words of its longest
    verbatim match, and where that begins in the document and the item) of every row."""
    spark = docs.sparkSession
    lean = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces, blocks = benchmark_pieces(benchmark, params)
    passes = []
    for block in range(blocks):
        suite = Suite.of(pieces.where(F.col("block") == block).orderBy("item_id", "at", "words").collect())
        search_in = functools.partial(_leaks, arrow_schema(LEAKS), spark.sparkContext.broadcast(suite), params.shard_bytes)
        made = map_arrow(lean, search_in, LEAKS)
        passes.append(made if blocks == 1 else materialise(made, "leaks"))
    return passes[0] if blocks == 1 else _merged(passes)


def decontaminate(docs: DataFrame, benchmark: DataFrame, params: LeakParams = LeakParams()) -> DataFrame:
    """The documents that hold no window of the benchmark."""
    hit = materialise(find_leaks(docs, benchmark, params).where(F.size("spans") > 0).select(
        F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct(), "contaminated")
    key = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256))
    return docs.join(hit, F.col("doc_id").eqNullSafe(F.col("_id")) & (key == F.col("_key")), "left_anti")


def leak_figures(docs: DataFrame, benchmark: DataFrame, params: LeakParams = LeakParams()) -> DataFrame:
    """n_words, n_hit, n_items, items_sha256, contaminated and the longest match of every row."""
    items = F.array_sort(F.transform("found", lambda f: f.item_id))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["last"] - s["first"])
    return find_leaks(docs, benchmark, params).select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), hit.alias("n_hit"),
        F.size("found").cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))
