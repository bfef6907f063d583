"""MinHash near-dedup: banded minima, signature check, exact check, components.

1. One pass turns each text into its set of word shingles (64-bit hashes), the
   minima of ``bands * rows`` universal hash functions over the set, and one
   key for each band of minima.  Equal sets share a digest and go on as one
   representative, so groups of copies cost one row.
2. Representatives that share a band key are candidates.  First, every bucket
   tries its members against one of them, its hub: linear in the bucket, and
   enough for nearly all links.  Candidates whose signatures agree too little
   are dropped (``slack`` is far below what links show), the others are
   confirmed on the full sets, and links become components by alternating
   large-star and small-star.
3. A bucket whose members are still in several components goes on, with a
   longer signature (``fine`` functions, four bits of each minimum): each
   member outside the bucket's largest component proposes its best remaining
   partner of other components, then all that are left.  A pair is proposed in
   the first band that it shares.  No candidate between components is left
   then, so nothing is capped: a pair is skipped only if its ends are already
   connected or it was refused.  Members of a large bucket are dealt in
   blocks, one block a task; only those outside the largest component, of
   which each pair has one, go to all blocks.  New links are contracted to
   components before they are labelled.

With 64 bands of 5 rows a pair of similarity 0.75 shares no band with
probability 3e-8.  Two signatures of it agree in fewer than 64 % of 320 places
with probability 5e-6 (0.78: 3e-9), two long ones in under 0.687 with 3e-6;
pairs of sets under ``small`` shingles, whose signatures scatter more, skip
both and go to the full check.  A pair of similarity 0.55, of which a large
group of near copies has very many, gets past the short signature with 1e-3.

Defined results: the documents of an empty set (no words) link with nothing;
a null id links with nothing and is kept with a null component; rows that
repeat an id are one document whose links add up, also with different texts;
ties go to the smallest id; an empty table gives an empty table; other columns
are ignored by ``near_duplicates`` and pass through ``drop_near_duplicates``,
which keeps one row of an id (of several texts the first in order).
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratify.llm.common import byte_chunks, drop_scratch, map_arrow, map_texts, materialise
from ratify.llm.components import contracted, join_totals
from ratify.llm.hashing import mix, window_hashes, word_hashes

#: Members of a bucket that one task compares with those outside the largest component.
BLOCK = 1024


@dataclass(frozen=True)
class NearParams:
    """Parameters; a link has 100 * intersection >= ``percent`` * union."""
    words: int = 5
    percent: int = 75
    bands: int = 64
    rows: int = 5
    slack: float = 0.64  # share of equal minima under which a candidate is dropped
    fine: int = 1024
    fine_slack: float = 0.687  # similarity by the long signature, 4.5 deviations under 0.75
    small: int = 64  # sets of fewer shingles are told apart by the full check only
    seed: int = 20240229


@functools.lru_cache(maxsize=4)
def _functions(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of universal functions h(x) = a * x + b mod 2**32."""
    random = np.random.Generator(np.random.PCG64(seed))
    a = random.integers(0, 1 << 31, (count, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return a, random.integers(0, 1 << 32, (count, 1), dtype=np.uint32)


def shingle_set(text: str, words: int) -> np.ndarray:
    """Distinct hashes of the text's shingles, sorted; A-Z count as lower case."""
    parts = [word_hashes(chunk.split()) for chunk in byte_chunks(text.encode().lower())]
    return np.unique(window_hashes(np.concatenate(parts), words)) if parts else np.zeros(0, np.uint64)


def minima(shingles: np.ndarray, count: int, seed: int) -> np.ndarray:
    """The least value of each universal function over the set (not empty)."""
    a, b = _functions(count, seed)
    points = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(count, np.iinfo(np.uint32).max, dtype=np.uint32)
    for at in range(0, len(points), 256):  # functions by shingles, a block at a time that fits the cache
        block = a * points[at:at + 256]
        block += b
        np.minimum(least, block.min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key for each band; the band's number is part of it."""
    rows = least.reshape(bands, -1).astype(np.uint64)
    keys = mix(np.arange(bands, dtype=np.uint64) + np.uint64(1))
    for i in range(rows.shape[1]):
        keys = mix(keys + rows[:, i])
    return keys.view(np.int64)


def _sketches(params: NearParams):
    count = params.bands * params.rows

    def work(texts) -> list:
        out: list = [[], [], [], [], []]
        for text in texts:
            shingles = shingle_set(text, params.words)
            out[0].append(len(shingles))
            if len(shingles):
                least = minima(shingles, count, params.seed)
                out[1].append(_digest(shingles))
                # 16 bits of a minimum tell different minima apart well enough for an estimate
                out[2].append((least & np.uint32(0xFFFF)).astype("<u2").tobytes())
                keys = band_keys(least, params.bands)
                out[3].append(keys.astype("<u4").tobytes())
                out[4].append(keys)
            else:
                for column in out[1:]:
                    column.append(None)
        return out

    return work


def _digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _sets(params: NearParams):
    def work(texts) -> list:
        sets = [shingle_set(t, params.words) for t in texts]
        return [list(map(_digest, sets)), [x.view(np.int64) for x in sets],
                [nibbles(minima(x, params.fine, params.seed + 1)) for x in sets]]

    return work


def nibbles(least: np.ndarray) -> bytes:
    """Four bits of the minima, two in a byte; of the spread minima, since the functions keep low bits together."""
    low = (least * np.uint32(0x9E3779B1) >> np.uint32(28)).astype(np.uint8)
    return (low[::2] | low[1::2] << np.uint8(4)).tobytes()


def similarity(sigs: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Estimated similarity of each row of ``sigs`` (bytes of ``nibbles``) to ``one``;
    different minima agree in four bits once in 16."""
    odd = sigs ^ one
    agree = ((odd & np.uint8(15)) == 0).sum(axis=1) + ((odd >> np.uint8(4)) == 0).sum(axis=1)
    return (16 * agree / (2 * sigs.shape[1]) - 1) / 15


def _best_partners(params: NearParams, proposals: int | None, batches):
    """For rows (bucket, block, guest, id, n, comp, few, band, fine, marks, refused) sorted by bucket, block
    and guest: for each guest its ``proposals`` best partners in the block, of other components, that the
    signature and the set sizes allow."""
    held: list[dict] = []
    current = None
    for batch in batches:
        pairs: list[tuple] = []
        for row in batch.to_pylist():
            key = (row["bucket"], row["block"])
            if key != current:
                pairs += _block_pairs(held, params, proposals)
                held, current = [], key
            held.append(row)
        yield _pair_batch(pairs)
    yield _pair_batch(_block_pairs(held, params, proposals))


def _pair_batch(pairs: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())],
                                      names=["u", "v"])


def _block_pairs(held: list[dict], params: NearParams, proposals: int | None) -> list[tuple]:
    """(guest, partner) of one block: guests are the bucket's members outside its largest component."""
    hosts = [r for r in held if not r["guest"]]
    if not hosts:
        return []
    ids, comps, sizes = (np.array([r[c] for r in hosts]) for c in ("id", "comp", "n"))
    few = np.array([r["few"] for r in hosts])
    fine = np.stack([np.frombuffer(r["fine"], np.uint8) for r in hosts])
    marks = np.stack([np.frombuffer(r["marks"], "<u4") for r in hosts])
    no = [(partner, i) for i, r in enumerate(hosts) for partner in r["refused"] or ()]
    refusing = {}
    for partner, i in no:
        refusing.setdefault(partner, []).append(i)
    pairs = []
    for g in held:
        if not g["guest"]:
            continue
        other = (comps != g["comp"]) & (~few | (ids > g["id"]))  # of two guests, one asks
        other &= 100 * np.minimum(sizes, g["n"]) >= params.percent * np.maximum(sizes, g["n"])
        if g["band"]:
            own = np.frombuffer(g["marks"], "<u4")
            other &= ~(marks[:, :g["band"]] == own[:g["band"]]).any(axis=1)
        if g["refused"]:
            other &= ~np.isin(ids, g["refused"])
        other[refusing.get(g["id"], [])] = False
        at = np.flatnonzero(other)
        if not at.size:
            continue
        alike = similarity(fine[at], np.frombuffer(g["fine"], np.uint8))
        ok = (alike >= params.fine_slack) | (max(g["n"], 1) < params.small) & (sizes[at] < params.small)
        at, alike = at[ok], alike[ok]
        for j in at[np.lexsort((ids[at], -alike))[:proposals]]:
            pairs.append((int(g["id"]), int(ids[j])))
    return pairs


def _agree(params: NearParams, batches):
    """Rows (u, v, nu, nv, su, sv) whose signatures agree in a share of ``slack`` places or more, or whose sets are small."""
    for batch in batches:
        keep = [max(n, m) < params.small
                or bool((np.frombuffer(a.as_buffer(), "<u2") == np.frombuffer(b.as_buffer(), "<u2")).mean() >= params.slack)
                for n, m, a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4), batch.column(5),
                                      strict=True)]
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (u, v) with ``link``: whether the full sets meet the threshold."""
    sized = pairs.join(sets.select(F.col("id").alias("u"), F.col("shingles").alias("a")), "u").join(
        sets.select(F.col("id").alias("v"), F.col("shingles").alias("b")), "v")
    shared = F.size(F.array_intersect("a", "b"))
    return sized.withColumn("shared", shared).select(
        "u", "v", (100 * F.col("shared") >= percent * (F.size("a") + F.size("b") - F.col("shared"))).alias("link"))


def _refused(verdicts: DataFrame) -> DataFrame:
    """id, refused: the partners that a representative has asked and with which it has no link.

    Kept with the one that asked: that are the hubs of its buckets and what it
    proposed itself, while one that is asked may be so by very many.
    """
    return verdicts.where("not link").groupBy(F.col("u").alias("id")).agg(F.collect_list("v").alias("refused"))


def _proposals(crowded: DataFrame, sketch: DataFrame, found: DataFrame, verdicts: DataFrame, params: NearParams,
               proposals: int | None) -> DataFrame:
    """u, v: pairs of different components in one bucket that are worth a full check; u asks."""
    comp = materialise(crowded.join(found.select(F.col("node").alias("id"), "component"), "id", "left").select(
        "id", "bucket", "band", F.coalesce("component", "id").alias("comp")), "members")
    counts = comp.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
    mixed = counts.groupBy("bucket").agg(F.max(F.struct("n", "comp")).alias("largest"), F.sum("n").alias("many"),
                                         F.count(F.lit(1)).alias("comps")).where("comps > 1").drop("comps")
    blocks = F.ceil(F.col("many") / BLOCK).cast("long")
    open_ = join_totals(comp, mixed, "bucket").select(
        "id", "bucket", "band", "comp", (F.col("comp") != F.col("largest.comp")).alias("few"), blocks.alias("blocks"),
        F.pmod(F.xxhash64("id"), blocks).alias("own"))
    # a member sits in its own block; one outside the largest component is a guest of all
    seats = F.when(F.col("few"), F.concat(F.array(F.struct(F.col("own").alias("block"), F.lit(False).alias("guest"))), F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda b: F.struct(b.alias("block"), F.lit(True).alias("guest")))))
    seats = F.coalesce(seats, F.array(F.struct(F.col("own").alias("block"), F.lit(False).alias("guest"))))
    told = open_.join(sketch, "id").join(_refused(verdicts), "id", "left")
    dealt = told.withColumn("seat", F.explode(seats)).select(
        "bucket", "seat.block", "seat.guest", "id", "n", "comp", "few", "band", "fine", "marks", "refused")
    parts = int(crowded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = map_arrow(dealt.repartition(parts, "bucket", "block").sortWithinPartitions("bucket", "block", "guest"),
                      functools.partial(_best_partners, params, proposals), "u long, v long")
    out = materialise(pairs.distinct(), "proposals")
    drop_scratch(comp)
    return out


def representative_links(reps: DataFrame, sets_of, params: NearParams, linked: DataFrame | None = None) -> DataFrame:
    """node, component for representatives (id, digest, n, sig, marks, keys) that link with another.

    ``marks`` are the low halves of the keys; ``sets_of`` gives (id, shingles, fine) for a table of ids;
    ``linked`` are links (u, v) known beforehand.
    """
    members = reps.select("id", "n", F.posexplode("keys").alias("band", "bucket"))
    hubs = materialise(members.groupBy("bucket").agg(F.min(F.struct("id", "n")).alias("hub"), F.count(F.lit(1)).alias("many")).where(
        "many > 1").drop("many"), "hubs")
    crowded = materialise(members.join(hubs, "bucket").select(
        "id", "n", "band", "bucket", F.col("hub.id").alias("hub"), F.col("hub.n").alias("hub_n")), "buckets")
    stars = crowded.where("id <> hub").where(
        100 * F.least("n", "hub_n") >= params.percent * F.greatest("n", "hub_n")).select(
        F.col("id").alias("u"), F.col("hub").alias("v"), F.col("n").alias("nu"), F.col("hub_n").alias("nv")).distinct()
    signed = stars.join(reps.select(F.col("id").alias("u"), F.col("sig").alias("su")), "u").join(
        reps.select(F.col("id").alias("v"), F.col("sig").alias("sv")), "v").select("u", "v", "nu", "nv", "su", "sv")
    fresh = materialise(map_arrow(signed, functools.partial(_agree, params), "u long, v long"), "star-pairs")
    sets = materialise(sets_of(crowded.select("id").distinct()), "sets")
    sketch = sets.join(reps.select("id", "n", "marks"), "id").select("id", "n", "fine", "marks")
    verdicts = found = None
    for proposals in (1, None, 0):  # the best partners, then whatever is left, then no more
        tested = materialise(_confirm(fresh, sets, params.percent), "tested")
        drop_scratch(fresh)
        links = tested.where("link").select("u", "v")
        if found is None:
            found = contracted(None, links if linked is None else links.unionByName(linked))
        elif not links.isEmpty():
            found = contracted(found, links)
        if proposals == 0:
            return found
        verdicts = tested if verdicts is None else verdicts.unionByName(tested)
        fresh = _proposals(crowded, sketch, found, verdicts, params, proposals)
        if fresh.isEmpty():
            return found


def near_duplicates(docs: DataFrame, params: NearParams = NearParams(), id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    lean = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sketches = materialise(map_texts(
        lean, functools.partial(_sketches, params), "n long, digest binary, sig binary, marks binary, keys array<long>"), "sketches")
    sizes = materialise(sketches.select("doc_id", "n", "digest"), "sizes")
    key = F.xxhash64("digest")
    named = sketches.where("digest is not null and doc_id is not null")
    reps = materialise(named.groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), *(F.first(c).alias(c) for c in ("n", "sig", "marks", "keys"))).withColumn("id", key),
        "representatives")
    drop_scratch(sketches)

    def sets_of(ids: DataFrame) -> DataFrame:
        asked = reps.select("id", "doc_id", "digest").join(ids, "id", "left_semi")
        texts = lean.join(asked.select("doc_id"), "doc_id", "left_semi")
        built = map_texts(texts, functools.partial(_sets, params), "digest binary, shingles array<long>, fine binary")
        # the join deals the sets by both keys, so the repeated rows of an id meet without another shuffle
        return built.join(asked, ["doc_id", "digest"]).dropDuplicates(["doc_id", "digest"]).select("id", "shingles", "fine")

    found = representative_links(reps, sets_of, params, _of_one_id(sizes, key))
    placed = reps.select("digest", "doc_id", F.col("id").alias("node")).join(found, "node", "left").select(
        "digest", "doc_id", F.coalesce("component", "node").alias("component"))
    least = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    labels = materialise(join_totals(placed, least, "component").select("digest", "component_id"), "labels")
    rows = sizes.select("doc_id", F.col("n").alias("n_shingles"), "digest").join(labels, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"),
                       F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _of_one_id(sizes: DataFrame, key) -> DataFrame | None:
    """u, v: links between the different texts of one id; None where no id has two."""
    texts = sizes.where("digest is not null and doc_id is not null").select("doc_id", key.alias("u"))
    several = materialise(texts.groupBy("doc_id").agg(F.min("u").alias("v"), F.max("u").alias("last")).where(
        "v <> last").drop("last"), "ids-of-several-texts")
    return None if several.isEmpty() else texts.join(several, "doc_id").where("u <> v").select("u", "v").distinct()


def drop_near_duplicates(docs: DataFrame, params: NearParams = NearParams()) -> DataFrame:
    """The documents of which one stays for each component: the one of the smallest id, in one row."""
    marked = materialise(near_duplicates(docs, params).where("doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("kept").alias("_kept")).where("_rows > 1 or not _kept"), "near-copies")
    rows = docs.join(marked, F.col("doc_id") == F.col("_id"), "left")
    once = rows.where("_id is null").select(docs.columns)
    if marked.where("_rows > 1 and _kept").isEmpty():
        return once
    again = rows.where("_rows > 1 and _kept").groupBy("_id").agg(
        F.min_by(F.struct(*(docs[c] for c in docs.columns)), F.coalesce(docs["text"], F.lit(""))).alias("row"))
    return once.unionByName(again.select("row.*"))
