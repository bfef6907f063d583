"""Operators over the whole corpus, against brute force on small tables, and the registered queries."""

import hashlib
import random
import re
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from ratify.llm import chat_format, components, exact_dedup, line_dedup, minhash_dedup, oracle, queries, source_mixing

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, component_id int"
WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choice(vocabulary) for _ in range(60)) for _ in range(25)]
    out, passage = [], " ".join(rng.choice(vocabulary) for _ in range(40))
    for text in base:
        out.append(text)
        for _ in range(rng.randint(0, 6)):
            words = text.split()
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            out.append(" ".join(words))
        out.append(passage + "\n" + text[:rng.randint(40, 300)] + "\nshort\nThe same long line here ")
    out += ["one two", "ONE  two", "", " \n ", out[0], out[0].upper(), out[3] + "\n" + "tail " * 3000]
    table = [(i, t, "en", rng.choice(["a", "b", "c", "é", None]), len(t), "clash", 1) for i, t in enumerate(out)]
    return table + [(9000, None, None, None, None, None, None), (None, out[0], None, "a", None, None, None), table[4], table[4]]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _set(text):
    words = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_near_duplicates_equal_brute_force(docs, rows, empty):
    sets = {r[0]: _set(r[1]) for r in rows if r[0] is not None}
    group = {i: i for i in sets}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                group[y] = x
    got = minhash_dedup.near_duplicates(docs).collect()
    assert len(got) == len(rows) and any(find(i) != i for i in ids)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), find(r.doc_id), find(r.doc_id) == r.doc_id)
    assert minhash_dedup.near_duplicates(empty).count() == 0
    left = minhash_dedup.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {None, *(i for i in ids if find(i) == i)}


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(0, 120)] + [(500, i) for i in range(501, 700)] + [(7, 7), (None, 3), (130, 120)]
    found = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {found[i] for i in [*range(121), 130]} == {0} and {found[i] for i in range(500, 700)} == {500}


def test_large_buckets_are_dealt_in_blocks(spark, monkeypatch, rows, docs):
    whole = {(r.doc_id, r.component_id) for r in minhash_dedup.near_duplicates(docs).collect()}
    monkeypatch.setattr(minhash_dedup, "BLOCK", 2)
    assert {(r.doc_id, r.component_id) for r in minhash_dedup.near_duplicates(docs).collect()} == whole


def test_exact_dedup_equals_brute_force(docs, rows, empty):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")].append(r)
    want = {}
    for bare, own in groups.items():
        keep = min(own, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))[0]
        for r in own:
            want[r[0], bare] = (keep, len(own), r[0] == keep, hashlib.sha256(bare.encode()).hexdigest())
    got = exact_dedup.exact_dedup(docs).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got} == {(k[0], *v) for k, v in want.items()}
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_digest_index_persists_over_batches(spark, tmp_path):
    index = exact_dedup.DigestIndex(spark, f"{tmp_path}/index", buckets=4)
    first = spark.createDataFrame([(1, "a b"), (2, "ab"), (3, "c")], "doc_id long, text string")
    second = spark.createDataFrame([(4, "a  b  "), (5, "d"), (6, "d")], "doc_id long, text string")
    assert {(r.doc_id, r.keep_id) for r in exact_dedup.exact_dedup(first, index).collect()} == {(1, 1), (2, 1), (3, 3)}
    assert {(r.doc_id, r.keep_id) for r in exact_dedup.exact_dedup(second, index).collect()} == {(4, 1), (5, 5), (6, 5)}
    assert index.rows().count() == 3


def test_line_dedup_equals_brute_force(docs, rows, empty):
    big = 2**63 - 1
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    owner = {}
    for r in rows:
        for line in (r[1] or "").split("\n"):
            if len(key(line)) >= 10:
                doc = big if r[0] is None else r[0]
                owner[key(line)] = min(owner.get(key(line), doc), doc)
    want = set()
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if owner.get(key(x), big) >= (big if r[0] is None else r[0]) or len(key(x)) < 10]
        want.add((r[0], len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    for batches, fanout in ((1, 4), (7, 2)):
        lost = line_dedup.duplicate_lines(docs, batches, fanout)
        assert lost.count() > 0
        got = line_dedup.line_figures(docs, batches).collect()
        assert len(got) == len(rows) and {tuple(r) for r in got} == want
    assert line_dedup.line_figures(empty).count() == 0
    clean = line_dedup.dedup_lines(docs)
    assert clean.columns == docs.columns and clean.count() == len(rows)


def _targets(sizes, weights=(1, 2, 3), most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    target, full, total = {}, set(), sum(sizes.values())
    while True:
        free = [s for s in order if s not in full]
        left = total - sum(most * sizes[s] for s in full)
        target = {s: most * sizes[s] if s in full else left * weight[s] / sum(weight[x] for x in free) for s in order}
        over = {s for s in free if target[s] > most * sizes[s]}
        if not over:
            return target
        full |= over


def test_mixing_meets_targets(docs, rows, empty):
    sizes, totals = [len(re.findall(WORD, r[1] or "")) for r in rows], defaultdict(int)
    for r, n in zip(rows, sizes):
        totals[r[3]] += n
    target = _targets(totals)
    mixed = source_mixing.mixing(docs).collect()
    assert len(mixed) == len(rows) and sorted(r.size for r in mixed) == sorted(sizes)
    assert {round(r.target, 6) for r in mixed} == {round(target[s], 6) for s in totals}
    taken = defaultdict(int)
    for r in mixed:
        assert 0 <= r.taken <= 3 * r.size
        taken[round(r.target, 6), r.source_size] += r.taken
    assert len(set(totals.values())) == len(totals)  # so a source is known by its size
    for s in totals:
        assert abs(taken[round(target[s], 6), totals[s]] - target[s]) <= 60
    assert sorted(map(str, mixed)) == sorted(map(str, source_mixing.mixing(docs).collect()))
    assert source_mixing.mixing(empty).count() == 0
    drawn = source_mixing.mixed_documents(docs)
    assert drawn.columns == docs.columns
    assert drawn.count() == sum(r.copies for r in mixed)


def test_mixing_real_sources(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    by = source_mixing.mixing(docs).join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(
        F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()
    assert by and all(abs(r.taken - r.target) <= 0.02 * r.target for r in by)


@pytest.mark.parametrize("share, parts", [(0.1, (0.05, 0.3, 0.95)), (0.3, (0.2, 0.45, 0.8))])
def test_mixing_fills_past_a_giant(spark, share, parts):
    rng = random.Random(3)
    rows = [(f"{part}-{k}", i, rng.randint(20, 400)) for part in parts for k in range(3) for i in range(3000)]
    totals = defaultdict(int)
    for source, _, size in rows:
        totals[source] += size
    giants = [(source, 5000 + i, int(n * share / (1 - share))) for i, (source, n) in enumerate(totals.items())]
    totals = {source: totals[source] + size for source, _, size in giants}
    rated = spark.createDataFrame([(s, n, n * float(s.split("-")[0]), float(s.split("-")[0])) for s, n in totals.items()],
                                  "source string, source_size long, target double, rate double")
    units = spark.createDataFrame(rows + giants, "source string, doc long, size long")
    got = source_mixing.copies(units, rated).groupBy("source").agg(
        F.sum(F.col("copies") * F.col("size")).alias("taken"), F.max("target").alias("target"), F.count("*").alias("n")).collect()
    assert len(got) == len(totals) and {r.n for r in got} == {3001}
    assert all(abs(r.taken - r.target) <= 20 for r in got)


def test_reply_trees(spark):
    messages = spark.createDataFrame(
        [("t", 1, None, 0.0, "user", "hi"), ("t", 2, 1, 5.0, "assistant", "a ### b"), ("t", 3, 1, 1.0, "assistant", "c"),
         ("t", 4, 2, 1.0, "user", "</turn>"), ("t", 5, 3, 9.0, "user", None), ("t", 6, 99, 0.0, "us:er", "orphan\\h"),
         ("c", 1, 2, 0.0, "user", "x"), ("c", 2, 1, 0.0, "user", "y"), ("c", None, 1, 0.0, "user", "z")],
        "tree string, id long, parent long, score double, role string, text string")
    got = chat_format.read_back(chat_format.format_branches(messages)).orderBy("branch_rank").collect()
    paths = [(r.tree, r.leaf, [(t.role, t.text) for t in r.turns], r.loss_text) for r in got]
    assert paths == [("t", 5, [("user", "hi"), ("assistant", "c"), ("user", "")], "c"),
                     ("t", 4, [("user", "hi"), ("assistant", "a ### b"), ("user", "</turn>")], "a ### b"),
                     ("t", 6, [("us:er", "orphan\\h")], "")]
    assert chat_format.format_branches(messages, best=1).count() == 1
    assert chat_format.format_branches(messages.limit(0)).count() == 0


def test_chat_cases(spark):
    rows = [(None, 0, "user", "a"), (None, None, "assistant", "b"), (1, 2, None, None), (1, 2, None, None), (1, 1, "user", "\\e \\b ### </turn>")]
    rows += [(2, i, "assistant" if i % 2 else "user", f"turn {i}\n") for i in range(70)]
    got = {r.conv_id: r for r in chat_format.chat_digests(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert {k: r.n_turns for k, r in got.items()} == {None: 2, 1: 3, 2: 70, -7: 2}
    said = "".join(f"{r[2]}\n{r[3]}\n" for r in rows[5:])
    assert got[2].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    learned = "".join(r[3] for r in rows[5:] if r[2] == "assistant")
    assert (got[2].loss_chars, got[2].loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())


@pytest.mark.parametrize("name", sorted(oracle.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "conversations"):
        con.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    want = con.sql(oracle.ORACLE_SQL[name])
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(repr, map(tuple, got.select(*want.columns).collect()))) == sorted(map(repr, want.fetchall()))


def test_pipeline_equals_its_stages_by_brute_force(spark):
    import corpus_pipeline as pipe

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in pipe.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns, name
        docs = spark.createDataFrame(after.collect(), after.schema)
    digests = {(r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in docs.collect()}
    result = pipe.run(spark, SF).collect()
    assert len(result) == docs.count() and {(r.doc_id, r.decoded_sha256) for r in result} == digests
