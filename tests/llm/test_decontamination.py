"""Decontamination against brute force over windows."""

import hashlib
import random
import re

import numpy as np
import pytest

from ratify.llm import decontamination as d

DOCS = "doc_id long, text string, item_id string, n_words string, spans int"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    """(doc_id, n_words, n_hit, items) and the longest match of each document and item."""
    asked = [("" if i is None else str(i), words(t)) for i, t in items]
    out, longest = [], {}
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for item, test in asked:
            need = min(window, len(test))
            for q in range(len(test) - need + 1) if test else ():
                for at in range(len(own) - need + 1):
                    if own[at:at + need] == test[q:q + need]:
                        hit.update(range(at, at + need))
                        found.add(item)
                        n = need
                        while at + n < len(own) and q + n < len(test) and own[at + n] == test[q + n]:
                            n += 1
                        longest[doc_id, item] = max(longest.get((doc_id, item), 0), n)
        out.append((doc_id, len(own), len(hit), tuple(sorted(found))))
    return out, longest


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(5)
    vocabulary = [*(f"w{i}" for i in range(30)), "É", "été", "naïve", "x1"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([12, 25, 60]))) for i in range(12)]
    items += [(50, "Only, three words!"), (51, "w1"), (52, ""), (53, None), (None, text(14)), (7, text(15)), (60, items[3][1]),
              (61, "a " * 25)]
    docs = []
    for i in range(60):
        body = text(rng.randint(0, 80)).split()
        for _ in range(rng.randint(0, 3)):
            test = words(rng.choice(items)[1])
            a = rng.randint(0, len(test))
            body[rng.randint(0, len(body)):0] = test[a:a + rng.randint(5, 40)]
        joiner = rng.choice([" ", "\n", ", ", "-"])
        docs.append((i, joiner.join(body).upper() if i % 3 else joiner.join(body)))
    docs += [(100, None), (101, ""), (102, "..."), (103, "only THREE\nwords"), (104, "a " * 300), (105, items[2][1] + " " + text(20000)),
             (None, items[0][1]), (1, docs[1][1]), (1, docs[1][1]), (1, items[4][1])]
    return docs, items


def frames(spark, tables):
    docs, items = tables
    return (spark.createDataFrame([(*r, "clash", "clash", 1) for r in docs], DOCS).repartition(5),
            spark.createDataFrame([(*r, 3) for r in items], "item_id long, text string, doc_id int"))


def figures(rows):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows), key=str)


@pytest.mark.parametrize("params", [d.LeakParams(), d.LeakParams(block_bytes=400, piece_words=16, shard_bytes=500)])
def test_figures_equal_brute_force(spark, tables, params):
    docs, bench = frames(spark, tables)
    want, longest = brute(*tables)
    got = d.leak_figures(docs, bench, params).collect()
    assert figures(got) == sorted(((i, n, hit, len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), hit > 0)
                                   for i, n, hit, found in want), key=str)
    if params == d.LeakParams():
        leaks = d.find_leaks(docs, bench, params).where("doc_id <> 1").collect()
        assert {(r.doc_id, f.item_id): f.n_words for r in leaks for f in r.found} == {k: v for k, v in longest.items()
                                                                                     if k[0] not in (1, None)}
        own, tests = {i: words(t) for i, t in tables[0]}, {str(i): words(t) for i, t in tables[1] if i != 7}
        for r in leaks:
            for f in (f for f in r.found if f.item_id in tests):
                assert own[r.doc_id][f.doc_word:f.doc_word + f.n_words] == tests[f.item_id][f.item_word:f.item_word + f.n_words]


def test_affected_documents_go(spark, tables):
    docs, bench = frames(spark, tables)
    want, _ = brute(*tables)
    clean = d.decontaminate(docs, bench)
    assert clean.columns == docs.columns
    texts = [t for (_, t), w in zip(tables[0], want, strict=True) if not w[2]]
    assert sorted(map(str, texts)) == sorted(str(r.text) for r in clean.collect())


def test_empty_tables(spark, tables):
    docs, bench = frames(spark, tables)
    assert d.leak_figures(docs.limit(0), bench).count() == 0
    assert {(r.n_hit, r.n_items, r.contaminated) for r in d.leak_figures(docs, bench.limit(0)).collect()} == {(0, 0, False)}
    assert d.decontaminate(docs, bench.where("text is null")).count() == docs.count()


def test_suffix_array_orders_suffixes():
    rng = np.random.default_rng(1)
    for n, values in ((1, 2), (300, 3), (2000, 2), (500, 1)):
        x = np.append(rng.integers(0, values + 1, n), 0)
        order = d.suffix_array(x, 64)
        assert sorted(order.tolist()) == list(range(n + 1))
        ends = [next(j for j in range(i, n + 1) if x[j] == 0) for i in range(n + 1)]
        keys = [tuple(x[i:min(ends[i], i + 64)]) for i in order.tolist()]
        assert keys == sorted(keys)
