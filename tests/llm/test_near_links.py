"""Links that near-duplicate detection must not lose."""

import numpy as np

from ratify.llm import components, minhash_dedup


def test_texts_of_one_id_are_one_document(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    docs = spark.createDataFrame([(1, a), (1, b), (2, a + " tail"), (3, b + " tail"), (5, "other words here"), (5, "other words here"),
                                  (None, a), (6, None), (6, None)], "doc_id long, text string").repartition(4)
    got = minhash_dedup.near_duplicates(docs).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {
        (1, 1, True), (2, 1, False), (3, 1, False), (5, 5, True), (None, None, True), (6, 6, True)}
    left = sorted(((r.doc_id, r.text) for r in minhash_dedup.drop_near_duplicates(docs).collect()), key=str)
    assert left == sorted([(1, a), (5, "other words here"), (None, a), (6, None)], key=str)


def test_pairs_of_small_sets_go_to_the_full_check(spark):
    """Pairs of similarity 3/4 with four and three shingles: signatures of such sets scatter."""
    rows = []
    for i in range(300):
        words = [f"v{i}x{k}" for k in range(8)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:7]))]
    got = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.component_id == r.doc_id // 2 * 2 for r in got)


def test_nibbles_of_different_minima_agree_once_in_sixteen():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 1 << 63, 100, dtype=np.uint64)) for _ in range(40)]
    long = [np.frombuffer(minhash_dedup.nibbles(minhash_dedup.minima(s, 1024, 1)), np.uint8) for s in sets]
    found = [minhash_dedup.similarity(np.stack(long[i + 1:]), long[i]) for i in range(39)]
    assert abs(np.concatenate(found).mean()) < 0.01 and np.concatenate(found).max() < 0.06


def test_more_links_contract_to_components(spark):
    edge = lambda rows: spark.createDataFrame(rows, "u long, v long")
    found = components.contracted(None, edge([(1, 2), (2, 3), (10, 11)]))
    found = components.contracted(found, edge([(3, 11), (20, 21), (1, 3), (21, 2)]))
    found = components.contracted(found, edge([(40, 30), (30, 35)]))
    got = {r.node: r.component for r in found.collect()}
    assert {n for n in got if got[n] == 1} == {1, 2, 3, 10, 11, 20, 21} and {n for n in got if got[n] == 30} == {30, 35, 40}
