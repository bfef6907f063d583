"""Fill-in-the-middle against a plain re-statement over code points."""

import hashlib
import random
import re

import numpy as np
import pytest

from ratify.llm import fill_in_middle as fm

DOCS = "doc_id long, text string, n string, form int, output string"
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    parts = ["a", "été", "日本", "🙂x", " ", "\n\n", "\t", " ", " ", "<P", ">", "<S", "b\u0000", "\u0085"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(200)]
    texts += [" ", "   lead", "trail \n", "has <M> inside", "<S><P", "é" * 5000 + " x" * 5000]
    table = list(enumerate(texts)) + [(1000, None), (1001, ""), (None, "no id at all"), (5, texts[5]), (5, texts[6])]
    return [(i, t, "clash", 1, "clash") for i, t in table]


def plain(doc_id, text, unit="words"):
    text = text or ""
    units = UNIT.findall(text) if unit == "words" else list(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(units[a:b]) for a, b in ((0, low), (low, high), (high, n)))
    if h4 % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit", ["words", "chars"])
def test_output_equals_the_plain_version_and_is_restored(spark, rows, unit):
    params = fm.FimParams(unit=unit)
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    made = fm.fill_in_middle(docs, params)
    got = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made.collect()), key=str)
    assert got == sorted(((r[0], *plain(r[0], r[1], unit)) for r in rows), key=str)
    assert {g[2] for g in got} == {"plain", "spm", "psm"}
    back = made.withColumn("text", fm.restored(made.output, made.form)).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(r[0]), r[1] or "") for r in rows)


def test_digests_and_empty_table(spark, rows):
    docs = spark.createDataFrame(rows, DOCS)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = fm.fim_digests(docs).collect()
    assert sorted((str(r.doc_id), r.output_sha256, r.restored_sha256) for r in got) == sorted(
        (str(r[0]), sha(plain(r[0], r[1])[4]), sha(r[1] or "")) for r in rows)
    assert fm.fim_digests(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        fm.fill_in_middle(docs, fm.FimParams(unit="tokens"))


def test_exception_index_converts_every_cut():
    for text in ("", "abc", "é", "aéb日🙂c", "🙂🙂", "日" * 50 + "x" * 50):
        index = fm.ExceptionIndex(np.frombuffer(text.encode(), np.uint8))
        chars = np.arange(len(text) + 1)
        cuts = np.array([len(text[:k].encode()) for k in chars])
        assert index.to_bytes(chars).tolist() == cuts.tolist() and index.to_chars(cuts).tolist() == chars.tolist()
        assert len(index.at) == sum(ord(c) > 127 for c in text) and index.n_chars == len(text)
