"""Operators that look at one text at a time, against the libraries or brute force."""

import base64
import hashlib
import math
import random
import re

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ratify.llm import byte_bpe, language_id, quality_rules, secret_scan, token_counts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, n_words int"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    odd = ["", " ", "\n", "a" * 9000, "ab" * 5000, "é" * 3000, "x<|endoftext|>y", "tab\tand\x1c\x85\xa0 end  ",
           "中文字 😀😀", "".join(rng.choice("abcdeth") for _ in range(6000)), "can't we'll 12345 !!! \n\n  z"]
    alphabet = list("aaabcdefghij   \n\t'sltre0123!?#<|>") + ["é", "ß", "中", "😀", "the", "aaaa", "\x1f"]
    return odd + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 90))) for _ in range(400)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", "s", len(t), "clash", 3) for i, t in enumerate(texts)]
    rows += [(9000, None, None, None, None, None, None), (None, "no id here", None, None, None, None, None), rows[5], rows[5]]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_token_counts_equal_library(docs, texts):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = _by_id(token_counts.token_counts(docs))
    for i, encoded in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        row = got[i]
        assert (row.n_tokens, row.n_bytes, row.over_limit) == (len(encoded.ids), len(texts[i].encode()), len(encoded.ids) > 512)
    assert got[9000].n_tokens == 0 and got[None].n_tokens > 0
    assert token_counts.token_counts(docs).count() == docs.count()


def test_byte_bpe_equals_library_and_round_trips(docs, texts, spark):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoded = byte_bpe.encode(docs)
    got = _by_id(encoded)
    digests = _by_id(byte_bpe.encode_digests(docs))
    back = _by_id(byte_bpe.decode(encoded))
    for i, text in enumerate(texts):
        want = library.encode_ordinary(text)
        assert np.frombuffer(bytes(got[i].ids), "<u4").tolist() == want
        assert bytes(back[i].data) == text.encode()
        assert digests[i].ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert digests[9000].n_tokens == 0


def test_bpe_tree_cuts_long_texts(texts):
    bpe = byte_bpe.coder(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    text = " ".join(texts) * 12 + "q" * 200_000
    assert len(text) > byte_bpe.LEAF_CHARS
    assert bpe.decode(bpe.encode(text)) == text.encode()


def test_secrets_equal_brute_force(spark, empty):
    hexes = "0123456789abcdef" * 3
    rows = ["token = \"" + hexes + "\" x", "PASSWORD:abc token=token: abcdefgh", "AKIA" + "A" * 16 + " AKIA123 x" + "f" * 24,
            "api-key=short apikey: longenough", "ſecret=abcdefgh", None, "", "q7Zx1KpL9vB3nM5tR8wY2cD4 zz",
            "550e8400-e29b-41d4-a716-446655440000", "thisisaverylongwordwithoutanydigits"]
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = _by_id(secret_scan.secret_digests(docs))
    kinds = [("assign", secret_scan.ASSIGN, lambda m: len(m[2]) >= 6), ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
             ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24)]
    for i, text in enumerate(rows):
        spans = sorted((m.start(), k, m.end()) for k, (_, p, ok) in enumerate(kinds) for m in p.finditer(text or "") if ok(m))
        told = ",".join(f"{kinds[k][0]}:{a}:{b}" for a, k, b in spans)
        assert got[i].base_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [sum(s[1] == k for s in spans) for k in range(3)]
        assert set(told.split(",")) - {""} <= set(got[i].spans.split(","))
    assert "entropy" in got[7].spans and got[8].spans == "" and got[9].spans == ""
    assert secret_scan.secret_digests(empty).count() == 0
    hidden = _by_id(secret_scan.redact(docs))
    assert hexes not in hidden[0].text and hidden[9].text == rows[9]


def test_incremental_entropy_equals_direct():
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefgh01234567XYZ") for _ in range(300))
    window, bits = 24, 3.4

    def direct(part):
        return -sum(c / window * math.log2(c / window) for c in map(part.count, set(part)))

    hit = [i for i in range(len(text) - window + 1) if direct(text[i:i + window]) >= bits - 1e-12]
    covered = {p for i in hit for p in range(i, i + window)}
    spans = secret_scan.entropy_windows(text, window, bits)
    assert {p for a, b in spans for p in range(a, b)} == covered


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.language_id(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 150 and right > 0.95


def test_language_cases(spark, empty):
    rows = [(0, "der die und das ist ein " * 9, "de"), (1, "the of and to in is it " * 9, "en"), (3, None, "en"), (4, "12 %", None),
            (5, "", "en"), (None, "the of and", None), (6, "und das ist", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = _by_id(language_id.language_id(docs))
    assert got[3].lang_pred == got[4].lang_pred == got[5].lang_pred == "und" and got[3].score == 0
    assert got[6].lang_pred == "de" and got[None].lang_pred == "en" and 0 <= got[6].score <= 1
    assert language_id.language_id(empty).count() == 0
    unlabelled = language_id.language_id(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}


def _brute_repeats(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    return len({p for i, w in enumerate(windows) if windows.count(w) > 1 for p in range(i, i + 8)})


def test_quality_figures(docs, texts):
    got = _by_id(quality_rules.quality(docs))
    for i, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert got[i].n_words == len(words) and got[i].word_chars == sum(map(len, words))
        assert got[i].n_symbols == sum(c in "#*$%&|<>" for c in text)
        assert got[i].n_dup_lines == len(lines) - len(set(lines))
    assert got[9000].base_failed and not got[9000].kept


@pytest.mark.parametrize("text", ["a b c d e f g h " * 3, "a " * 40, "x y " * 3, " ".join(map(str, range(50))) + " 1 2 3 4 5 6 7 8 9"])
def test_repeated_words(text):
    assert quality_rules.repeated_words(text) == _brute_repeats(text)


def test_cleaning(spark, empty):
    prose = "This is a line of plain prose that goes on for a while and ends well.\n"
    rows = [(0, prose + "\n".join(f"Line a{i} has b{i} and c{i} with d{i} or e{i}." for i in range(6)) + "\nHome | News | About | Shop"),
            (1, "\n".join("Home | News | About | Shop | Item%d" % i for i in range(12))), (2, None)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n_words string")
    kept = quality_rules.clean_documents(docs).collect()
    assert [r.doc_id for r in kept] == [0] and "Home" not in kept[0].text and kept[0].text.startswith(prose)
    assert quality_rules.clean_documents(empty).count() == 0 and quality_rules.quality(empty).count() == 0


def test_empty_tables(empty):
    assert token_counts.token_counts(empty).count() == 0
    assert byte_bpe.encode_digests(empty).count() == 0
