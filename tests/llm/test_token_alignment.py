"""Token alignment against the libraries and a plain re-statement over byte ranges."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ratify.llm import token_alignment as ta

DOCS = "doc_id long, text string, block string, slots int, pair long, a int"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    vocabulary = ["the", "naïve", "approach", "été", "日本語", "人工知能", "🙂", "antidisestablishment", "x9y8", "don't", "<s>",
                  "<|endoftext|>", "12345", "Ünïcode", "…", " ", "é", "ﬁ"]
    texts = [rng.choice([" ", " ", "  ", "\n"]).join(rng.choice(vocabulary) for _ in range(rng.randint(1, 60))) for _ in range(70)]
    texts += ["a" * 3000, "日本語" * 800, "the " * 2000, " lead", "trail ", "\t", "x\u0000y", "▁", "<0x41>"]
    table = list(enumerate(texts)) + [(900, None), (901, ""), (None, "the approach"), (3, texts[3]), (3, texts[4])]
    return [(i, t, "clash", 1, 2, 3) for i, t in table]


def expected(rows):
    """Figures of every row, in order, from the libraries' tokens."""
    a_side = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    tokens = ta.Tokens(ta.AlignParams())
    docs = []
    for _, text, *_ in rows:
        whole = (" " + (text or "")).encode()
        a = a_side.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_side.encode(text) if text else []
        if b"".join(tokens.a_bytes[i] for i in a) != whole or b"".join(tokens.b_bytes[i] for i in b) != whole:
            a, b = [], []
        ends = []
        for ids, table in ((a, tokens.a_bytes), (b, tokens.b_bytes)):
            at, own = 0, []
            for i in ids:
                at += len(table[i])
                own.append(at)
            ends.append(own)
        groups, low_a, low_b = [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            high_a, high_b = ends[0].index(cut) + 1, ends[1].index(cut) + 1
            groups.append((a[low_a:high_a], b[low_b:high_b]))
            low_a, low_b = high_a, high_b
        docs.append((a, b, groups))
    count = Counter()
    for _, _, groups in docs:
        count.update({(x, y) for ga, gb in groups for x in ga for y in gb})
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for (i, *_), (a, b, groups) in zip(rows, docs, strict=True):
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((i, len(a), len(b), len(groups), len(links), sum(count[p] == best[p[0]] for p in links),
                    sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return out


def figures(df):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()),
                  key=str)


def test_figures_equal_the_plain_version(spark, rows):
    want = expected(rows)
    assert sum(w[1] == 0 for w in want) >= 3 and any(w[4] > w[1] for w in want)
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    assert figures(ta.alignment_figures(docs)) == sorted(want, key=str)
    assert ta.alignment_figures(docs.limit(0)).count() == 0


def test_small_blocks_frames_and_listed_groups_change_nothing(rows, monkeypatch):
    tokens = ta.Tokens(ta.AlignParams())
    texts = [r[1] or "" for r in rows]
    whole = [x.tolist() for x in ta.Aligned(tokens, texts).distinct_pairs()]
    monkeypatch.setattr(ta, "WIDE", 1)
    assert [x.tolist() for x in ta.Aligned(tokens, texts).distinct_pairs()] == whole
    assert [(s.start, s.stop) for s in ta.parts(["ab", "c" * 9, "", "d", "e"], 3)] == [(0, 1), (1, 2), (2, 5)]


def test_counts_are_over_all_blocks(spark, rows, monkeypatch):
    docs = spark.createDataFrame(rows, DOCS)
    assert figures(ta.alignment_figures(docs.repartition(7))) == figures(ta.alignment_figures(docs.coalesce(1)))


def test_alignments_make_up_the_text(spark, rows):
    tokens = ta.Tokens(ta.AlignParams())
    got = ta.alignments(spark.createDataFrame(rows[:40], DOCS)).collect()
    assert len(got) == 40
    for r, (_, text, *_) in zip(sorted(got, key=lambda r: r.doc_id), rows, strict=False):
        assert sum(r.a_in_group) == len(r.a_ids) and sum(r.b_in_group) == len(r.b_ids)
        if r.a_ids:
            assert b"".join(tokens.a_bytes[i] for i in r.a_ids).decode() == " " + text
        at_a = at_b = 0
        for n_a, n_b in zip(r.a_in_group, r.b_in_group, strict=True):
            assert b"".join(tokens.a_bytes[i] for i in r.a_ids[at_a:at_a + n_a]) == b"".join(
                tokens.b_bytes[i] for i in r.b_ids[at_b:at_b + n_b])
            at_a, at_b = at_a + n_a, at_b + n_b
