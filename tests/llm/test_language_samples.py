"""Languages whose labelled texts are all longer or all shorter than the sample's texts."""

import random

from ratify.llm import language_id


def test_long_and_short_texts_are_learned(spark):
    rng = random.Random(7)
    words = {lang: ["".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(150)]
             for lang, letters in (("aa", "abcdefgh"), ("bb", "abcdijkl"), ("cc", "abcdmnop"))}

    def text(lang, size):
        out = ""
        while len(out) < size:
            out += rng.choice(words[lang]) + " "
        return out[:size]

    rows = [(f"{lang}{i}", text(lang, size), lang) for lang, size, n in (("aa", 20_000, 12), ("bb", 30, 400), ("cc", 500, 70))
            for i in range(n)]
    learned = language_id.learn(spark.createDataFrame(rows, "doc_id string, text string, lang string"))
    assert {lang: n for lang, n, _ in learned} == {"aa": 12, "bb": 400, "cc": 70}
    assert all(len(content) > 10_000 for _, _, content in learned)
    asked = [(i, text(lang, 300), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 10)]
    docs = spark.createDataFrame(asked, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language_id.classify(docs, learned).collect()}
    assert got == {i: lang for i, _, lang in asked}
