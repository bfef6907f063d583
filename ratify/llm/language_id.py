"""Language identification by compression with per-language dictionaries.

A bounded sample of labelled rows becomes, for each language, a raw-content
zstandard dictionary.  A text, lower-cased, is cut into blocks; every block is compressed
once with each dictionary, and the language whose sizes add up to least wins.
The margin to the second decides whether the answer is accepted.  Blocks keep
the dictionary within reach of every part of a long text.

Parameters that bound the sample: ``rows_per_language`` labelled rows for each
label (those of the lowest id hashes, whole texts of ``shortest_sample`` to
``longest_sample`` bytes), of which the dictionary keeps ``dict_bytes``.  A
label with fewer such texts takes its others, too: the first part of as many
longer texts, and shorter ones, at most one for eight bytes of dictionary.

Defined results: null texts and texts without a letter are ``und`` with score
0; so is everything if no labelled row exists; equal sizes go to the language
with more labelled rows, then to the first by code point; null labels are not
learned; repeated rows give repeated rows; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

import functools

import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratify.llm.common import map_texts

UNKNOWN = "und"


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the id as text, mod 4, is 2 (null ids are learned from)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(labelled: DataFrame, rows_per_language: int = 64, longest_sample: int = 8192, dict_bytes: int = 65536,
          id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", shortest_sample: int = 64) -> list[tuple[str, int, bytes]]:
    """(label, labelled rows, dictionary) for each label, most rows first.

    At most rows_per_language * longest_sample bytes a label come to the driver, and for a label
    with fewer fitting texts as many characters of long ones and dict_bytes / 8 short ones.
    """
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"),
        F.xxhash64(F.col(id_col).cast("string")).alias("place"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    length = F.octet_length("text")

    def lowest(kind: DataFrame, most: int) -> dict[str, list]:
        """The texts of the lowest hashes of each label."""
        # the limit on the rank lets Spark keep the best rows of each task before it shuffles
        best = kind.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("place", "text"))).where(
            F.col("rank") <= most)
        found: dict[str, list] = {lang: [] for lang in sizes}
        for row in best.select("lang", "place", "text").collect():
            found[row["lang"]].append((row["place"], row["text"].encode()[:longest_sample].decode(errors="ignore").lower().encode()))
        return {lang: [text for _, text in sorted(texts)] for lang, texts in found.items()}

    samples = lowest(rows.where(length.between(shortest_sample, longest_sample)), rows_per_language)
    few = [lang for lang, texts in samples.items() if len(texts) < rows_per_language]
    if few:
        others = rows.where(F.col("lang").isin(few))
        long = others.where(length > longest_sample).withColumn("text", F.substring("text", 1, longest_sample))
        short = others.where((length > 0) & (length < shortest_sample))
        longs, shorts = lowest(long, rows_per_language), lowest(short, dict_bytes // 8)
        # the dictionary keeps the end: fitting texts before the parts of long ones before short ones
        samples = {lang: shorts[lang] + longs[lang] + texts if lang in few else texts for lang, texts in samples.items()}
    learned = [(lang, n, b"\n".join(samples[lang])[-dict_bytes:]) for lang, n in sizes.items()]
    return sorted(learned, key=lambda x: (-x[1], x[0]))


class Compressors:
    """Sizes of a text under the dictionary of each language."""

    def __init__(self, learned: list[tuple[str, int, bytes]], block: int = 4096, level: int = 6):
        self.block = block
        self.langs = [lang for lang, _, _ in learned]
        self.codecs = []
        for _, _, content in learned:
            if len(content) >= 8:
                data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                data.precompute_compress(level=level)
                self.codecs.append(self._codec(level, data))
            else:
                self.codecs.append(self._codec(level, None))

    @staticmethod
    def _codec(level: int, data) -> zstandard.ZstdCompressor:
        return zstandard.ZstdCompressor(level=level, dict_data=data, write_content_size=False, write_dict_id=False)

    def sizes(self, text: str) -> list[int]:
        data = text.lower().encode()
        blocks = [data[i:i + self.block] for i in range(0, len(data), self.block)]
        return [sum(len(codec.compress(b)) for b in blocks) for codec in self.codecs]

    def answer(self, text: str, least_margin: float) -> tuple[str, float, bool]:
        if not self.langs or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, False
        sizes = self.sizes(text)
        order = sorted(range(len(sizes)), key=sizes.__getitem__)  # stable: most rows first among equals
        best = sizes[order[0]]
        score = 1.0 - best / sizes[order[1]] if len(order) > 1 else 1.0
        return self.langs[order[0]], score, score >= least_margin


def _classify(learned: list, least_margin: float, block: int, level: int):
    compressors = Compressors(learned, block, level)

    def work(texts) -> list:
        answers = [compressors.answer(t, least_margin) for t in texts]
        return [list(c) for c in zip(*answers, strict=True)] or [[], [], []]

    return work


def classify(docs: DataFrame, learned: list[tuple[str, int, bytes]], least_margin: float = 0.02, block: int = 4096,
             level: int = 6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (share by which the best size is under the second),
    accepted (the margin is not narrow) of every document."""
    return map_texts(docs, functools.partial(_classify, learned, least_margin, block, level),
                     "lang_pred string, score double, accepted boolean", id_col, text_col)


def language_id(docs: DataFrame) -> DataFrame:
    """Learn from the rows that are not held out, then classify every row."""
    answered = classify(docs, learn(docs.where(~held_out())))
    return answered.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "accepted")
