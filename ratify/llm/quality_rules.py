"""Line-first cleaning: rules on each line, then a verdict on what is left.

A line with words fails if it looks like punctuation junk (symbols for more
than a tenth of its characters, or a fragment without a sentence end), like
navigation (separators between few words), or like boilerplate (a fixed
phrase in a short line).  Failing lines go; a document that loses more than
``lost`` of its words goes as well, and so do documents that fail the base
figures: too few words, or too many words in repeated windows.

Defined results: null or empty text has no words and is rejected; lines
without words are neither judged nor counted as duplicates; repeated rows
give repeated rows; an empty table gives an empty table; other columns are
ignored.  Windows are compared by 64-bit hashes.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratify.llm.common import SPACES, byte_chunks, map_arrow, map_texts
from ratify.llm.hashing import window_hashes, word_hashes

# Fixed values of the base figures.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30

# Fixed phrases of boilerplate, lower case.
BOILERPLATE = ("all rights reserved", "accept cookies", "cookie policy", "privacy policy", "terms of service",
               "terms of use", "enable javascript", "click here", "sign up", "log in", "subscribe to our newsletter",
               "lorem ipsum", "licensed under", "copyright")


@dataclass(frozen=True)
class LineRules:
    """Parameters of the line rules and of the verdict."""
    symbols_percent: int = 10    # of a line's non-blank characters, from which it is junk
    fragment_words: int = 4      # a line of fewer words must end a sentence
    ends: str = ".!?:;,\"')]}…。！？”’»"
    separators: str = "|>»›•·"
    words_per_separator: int = 4  # navigation: at least one separator for so many words
    least_separators: int = 3
    boilerplate: tuple[str, ...] = BOILERPLATE
    boilerplate_words: int = 30  # a longer line is prose that mentions the phrase
    lost_percent: int = 50       # of the words, over which the document goes


class Cleaner:
    """Judges lines and counts the base figures of one text."""

    def __init__(self, rules: LineRules):
        self.rules = rules
        self.junk = re.compile(f"[{re.escape(SYMBOLS)}]")
        self.bars = re.compile(f"[{re.escape(rules.separators)}]")
        self.phrases = re.compile("|".join(map(re.escape, rules.boilerplate))) if rules.boilerplate else None

    def line_fails(self, line: str, words: int) -> bool:
        rules, bare = self.rules, line.strip(SPACES)
        if words < rules.fragment_words and bare[-1] not in rules.ends:
            return True
        if 100 * len(self.junk.findall(line)) > rules.symbols_percent * (len(bare) - words + 1):
            return True
        bars = len(self.bars.findall(line))
        if bars >= rules.least_separators and bars * rules.words_per_separator >= words:
            return True
        return bool(self.phrases and words <= rules.boilerplate_words and self.phrases.search(bare.lower()))

    def clean(self, text: str) -> tuple[str, int, int, int]:
        """The text without failing lines; its words, words lost, and duplicate lines."""
        kept, seen = [], set()
        total = lost = duplicates = 0
        for line in text.split("\n"):
            words = len(line.encode().split())
            if words:
                total += words
                duplicates += line in seen
                seen.add(line)
                if self.line_fails(line, words):
                    lost += words
                    continue
            kept.append(line)
        return "\n".join(kept), total, lost, duplicates

    def kept(self, words: int, lost: int, repeated: int) -> tuple[bool, bool]:
        """Whether the base figures fail, and the verdict."""
        failed = words < LEAST_WORDS or 100 * repeated > MOST_REPEATED * words
        return failed, not failed and 100 * lost <= self.rules.lost_percent * words


def repeated_words(text: str) -> int:
    """Words in windows of ``WINDOW`` words found twice or more, the first included."""
    parts = [word_hashes(chunk.split()) for chunk in byte_chunks(text.encode())]
    words = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    if len(words) <= WINDOW:
        return 0
    windows = window_hashes(words, WINDOW)
    order = np.argsort(windows)
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(windows), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + WINDOW, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def _judge(rules: LineRules, with_text: bool):
    cleaner = Cleaner(rules)

    def work(texts) -> list:
        out: list = [[] for _ in range(9)]
        for text in texts:
            cleaned, words, lost, duplicates = cleaner.clean(text)
            repeated = repeated_words(text)
            failed, kept = cleaner.kept(words, lost, repeated)
            figures = (words, len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), duplicates,
                       repeated, failed, kept, lost, cleaned)
            for column, value in zip(out, figures, strict=True):
                column.append(value)
        return out if with_text else out[:-1]

    return work


_FIGURES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
            "base_failed boolean, kept boolean, n_lost_words long")


def quality(docs: DataFrame, rules: LineRules = LineRules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the figures of every document; ``kept`` is the verdict."""
    return map_texts(docs, functools.partial(_judge, rules, False), _FIGURES, id_col, text_col)


def clean_documents(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The documents that stay, their text without the lines that failed."""
    judged = map_arrow(docs, functools.partial(_clean_batches, rules, docs.columns.index("text")), docs.schema)
    if "n_chars" in docs.columns:
        judged = judged.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return judged


def _clean_batches(rules: LineRules, at: int, batches):
    work = _judge(rules, True)
    for batch in batches:
        *_, kept, _lost, cleaned = work(v.as_py() or "" for v in batch.column(at))
        texts = pa.array(cleaned, type=batch.schema.field(at).type)
        yield batch.set_column(at, batch.schema.field(at), texts).filter(pa.array(kept, type=pa.bool_()))
