"""Fill-in-the-middle transformation over a sparse index of multibyte characters.

A text stays UTF-8 bytes.  Only its multibyte characters are recorded: their
code-point positions and the bytes that they and those before them take beyond
one.  ``searchsorted`` in these finds how many exceptions lie before a cut;
between exceptions one character is one byte and a cut moves by plain
addition.  The two cuts are chosen in units (words with the white space before
them, or code points), made as bytes and reported as code points.

Which units the cuts follow, and which form a text takes, depends on the id
and the seed only, so reruns and other partitionings agree.

Defined results: null counts as empty; an empty text, one that holds a mark
and one that the draw leaves out are ``plain`` (output is the text, no cuts);
a null id draws as the empty id; repeated rows give repeated rows; an empty
table gives an empty table; other columns are ignored by ``fill_in_middle``.
"""

from __future__ import annotations

import functools
import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratify.llm.common import map_arrow

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
#: True for the bytes blank and tab to carriage return.
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


@dataclass(frozen=True)
class FimParams:
    seed: int = 42
    fim_percent: int = 50
    spm_percent: int = 80
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"
    unit: str = "words"  # or "chars"


class ExceptionIndex:
    """Code-point positions of a text's multibyte characters, and their running excess bytes."""

    def __init__(self, data: np.ndarray):
        starts = np.flatnonzero(data >= 0xC0)
        extra = 1 + (data[starts] >= 0xE0).astype(np.int64) + (data[starts] >= 0xF0)
        self.excess = np.concatenate(([0], np.cumsum(extra)))  # before each exception, and of all
        self.at = starts - self.excess[:-1]
        self.n_chars = len(data) - int(self.excess[-1])

    def to_bytes(self, chars):
        """Byte offsets of code-point offsets."""
        return chars + self.excess[np.searchsorted(self.at, chars)]

    def to_chars(self, cuts):
        """Code-point offsets of byte offsets (of whole characters)."""
        return cuts - self.excess[np.searchsorted(self.at + self.excess[:-1], cuts)]


def word_ends(data: np.ndarray) -> np.ndarray:
    """Byte offsets at which the units end: each word with the white space before it, then what is left."""
    if not len(data):
        return np.zeros(0, np.int64)
    space = _SPACE[data]
    return np.append(np.flatnonzero(~space[:-1] & space[1:]) + 1, len(data))


def draws(doc_id, seed: int) -> list[int]:
    """Four numbers of 32 bits that belong to an id."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    return np.frombuffer(hashlib.sha256(name.encode()).digest()[:16], ">u4").tolist()


def transform(doc_id, text: bytes, params: FimParams) -> tuple:
    """n, form, prefix_chars, middle_chars, output of one text."""
    data = np.frombuffer(text, np.uint8)
    index = ends = None
    if params.unit == "words":
        ends = word_ends(data)
        n = len(ends)
    else:
        index = ExceptionIndex(data)
        n = index.n_chars
    one, two, fim, kind = draws(doc_id, params.seed)
    marks = [m.encode() for m in (params.prefix, params.suffix, params.middle)]
    if not text or fim % 100 >= params.fim_percent or any(m in text for m in marks):
        return n, "plain", None, None, text
    index = index or ExceptionIndex(data)
    units = np.sort([one % (n + 1), two % (n + 1)])
    if ends is None:
        chars, cuts = units, index.to_bytes(units)
    else:
        cuts = np.append(0, ends)[units]
        chars = index.to_chars(cuts)
    low, high = cuts.tolist()
    parts = [marks[0] + text[:low], marks[1] + text[high:], marks[2] + text[low:high]]
    form = "spm" if kind % 100 < params.spm_percent else "psm"
    if form == "spm":
        parts[:2] = parts[1::-1]
    return n, form, int(chars[0]), int(chars[1] - chars[0]), b"".join(parts)


def _run(params: FimParams, batches):
    for batch in batches:
        rows = [transform(i.as_py(), t.as_buffer().to_pybytes() if t.is_valid else b"", params)
                for i, t in zip(batch.column(0), batch.column(1), strict=True)]
        n, form, prefix, middle, output = zip(*rows, strict=True) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
             pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())],
            names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def fill_in_middle(docs: DataFrame, params: FimParams = FimParams(), id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """doc_id, n (units), form (plain, psm, spm), prefix_chars, middle_chars, output of every row."""
    if params.unit not in ("words", "chars"):
        raise ValueError(f"unknown unit {params.unit!r}")
    lean = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_arrow(lean, functools.partial(_run, params), SCHEMA)


def restored(output: Column, form: Column, params: FimParams = FimParams()) -> Column:
    """The text again, from output and form.  The marks occur once each, so the first place of each tells the parts."""
    def after(mark: str) -> Column:
        return F.substr(output, F.instr(output, mark) + F.lit(len(mark)))

    upto = lambda part, mark: F.substring_index(part, mark, 1)
    middle = after(params.middle)
    psm = F.concat(upto(after(params.prefix), params.suffix), middle, upto(after(params.suffix), params.middle))
    spm = F.concat(upto(after(params.prefix), params.middle), middle, upto(after(params.suffix), params.prefix))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fim_digests(docs: DataFrame, params: FimParams = FimParams()) -> DataFrame:
    """The transformation's figures, with the digests of its output and of the text rebuilt from that."""
    made = fill_in_middle(docs, params)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form"), params).cast("binary"), 256).alias("restored_sha256"))
