"""Delimited-list columns: text -> clean set (array) -> added / removed members."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LIST_DELIMITERS = "[;,]+"
WHITESPACE = r"\s+"


def parse_list(text: Column | str, strip_whitespace: bool = True) -> Column:
    """'a; b,,c ,a' -> ['a','b','c'] (first-seen order, no blanks, no repeats).

    NULL text is an empty list.  ``strip_whitespace=False`` reproduces the
    variant whose whitespace pattern never matched, so blanks stay inside
    members ('1; 2' -> ['1', ' 2']).
    """
    col = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    if strip_whitespace:
        col = F.regexp_replace(col, WHITESPACE, "")
    parts = F.split(col, LIST_DELIMITERS)
    return F.array_distinct(F.filter(parts, lambda x: x != F.lit("")))


def list_adds(old_set: Column, new_set: Column) -> Column:
    """Members in ``new_set`` and not in ``old_set``."""
    return F.array_except(new_set, old_set)


def list_removes(old_set: Column, new_set: Column) -> Column:
    """Members in ``old_set`` and not in ``new_set``."""
    return F.array_except(old_set, new_set)
