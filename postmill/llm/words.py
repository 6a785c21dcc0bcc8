"""Words of a text as SQL expressions; a word is a run of anything but ASCII white space."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")
