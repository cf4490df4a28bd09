"""Word expressions that several operators share. A word is a run of ``[^\\x20\\x09-\\x0D]``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ASCII white space, as a regular expression and as characters.
SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def words_of(text: Column) -> Column:
    """The words of ``text`` in order; null has none."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACES))


def count_words(text: Column) -> Column:
    """How many words ``text`` has, without making them."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def count_chars(text: Column, chars: str) -> Column:
    """How many characters of ``text`` are among ``chars``."""
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")
