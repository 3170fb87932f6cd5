"""Column expressions shared by the native operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: ASCII characters that are no letters or digits
_GAPS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())

#: a run of anything but blank, tab, newline, vertical tab, form feed, return
SPACED_WORD = r"[^\x20\x09-\x0D]+"


def whole_text(text: str | Column) -> Column:
    """The text, with null as the empty string."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; every other character stays, unlike ``lower``."""
    return F.translate(text, _UPPER, _UPPER.lower())


def plain_words(text: Column) -> Column:
    """Lower-cased words of letters, digits and non-ASCII characters, with one
    blank before, between and after them; a text without words gives a blank."""
    spaced = F.translate(text, _UPPER + _GAPS, _UPPER.lower() + " " * len(_GAPS))
    return F.regexp_replace(F.concat(F.lit(" "), spaced, F.lit(" ")), " +", " ")


def spaced_word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SPACED_WORD)).cast("long")


def only(docs: DataFrame, **columns: str) -> DataFrame:
    """The named columns under internal names, so that other columns can't clash."""
    return docs.select(*(F.col(f"`{c}`").alias(name) for name, c in columns.items()))
