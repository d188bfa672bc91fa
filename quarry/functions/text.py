"""Tokenising, case and length helpers for text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token and line patterns that define the results.
LETTER_RUN = r"\p{L}+"          # a maximal run of Unicode letters
LINE_BREAK = r"\r\n|\n|\r"       # text-file line terminators
WS_CHAR = r"\s"                  # one whitespace character (ASCII class, like Java's split)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def letter_runs(text) -> Column:
    """every maximal run of letters, in order, case kept."""
    return F.regexp_extract_all(_col(text), F.lit(LETTER_RUN), 0)


def lower_terms(text) -> Column:
    """F3 + F4: letter runs, lower-cased after matching."""
    return F.transform(letter_runs(text), lambda w: F.lower(w))


def distinct_lower_terms(text) -> Column:
    """F3 + F4 + A16: the set of lower-cased letter runs of one record."""
    return F.array_distinct(lower_terms(text))


def lines(text) -> Column:
    """Split a text into lines the way a text-file reader does: a break ends a line, so one at
    the end of the text opens no further line, and an empty text has none."""
    parts = F.split(_col(text), LINE_BREAK)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def split_ws_java(line) -> Column:
    """split on single whitespace characters with Java ``String.split`` rules.

    Leading and inner empty strings are kept, trailing ones dropped; the empty
    line yields one empty token and a whitespace-only line yields none.
    """
    c = _col(line)
    return (F.when(c == "", F.array(F.lit("")))
            .when(c.rlike(r"^\s+$"), F.array().cast("array<string>"))
            .otherwise(F.split(F.regexp_replace(c, r"\s+$", ""), WS_CHAR)))


def split_ws_stripped(line) -> Column:
    """F2 + P11: strip, split on whitespace, drop empty tokens."""
    return F.filter(F.split(F.trim(_col(line)), WS_CHAR), lambda w: w != "")


def utf16_length(s) -> Column:
    """length in UTF-16 code units (what a JVM ``String.length()`` reports)."""
    return (F.octet_length(F.encode(_col(s), "UTF-16BE")) / 2).cast("int")


def padded(value, width: int, fill: str = "0") -> Column:
    """The value as text, filled on the left up to ``width``; longer values stay whole."""
    s = _col(value).cast("string")
    return F.concat(F.repeat(F.lit(fill), F.greatest(F.lit(width) - F.length(s), F.lit(0))), s)


def first_field_rest(line) -> tuple[Column, Column]:
    """first whitespace-separated field, and the remaining fields joined by one space."""
    parts = F.split(F.trim(_col(line)), r"\s+")
    return parts[0], F.array_join(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), " ")
