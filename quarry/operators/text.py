"""Word, term and document frequencies (A1-A4).

All four are one narrow tokenising projection, an ``explode`` and a
``groupBy().count()``: Spark plans a partial (map-side) aggregate before the
hash exchange, so a very frequent word costs one row per input partition in
the shuffle, never one row per occurrence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as T


def doc_frequency(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """A3: number of records containing each lower-cased letter run -> (term, doc_count)."""
    terms = docs.select(F.explode(T.distinct_lower_terms(text_col)).alias("term"))
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("doc_count"))


def term_frequency(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """A4: occurrences of each lower-cased letter run -> (term, term_count)."""
    terms = docs.select(F.explode(T.lower_terms(text_col)).alias("term"))
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("term_count"))


def word_count(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """A2: whitespace tokens of stripped lines, empty tokens dropped, case kept -> (word, cnt).

    Splitting the whole text on whitespace equals splitting each stripped line,
    because the line breaks are whitespace themselves.
    """
    words = docs.select(F.explode(T.split_ws_stripped(text_col)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


def word_count_ws(docs: DataFrame, text_col: str = "text", keep_empty: bool = True) -> DataFrame:
    """A1: per line, split on single whitespace characters with Java rules -> (word, cnt).

    ``keep_empty=True`` counts the empty tokens that rule produces (D1).
    """
    line_rows = docs.select(F.explode(T.lines(text_col)).alias("line"))
    words = line_rows.select(F.explode(T.split_ws_java("line")).alias("word"))
    if not keep_empty:
        words = words.filter(F.col("word") != "")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
