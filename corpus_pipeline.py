"""The training-corpus pipeline: STAGES over ``documents``, each written as Parquet and reread by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import bpe, decontam, pii, simhash, toxicity
from quarry.llm.common import staged, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model rejects go; it is fitted on labelled rows of ``documents``."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, the one with the smallest id."""
    return simhash.keep_one_per_group(docs, shingle=simhash.SHINGLE_WORDS, max_bits=simhash.MAX_BITS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind; every document stays."""
    return pii.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the kept texts, their number and digests (of the ids and of the bytes they decode to).

    The ids are staged: encoding and decoding in one Spark stage would hold two Python workers a task slot.
    """
    import public_tokenizers

    path = public_tokenizers.path(bpe.RANK_FILE)
    coded = bpe.encode(docs, path, public_tokenizers.PATTERN).select("doc_id", "lang", "source", "ids")
    return bpe.with_digests(bpe.decode(staged(coded, "token-ids"), path)).drop("decoded")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("pii redaction", personal),
    ("byte-level bpe", tokens),
]

# Hashing words, boosted trees and merges have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the whole ``documents`` table of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
