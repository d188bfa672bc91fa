"""Language of web pages by Bayesian fusion of text, declared language, address suffix and host priors."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import appended, hash_order, map_arrow, pages_of, pick, staged, table
from quarry.llm.html_extract import extract

DOCS_PER_LANGUAGE = 512  # the text model is fitted on at most so many documents of each language
LOTS = 64
BUCKETS = 2**15  # hashed letter triples
SMOOTHING = 0.5
EFFECTIVE_TRIPLES = 40  # a text counts as at most so many independent triples
HOST_WEIGHT, DOMAIN_WEIGHT, SUFFIX_WEIGHT = 5.0, 10.0, 20.0  # pseudo-pages that the level above lends
DECLARED = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\x22']?\s*([A-Za-z]{2,3})", re.I)


def triples(text: str | None) -> np.ndarray:
    """Bucket of every run of three characters of the lower-cased text, digits and punctuation as blanks."""
    plain = re.sub(r"[\W\d_]+", " ", (text or "").lower()).strip()
    if not plain:
        return np.zeros(0, np.int64)
    c = np.frombuffer(f" {plain} ".encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    h = c[:-2] * np.uint64(0x9E3779B1) + c[1:-1] * np.uint64(0x85EBCA77) + c[2:] * np.uint64(0xC2B2AE3D)
    h ^= h >> np.uint64(15)
    return ((h * np.uint64(0x27D4EB2F)) >> np.uint64(11)).astype(np.int64) % BUCKETS


class TextModel:
    """Multinomial log probabilities of triples, a row per language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        p = counts + SMOOTHING
        self.logs = np.log(p / p.sum(axis=1, keepdims=True)) if len(languages) else np.zeros((0, BUCKETS))

    def log_likelihood(self, text: str | None) -> np.ndarray:
        """Log likelihood of the text in each language, tempered; no text: all equal."""
        at = triples(text)
        if not len(at):
            return np.zeros(len(self.languages))
        return self.logs[:, at].mean(axis=1) * min(len(at), EFFECTIVE_TRIPLES)


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id",
          per_language: int = DOCS_PER_LANGUAGE) -> TextModel:
    """Fit on a bounded, hash-ordered sample of documents of each declared language."""
    from pyspark.sql import Window as W

    known = pick(docs, id=id_col, lang=lang_col).filter("id is not null and lang is not null")
    # an equal share from each of several lots of a language, so that no task orders a language's every row
    lot = F.pmod(F.xxhash64(F.lit("lot"), "id"), F.lit(LOTS))
    nth = F.row_number().over(W.partitionBy("lang", "lot").orderBy(hash_order(F.col("id")), "id"))
    chosen = F.broadcast(known.withColumn("lot", lot).withColumn("nth", nth)
                         .filter(F.col("nth") <= -(-per_language // LOTS)).select("id", "lang"))
    sample = pick(docs, id=id_col, text=text_col).join(chosen, "id").select("lang", "text")

    def count(batches):
        for langs, texts in pages_of(batches, "lang", "text"):
            total: dict[str, np.ndarray] = {}
            for lang, t in zip(langs, texts):
                total.setdefault(lang, np.zeros(BUCKETS, np.int64))
                total[lang] += np.bincount(triples(t), minlength=BUCKETS)
            rows = [(lang, b, int(v[b])) for lang, v in total.items() for b in np.flatnonzero(v).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in
                                              enumerate((pa.string(), pa.int32(), pa.int64()))],
                                             names=["lang", "bucket", "n"])

    rows = (map_arrow(sample, count, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect())
    languages = sorted({r["lang"] for r in rows})
    counts = np.zeros((len(languages), BUCKETS))
    for r in rows:
        counts[languages.index(r["lang"]), r["bucket"]] = r["n"]
    return TextModel(languages, counts)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _sums(n: int) -> list[Column]:
    return [F.sum(F.col("post")[i]).alias(f"s{i}") for i in range(n)] + [F.count(F.lit(1)).alias("pages")]


def identified(pages: DataFrame, model: TextModel, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html") -> DataFrame:
    """(id, url, lang, p, text_lang, declared): a row for each page.

    Text gives a likelihood of each language.  Its posteriors, summed by declared language,
    suffix, registered name and host, give how languages are declared, and priors of the
    suffix, smoothed by all pages, of the name, smoothed by the suffix, and of the host,
    smoothed by the name (a page's own share taken out).  The product of all decides, ties
    to the first language by name.

    No html or no text: the text says nothing; no declaration or address: likewise, such
    pages form one value of their own.  No labelled language at all: lang and p are null.
    Sums are taken by one aggregate over (host, declared) with a map-side part; the levels
    above are sums of its rows.  Pages join those cells on both keys, from written tables,
    so a hot host can be split.
    """
    n = len(model.languages)
    src = pick(pages, id=id_col, url=url_col, html=html_col)
    if not n:
        return src.select("id", "url", *[F.lit(None).cast(k).alias(c) for c, k in
                                         (("lang", "string"), ("p", "double"), ("text_lang", "string"))],
                          F.lit("").alias("declared"))

    def setup():
        def of(column):
            logs, declared = [], []
            for h in column.to_pylist():
                logs.append(model.log_likelihood(extract(h)).tolist())
                m = DECLARED.search(h or "")
                declared.append(m[1].lower() if m else "")
            return [pa.array(logs, pa.list_(pa.float64())), pa.array(declared, pa.string())]

        return of

    seen = appended(src, "html", [("ll", "array<double>"), ("declared", "string")], setup).drop("html")
    top = F.array_max("ll")
    seen = (seen.withColumn("weight", F.transform("ll", lambda x: F.exp(x - top)))
            .withColumn("post", F.transform("weight", lambda x: x / F.aggregate("weight", F.lit(0.0), lambda a, b: a + b)))
            .drop("weight").withColumn("host", host_of(F.col("url")))
            .withColumn("name", F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1))
            .withColumn("suffix", F.regexp_extract("host", r"([^.]+)$", 1)))
    seen = staged(seen, "langid-seen")
    cells = staged(seen.groupBy("host", "name", "suffix", "declared").agg(*_sums(n)), "langid-cells")

    def level(prefix: str, *keys: str) -> DataFrame:
        sums = [F.sum(f"s{i}").alias(f"{prefix}{i}") for i in range(n)] + [F.sum("pages").alias(f"{prefix}_n")]
        return cells.groupBy(*keys).agg(*sums) if keys else cells.agg(*sums)

    out = (cells.join(level("h", "host"), "host").join(level("d", "name"), "name").join(level("x", "suffix"), "suffix")
           .join(level("c", "declared"), "declared").crossJoin(F.broadcast(level("g"))))  # one row of totals
    col = F.col
    every = [(col(f"g{i}") + 1) / (col("g_n") + n) for i in range(n)]
    suffix = [(col(f"x{i}") + SUFFIX_WEIGHT * every[i]) / (col("x_n") + SUFFIX_WEIGHT) for i in range(n)]
    out = out.withColumns({f"px{i}": suffix[i] for i in range(n)})
    out = out.withColumns({f"pd{i}": (col(f"d{i}") + DOMAIN_WEIGHT * col(f"px{i}")) / (col("d_n") + DOMAIN_WEIGHT)
                           for i in range(n)})
    # how often a page of a language declares this; against all pages, so a rare declaration isn't a penalty
    said = [F.log((col(f"c{i}") + 1) / (col(f"g{i}") + n) * (col("g_n") + n) / (col("c_n") + 1)) for i in range(n)]
    out = staged(out.select(col("host").alias("_host"), col("declared").alias("_declared"),
                            F.array(*said).alias("said"), F.array(*[col(f"pd{i}") for i in range(n)]).alias("above"),
                            F.array(*[col(f"h{i}") for i in range(n)]).alias("own"), col("h_n").alias("own_n")),
                 "langid-evidence")
    joined = seen.join(out, (col("host") == col("_host")) & (col("declared") == col("_declared")))
    fused = [col("ll")[i] + F.when(col("declared") != "", col("said")[i]).otherwise(0.0)
             + F.log((F.greatest(col("own")[i] - col("post")[i], F.lit(0.0)) + HOST_WEIGHT * col("above")[i])
                     / (col("own_n") - 1 + HOST_WEIGHT)) for i in range(n)]
    names = F.array(*[F.lit(x) for x in model.languages])
    best = F.array_max("fused")
    return (joined.withColumn("fused", F.array(*fused))
            .select("id", "url", F.get(names, F.array_position("fused", best).cast("int") - 1).alias("lang"),
                    (1.0 / F.aggregate("fused", F.lit(0.0), lambda a, x: a + F.exp(x - best))).alias("p"),
                    F.when(F.array_min("ll") < F.array_max("ll"),
                           F.get(names, F.array_position("ll", F.array_max("ll")).cast("int") - 1)).alias("text_lang"),
                    "declared"))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op9 over the whole ``pages`` table; the text model learns from ``documents``."""
    model = train(table(spark, sf_dir, "documents"))
    return identified(table(spark, sf_dir, "pages"), model).select(
        F.col("id").alias("page_id"), "url", "lang", F.round("p", 6).alias("p"), "text_lang", "declared")
