"""Toxicity severity by cumulative-link ordinal regression over sparse text features."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import appended, hash_order, map_arrow, pages_of, pick, staged, table

ROWS_PER_CLASS = 3000  # the model is fitted on at most so many labelled rows of each class
MAX_FEATURES = 20_000
MIN_LOG_ODDS = 1.1  # a feature's smoothed log odds ratio between the classes exceeds this ...
STANDARD_ERRORS = 2.0  # ... by so many standard errors, so that chance words of a small sample stay out
GRADES = 4  # 0 clean, 1 to 3 rising amounts of toxic evidence
REJECT_AT = 0.35  # probability of any severity above 0; labelled clean rows stay below it
EDGE = " \t\r\n.,;:!?\"'()[]{}<>|*#$%&/\\=+-_~`^@"
CACHE_WORDS = 200_000


def features_of(token: str) -> tuple[str, ...]:
    """Sparse features of one white-space token: the bare word and its first four and five letters.

    Inflected forms of a stem meet in the prefix features.
    """
    word = token.strip(EDGE)
    if not word:
        return ()
    out = [f"w:{word}"]
    out += [f"{n}:{word[:n]}" for n in (4, 5) if len(word) >= n]
    return tuple(out)


class Extractor:
    """Counts of known features (by column number) in a text; remembers a bounded number of tokens."""

    def __init__(self, columns: dict[str, int]):
        self.columns, self.seen = columns, {}

    def counts(self, text: str | None) -> tuple[dict[int, int], int]:
        """({column: count}, number of tokens); null and empty texts have neither."""
        from collections import Counter

        tokens = Counter((text or "").lower().split())
        if len(self.seen) > CACHE_WORDS:
            self.seen.clear()
        out: dict[int, int] = {}
        seen, columns = self.seen, self.columns
        for token, n in tokens.items():
            hit = seen.get(token)
            if hit is None:
                hit = seen[token] = tuple(columns[f] for f in features_of(token) if f in columns)
            for c in hit:
                out[c] = out.get(c, 0) + n
        return out, tokens.total()


@dataclass
class OrdinalModel:
    """P(severity > k) = sigmoid(w.x - threshold_k), the same weights for every threshold."""

    columns: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    thresholds: np.ndarray = field(default_factory=lambda: np.full(GRADES - 1, np.inf))

    def above(self, counts: dict[int, int]) -> np.ndarray:
        """P(severity > 0), P(severity > 1), ...; all zero when nothing toxic was labelled."""
        eta = sum(self.weights[c] * np.log1p(n) for c, n in sorted(counts.items()))
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds - eta, -500, 500)))


def fit_ordinal(rows: list[dict[int, int]], grade: np.ndarray, n_features: int, grades: int = GRADES,
                l2: float = 1e-3, steps: int = 400, rate: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds that maximise the cumulative-link likelihood (Adam, full batch)."""
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.array([c for r in rows for c in r], np.int64)
    val = np.log1p(np.array([n for r in rows for n in r.values()], float))
    params = np.zeros(n_features + grades - 1)
    params[n_features:] = [1.0] + [0.0] * (grades - 2)  # first threshold, then logs of the gaps
    m, v = np.zeros_like(params), np.zeros_like(params)

    def cut(p):
        return np.cumsum(np.concatenate((p[n_features:n_features + 1], np.exp(p[n_features + 1:]))))

    for t in range(1, steps + 1):
        w, theta = params[:n_features], cut(params)
        eta = np.bincount(at, val * w[col], len(rows)) if len(col) else np.zeros(len(rows))
        edges = np.concatenate(([-np.inf], theta, [np.inf]))
        sig = lambda z: 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))
        hi, lo = sig(edges[grade + 1] - eta), sig(edges[grade] - eta)
        hi, lo = np.where(grade == grades - 1, 1.0, hi), np.where(grade == 0, 0.0, lo)
        p = np.maximum(hi - lo, 1e-9)
        dhi, dlo = hi * (1 - hi), lo * (1 - lo)
        g_eta = (dhi - dlo) / p / len(rows)  # gradient of the negative log likelihood
        g = np.zeros_like(params)
        if len(col):
            g[:n_features] = np.bincount(col, val * g_eta[at], n_features) + l2 * w
        g_theta = np.array([(-(dhi / p)[grade == k].sum() + (dlo / p)[grade == k + 1].sum()) / len(rows)
                            for k in range(grades - 1)])
        gaps = np.exp(params[n_features + 1:])
        g[n_features] = g_theta.sum()
        g[n_features + 1:] = [g_theta[k + 1:].sum() * gaps[k] for k in range(grades - 2)]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        params -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return params[:n_features], cut(params)


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """(id, text, toxic): at most ``per_class`` labelled documents of each class, in a fixed hash order.

    Labels with a null id or grade are left out; of repeated labels the larger counts.
    """
    known = (pick(labels, id="doc_id", toxic="toxic").filter("id is not null and toxic in (0, 1)")
             .groupBy("id").agg(F.max("toxic").alias("toxic")))
    order = [hash_order(F.col("id")), F.col("id")]
    chosen = known.filter("toxic = 1").orderBy(*order).limit(per_class).unionByName(
        known.filter("toxic = 0").orderBy(*order).limit(per_class))
    return pick(docs, id="doc_id", text="text").join(F.broadcast(chosen), "id")


def train(docs: DataFrame, labels: DataFrame, per_class: int = ROWS_PER_CLASS) -> OrdinalModel:
    """Fit on a bounded sample of labelled rows.

    Features are chosen by an aggregate (documents of each class that hold them); grades
    1, 2, 3 of toxic rows are thirds by their amount of toxic-leaning words (sum of log counts).
    """
    sample = staged(labelled_sample(docs, labels, per_class), "toxicity-sample")
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return OrdinalModel()

    def present(batches):
        for texts, toxic in pages_of(batches, "text", "toxic"):
            feats, ys = [], []
            for text, y in zip(texts, toxic):
                own = {f for tok in set((text or "").lower().split()) for f in features_of(tok)}
                feats += own
                ys += [y] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(feats, pa.string()), pa.array(ys, pa.int32())],
                                             names=["f", "toxic"])

    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / (F.lit(n1 + 1.0) - a)) - F.log(b / (F.lit(n0 + 1.0) - b))
    error = F.sqrt(1 / a + 1 / b + 1 / (F.lit(n1 + 1.0) - a) + 1 / (F.lit(n0 + 1.0) - b))
    chosen = (map_arrow(sample.select("text", F.col("toxic").cast("int")), present, "f string, toxic int")
              .groupBy("f").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
              .withColumns({"odds": odds, "low": F.abs(odds) - STANDARD_ERRORS * error})
              .filter(F.col("low") >= MIN_LOG_ODDS).orderBy(F.desc("low"), "f").limit(MAX_FEATURES)
              .select("f", "odds").collect())
    columns = {r["f"]: i for i, r in enumerate(chosen)}
    leaning = np.array([r["odds"] > 0 and r["f"][0] in "w4" for r in chosen], bool)

    def sparse(batches):
        ex = Extractor(columns)
        for texts, toxic in pages_of(batches, "text", "toxic"):
            found = [ex.counts(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(toxic, pa.int32()), pa.array([n for _, n in found], pa.int64()),
                 pa.array([list(c) for c, _ in found], pa.list_(pa.int32())),
                 pa.array([list(c.values()) for c, _ in found], pa.list_(pa.int32()))],
                names=["toxic", "n", "cols", "vals"])

    got = (map_arrow(sample.select("text", F.col("toxic").cast("int")), sparse,
                     "toxic int, n long, cols array<int>, vals array<int>").collect())
    got.sort(key=lambda r: (r["toxic"], r["n"], r["cols"], r["vals"]))  # the same fit whatever the order of tasks
    rows = [dict(zip(r["cols"], r["vals"])) for r in got]
    toxic = np.array([r["toxic"] for r in got])
    evidence = np.array([sum(np.log1p(n) for c, n in row.items() if leaning[c]) for row in rows])
    cuts = np.quantile(evidence[toxic == 1], [1 / 3, 2 / 3])
    grade = np.where(toxic == 1, 1 + np.searchsorted(cuts, evidence, side="left"), 0)
    weights, thresholds = fit_ordinal(rows, grade, len(columns))
    return OrdinalModel(columns, weights, thresholds)


def score(docs: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """``docs`` with severity (expected grade, 0 to 3), p_toxic and is_toxic added; every row stays.

    Null and empty texts have no features and so the severity of the thresholds alone.
    """
    return (appended(docs, text_col, [("severity", "double"), ("p_toxic", "double")], _scorer(model))
            .withColumn("is_toxic", F.col("p_toxic") >= REJECT_AT))


def _scorer(model: OrdinalModel):
    def setup():
        ex = Extractor(model.columns)

        def of(texts):
            above = np.array([model.above(ex.counts(t)[0]) for t in texts.to_pylist()]).reshape(len(texts), -1)
            return [pa.array(above.sum(axis=1)), pa.array(above[:, 0])]

        return of

    return setup


def keep_clean(docs: DataFrame, labels: DataFrame, per_class: int = ROWS_PER_CLASS) -> DataFrame:
    """Rows of ``docs`` that the model doesn't reject, with the columns of ``docs`` as they are."""
    names = docs.columns
    plain = docs.toDF(*[f"_d{i}" for i in range(len(names))])
    scored = score(plain, train(docs, labels, per_class), f"_d{names.index('text')}")
    return scored.filter(~F.col("is_toxic")).select(*[F.col(f"_d{i}").alias(n) for i, n in enumerate(names)])


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op6: severity of every document of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", F.round("severity", 6).alias("severity"), F.round("p_toxic", 6).alias("p_toxic"), "is_toxic")
