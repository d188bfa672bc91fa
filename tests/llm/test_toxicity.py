"""op6: the ordinal model on held-out rows and made-up severities."""

import random

import numpy as np
from pyspark.sql import functions as F

from quarry.llm import toxicity as T

from ..conftest import SF01


def made(n, seed):
    random.seed(seed)
    clean = ["tree", "house", "river", "green", "walk", "bread", "table", "cloud"]
    bad = ["scumlor", "scumlei", "idiot", "worthless"]
    rows = []
    for i in range(n):
        toxic = i % 4 == 0
        words = [random.choice(clean) for _ in range(60)]
        if toxic:
            for _ in range(random.choice((2, 5, 12))):
                words.insert(random.randrange(len(words)), random.choice(bad))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def split(spark, rows):
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    return docs, labels


def test_held_out_rows_and_expected_severity(spark):
    docs, labels = split(spark, made(800, 1))
    model = T.train(docs, labels)
    assert list(model.thresholds) == sorted(model.thresholds)
    held = made(400, 2)
    got = {r.doc_id: r for r in T.score(split(spark, held)[0], model).collect()}
    wrong = sum(got[i].is_toxic != bool(y) for i, _, y in held)
    assert wrong <= 4
    for i, _, y in held:
        assert 0 <= got[i].severity <= 3
    often = T.score(spark.createDataFrame([(1, "idiot tree"), (2, "idiot scumlor " * 9)], "doc_id long, text string"), model)
    a, b = [r.severity for r in often.orderBy("doc_id").collect()]
    assert a < b


def test_labelled_table(spark):
    """Held out: fitted on the other half of the labels, few labelled rows."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet").select("doc_id", "toxic")
    model = T.train(docs, labels.filter("doc_id % 2 = 0"))
    got = T.score(docs, model).join(labels.filter("doc_id % 2 = 1"), "doc_id")
    right = got.filter(F.col("is_toxic") == (F.col("toxic") == 1)).count()
    assert right / got.count() > 0.88


def test_fit_recovers_order():
    rows = [{0: k} if k else {} for k in (0, 1, 3, 9) for _ in range(50)]
    w, theta = T.fit_ordinal(rows, np.repeat([0, 1, 2, 3], 50), 1)
    assert w[0] > 0 and list(theta) == sorted(theta)


def test_odd_rows(spark):
    docs, labels = split(spark, made(200, 3))
    labels = labels.unionByName(spark.createDataFrame([(None, 1), (7, None), (8, 0), (0, 0)], "doc_id long, toxic int"))
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "idiot " * 50_000), (None, "tree"), (4, "tree"), (4, "tree")],
                                "doc_id long, text string").selectExpr("*", "'s' as severity", "2 as _c1")
    got = T.score(odd, T.train(docs, labels)).collect()
    assert len(got) == 6 and sum(r.is_toxic for r in got) == 1
    kept = T.keep_clean(docs.withColumns({"severity": F.lit("x"), "_d0": F.lit(1)}), labels)
    assert kept.columns == ["doc_id", "text", "severity", "_d0"]
    assert 140 <= kept.count() <= 160


def test_no_labels_and_empty_table(spark):
    docs, labels = split(spark, made(20, 4))
    none = labels.limit(0)
    assert T.keep_clean(docs, none).count() == 20
    assert T.score(docs.limit(0), T.train(docs, labels)).collect() == []


def test_query_matches_plain_scoring(spark):
    """Chosen features and every document's severity against plain counting over the whole table."""
    import math

    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    model = T.train(docs, labels)
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}

    def words(text):
        return [w for w in (t.strip(T.EDGE) for t in (text or "").lower().split()) if w]

    def features(text):
        count = {}
        for w in words(text):
            for f in [f"w:{w}"] + [f"{n}:{w[:n]}" for n in (4, 5) if len(w) >= n]:
                count[f] = count.get(f, 0) + 1
        return count

    own = {i: features(t) for i, t in texts.items()}
    grades = {}
    for r in labels.select("doc_id", "toxic").collect():
        if r.doc_id is not None and r.toxic in (0, 1):
            grades[r.doc_id] = max(grades.get(r.doc_id, 0), r.toxic)
    sizes = [sum(1 for i, g in grades.items() if g == k and i in own) for k in (0, 1)]
    assert max(sizes) <= T.ROWS_PER_CLASS  # the bounded sample is all labelled rows here
    held = {}
    for i, g in grades.items():
        for f in own.get(i, ()):
            held.setdefault(f, [0, 0])[g] += 1
    chosen = set()
    for f, (clean, bad) in held.items():
        a, b = bad + 0.5, clean + 0.5
        a0, b0 = sizes[1] + 1 - a, sizes[0] + 1 - b
        odds = math.log(a / a0) - math.log(b / b0)
        if abs(odds) - T.STANDARD_ERRORS * math.sqrt(1 / a + 1 / b + 1 / a0 + 1 / b0) >= T.MIN_LOG_ODDS:
            chosen.add(f)
    assert chosen == set(model.columns)
    for r in T.score(docs.select("doc_id", "text"), model).collect():
        eta = sum(float(model.weights[model.columns[f]]) * math.log1p(n) for f, n in own[r.doc_id].items() if f in model.columns)
        above = [1 / (1 + math.exp(min(500, max(-500, t - eta)))) for t in model.thresholds]
        assert abs(r.severity - sum(above)) < 1e-9 and abs(r.p_toxic - above[0]) < 1e-9
        assert r.is_toxic == (r.p_toxic >= T.REJECT_AT)
