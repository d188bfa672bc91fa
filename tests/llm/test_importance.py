"""op13: buckets, weights and the draw against a plain version with zlib and hashlib."""

import hashlib
import math
import random
import re
import zlib

from quarry.llm import importance as I

from ..conftest import SF001

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(docs, items, share=5, min_words=20):
    own, aim = [0] * 10000, [0] * 10000
    made = [(i, *features(t)) for i, t in docs]
    for _, _, f in made:
        for b in f:
            own[b] += 1
    for t in items:
        for b in features(t)[1]:
            aim[b] += 1
    s, t = sum(own), sum(aim)
    gain = [math.floor(1000 * math.log((aim[b] + 1) * (s + 10000) / ((own[b] + 1) * (t + 10000)))) for b in range(10000)]
    rows = []
    for i, n, f in made:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in f)
        rows.append([i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= min_words])
    fit = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    rank = {id(r): k + 1 for k, r in enumerate(fit[:share * len(fit) // 100])}
    return sorted(((*r[:4], rank.get(id(r))) for r in rows), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select(df.columns[0], "n_features", "weight", "score", "rank").collect()), key=str)


def test_pieces_keep_every_run():
    rnd = random.Random(1)
    letters = "abXYZ09 .é漢\n\0`{-_" + "q" * 5
    hasher = I.Hasher()
    for t in range(120):
        docs = ["".join(rnd.choice(letters) for _ in range(rnd.choice([0, 1, 5, 40, 300]))) for _ in range(rnd.randint(1, 6))]
        if t % 5 == 0:
            docs.append("x" * rnd.randint(60, 200) + " " + "é" * 40 + " b " + "q" * 70)
        rows, pieces = [], []
        for i, d in enumerate(docs):
            for p in I.cut(d.encode(), rnd.choice([3, 17, 1000])):
                rows.append(i)
                pieces.append(p)
        counts, runs = hasher.runs(pieces)
        words, found = [0] * len(docs), [[] for _ in docs]
        for k, c in enumerate(counts.tolist()):
            words[rows[k]] += c
        for piece, buckets in runs:
            for p, b in zip(piece.tolist(), buckets.tolist()):
                found[rows[p]].append(b)
        assert [(n, sorted(f)) for n, f in map(features, docs)] == [(n, sorted(f)) for n, f in zip(words, found)]


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    items = [r.text for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    out = got(I.op13_importance(spark, SF001))
    assert out == brute(docs, items) and sum(r[4] is not None for r in out) > 5


def test_nulls_repeats_ties_and_clashing_names(spark):
    rnd = random.Random(2)
    text = lambda: " ".join(rnd.choice(["aa", "Bb", "cc", "dd"]) for _ in range(rnd.choice([0, 5, 19, 20, 25])))
    docs = [(rnd.choice([None, *range(30)]), rnd.choice([None, "", text(), text()])) for _ in range(150)]
    docs += docs[:40] + [(5, "aa " * 30)] * 20 + [(7, "zz " * 40000)]
    d = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in docs], "doc_id long, text string, k0 int, words string, weight int")
    b = spark.createDataFrame([("cc dd",), (None,), ("Aa",)], "text string")
    out = got(I.resampled(d.repartition(5), b, share=40))
    assert out == brute(docs, ["cc dd", None, "Aa"], share=40)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(k, "a b c d " * (k % 9)) for k in range(60)], "doc_id long, text string")
    assert I.resampled(none, some).collect() == []
    assert got(I.resampled(some, none)) == brute([tuple(r) for r in some.collect()], [])
    assert all(r.rank is None for r in I.resampled(some.limit(3), some).collect())


def test_cutoff_is_exact_at_every_place(spark):
    rnd = random.Random(3)
    keys = [(rnd.randint(-9, 9), 0, rnd.randint(0, 5), 0) for _ in range(300)]
    df = spark.createDataFrame(keys, "k0 long, k1 long, k2 long, k3 long").repartition(7).cache()
    for want in (1, 2, 77, 150, 299, 300):
        assert I.cutoff(df, want, last_keys=3) == sorted(keys)[want - 1]
    assert I.cutoff(df, 0) is None
