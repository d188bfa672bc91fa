"""op5: spans against brute force on words, planted passages, odd rows."""

import random
from collections import defaultdict

import numpy as np

from quarry.llm import substring as S

from ..conftest import SF001


def brute(texts):
    """Sentences to remove of each id, by comparing the runs' words."""
    seen, gone = defaultdict(list), defaultdict(set)
    for i in sorted(texts):
        _, _, counts, normal = S.sentences(texts[i])
        total = np.concatenate(([0], np.cumsum(counts)))
        for a in range(len(counts)):
            for e in range(a + 2, len(counts) + 1):
                words = total[e] - total[a]
                if words >= S.MIN_WORDS and (e - a >= S.RUN or words >= S.ENOUGH_WORDS):
                    seen[tuple(normal[a:e])].append((i, a, e))
                    break
    for places in seen.values():
        for i, a, e in places:
            if (i, a) != min(places)[:2]:
                gone[i] |= set(range(a, e))
    return gone


def test_query_matches_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    gone = brute(texts)
    assert gone
    for r in S.op5_substring(spark, SF001).collect():
        raw, starts, _, _ = S.sentences(texts[r.doc_id])
        edges = [0, *starts[1:].tolist(), len(raw)]
        kept = b"".join(raw[a:b] for k, (a, b) in enumerate(zip(edges, edges[1:])) if k not in gone[r.doc_id])
        assert r.text == (kept.decode() if gone[r.doc_id] else texts[r.doc_id])
        assert r.n_removed == len(gone[r.doc_id]) and r.n_chars == len(r.text)


def test_planted_passages(spark):
    random.seed(8)
    word = lambda: "".join(random.choice("abcdefghijklmnop") for _ in range(random.randint(2, 9)))
    def prose(n, marks=True):
        return " ".join(word() + (random.choice(["", "", "", "", ",", "."]) if marks else "") for _ in range(n))

    passages = [prose(60), prose(80, marks=False), "!! ".join(word() for _ in range(70))]
    docs = [(i, f"{prose(40)} {passages[i % 3]} {prose(30)}" if i < 30 else prose(90)) for i in range(60)]
    got = {r.doc_id: r for r in S.deduplicated(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    windows = defaultdict(set)
    for i, r in got.items():
        words = r.text.split()
        for a in range(len(words) - 49):
            windows[" ".join(words[a:a + 50])].add(i)
    assert all(len(v) == 1 for v in windows.values())
    texts = dict(docs)
    assert all(got[i].text == texts[i] and not got[i].n_removed for i in [0, 1, 2, *range(30, 60)])
    for i in range(3, 30):  # the words around a passage stay but for its edge sentences
        assert 0 < got[i].n_removed and len(got[i].text.split()) >= 60


def test_every_passage_of_50_words_holds_a_span():
    """Unpunctuated ones, hardly punctuated ones and such over few distinct words, each between two different neighbours."""
    for seed in range(1500):
        rng = random.Random(seed)
        letters, marks = ("abcdefghijklmnop", "ab")[seed % 2], ("", "", ".", ",")[seed % 4]
        size = 2 if seed % 6 == 1 else 7
        def prose(n):
            return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, size)))
                            + (marks if rng.random() < 0.08 else "") for _ in range(n))

        passage = prose(50)
        a, b = (set(S.spans(*S.sentences(f"{prose(rng.randint(0, 40))} {passage} {prose(rng.randint(0, 40))}")[2:])[0].tolist())
                for _ in range(2))
        assert a & b, (seed, passage)


def test_odd_rows(spark):
    line = "one two three four, five six seven eight. nine ten eleven twelve; thirteen fourteen fifteen sixteen! "
    data = [(2, line), (1, line * 3), (3, None), (4, ""), (5, "..,,!!"), (None, line), (6, "short, line."), (6, "short, line."),
            (7, "x " * 40_000), (8, "é, " + line + "ü end.")]
    df = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 as id", "'k' as first", "9 as n_removed")
    out = S.deduplicated(df)
    assert out.columns == ["doc_id", "text", "id", "first", "n_removed"]
    got = [(r.doc_id, r.text) for r in out.collect()]
    assert len(got) == len(data)
    of = dict(got)
    assert of[1] == line.rstrip() and of[2] == "" and of[None] == line and of[3] is None and of[4] == "" and of[5] == "..,,!!"
    assert of[8] == "é, ü end." and of[6] == "short, line." and len(of[7]) < 80_000
    assert S.deduplicated(df.limit(0)).collect() == []


def test_different_texts_under_one_id(spark):
    line = "one two three four, five six seven eight. nine ten eleven twelve; thirteen fourteen fifteen sixteen! "
    other = " ".join(f"w{i}{',' * (i % 4 == 3)}" for i in range(60))
    data = [(1, line), (2, other + ". " + line), (2, line), (2, "short."), (3, other), (4, line[:-1] + " tail."), (4, other + " end.")]
    out = S.deduplicated(spark.createDataFrame(data, "doc_id long, text string"))
    got = sorted((r.doc_id, r.text.strip()) for r in out.collect())
    assert got == sorted([(1, line.strip()), (2, other + "."), (2, ""), (2, "short."), (3, ""), (4, "tail."), (4, "end.")])
    twice = [(7, "a b c. " + line), (7, "d e f. " + line)]
    out = S.deduplicated(spark.createDataFrame(twice, "doc_id long, text string"))
    assert sorted(r.n_removed for r in out.collect()) == [0, 4]
