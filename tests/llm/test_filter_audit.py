"""op11: the audit against a plain count over texts; the matrix against word counts."""

import random
import re
from collections import Counter
from itertools import permutations
from zlib import crc32

import numpy as np
import pyarrow as pa

from quarry.llm import filter_audit as A

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def fails(text, smaller):
    w = WORDS.findall(text)
    return {f for f, bad in zip("ABCDE", (
        len(w) < 50, 100 * len(set(w)) < 65 * len(w),
        100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
        any(c in "#$%&*|" for c in text), smaller)) if bad}


def brute(docs, labels):
    """docs: (id, text, part); labels: (id, quality, toxic)."""
    rows = []
    for i, t, p in docs:
        t = t or ""
        smaller = i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs)
        good = any(j == i and q == 1 for j, q, _ in labels if i is not None)
        toxic = any(j == i and x == 1 for j, _, x in labels if i is not None)
        rows.append((p or "", fails(t, smaller), good, toxic))
    out = []
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        shapley = Counter()
        some = []
        for o in permutations("ABCDE"):
            for k, f in enumerate(o):
                here = [r for r in own if f in r[1] and not r[1] & set(o[:k])]
                shapley[f] += len(here)
                some.append(("".join(o), k + 1, f, sum(not r[1] & set(o[:k + 1]) for r in own), len(here),
                             sum(f in r[1] and bool(r[1] & set(o[:k])) for r in own), sum(r[1] == {f} for r in own),
                             sum(r[2] for r in here), sum(r[3] for r in here)))
        out += [(part, o, k, kept, gone, red, uni, g, t, shapley[f]) for o, k, f, kept, gone, red, uni, g, t in some]
    return sorted(out)


COLS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def odd_docs(seed=5, n=120):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeABé#") for _ in range(rnd.randint(1, 3)))
    texts = [None, "", " \t\n", "a", "A" * 40, "x y " * 60, "one two\x0bthree\x1cfour " * 20, "word " * 5000, "%"]
    texts += [" ".join(word() for _ in range(rnd.choice([3, 49, 50, 51, 90]))) for _ in range(30)]
    texts += [" ".join(f"w{k}" for k in range(60)) + x for x in ("", "$", " A B C D E F G H I J K L M")]
    return [(rnd.choice([None, *range(40)]), rnd.choice(texts), rnd.choice([None, "", "s1", "s2"])) for _ in range(n)]


def test_audit_matches_brute_force(spark):
    docs = odd_docs()
    docs += docs[:10]
    labels = [(i % 37, i % 2, i % 3 == 0) for i in range(45)] + [(None, 1, 1), (3, None, None)]
    labels = [(i, q, None if x is None else int(x)) for i, q, x in labels]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = sorted(tuple(r) for r in A.audit(d, lab, shard_bytes=700).select(*COLS).collect())
    assert got == brute(docs, labels)


def test_matrix_holds_the_word_counts(spark):
    docs = odd_docs(6, 60)
    d = spark.createDataFrame([(k, t, p) for k, (_, t, p) in enumerate(docs)], "doc_id long, text string, source string")
    number: dict[int, set] = {}
    for r in A.matrix(d.repartition(4), shard_bytes=900).collect():
        indptr, cols, counts = (np.frombuffer(r[c], t) for c, t in
                                (("indptr", np.int64), ("cols", np.int64), ("counts", np.int32)))
        for k, doc in enumerate(r["ids"]):
            row = Counter(WORDS.findall(docs[doc][1] or ""))
            own = counts[indptr[k]:indptr[k + 1]].tolist()
            assert sorted(own) == sorted(row.values())
            # one number a word over all shards: words of equal count in this row share the set of numbers
            for c in set(own):
                some = {int(n) for n, m in zip(cols[indptr[k]:indptr[k + 1]], own) if m == c}
                for w in (w for w, m in row.items() if m == c):
                    number[w] = number.get(w, some) & some
    assert all(number.values())
    every = {w for _, t, _ in docs for w in WORDS.findall(t or "")}
    made = A.blocks(d, shard_bytes=900)
    ids = [n for r in A.word_numbers(made).collect() for n in np.frombuffer(r["ids"], np.int64).tolist()]
    assert len(set(ids)) == len(every)


def test_empty_tables_and_clashing_names(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert A.audit(none, lab).collect() == []
    docs = [(1, "a b", "s"), (2, "a b", "s")]
    wide = spark.createDataFrame([(*r, 1, "m", 0, True) for r in docs],
                                 "doc_id long, text string, source string, id int, mask string, shard int, good boolean")
    plain = spark.createDataFrame(docs, "doc_id long, text string, source string")
    other = spark.createDataFrame([(1, 1, 0, 5)], "doc_id long, quality int, toxic int, id int")
    one = sorted(tuple(r) for r in A.audit(wide, other).select(*COLS).collect())
    assert one == sorted(tuple(r) for r in A.audit(plain, other).select(*COLS).collect()) == brute(docs, [(1, 1, 0)])


def test_all_texts_empty(spark):
    docs = [(1, None, "s"), (2, "", "s")]
    lab = [(1, 1, 1)]
    got = A.audit(spark.createDataFrame(docs, "doc_id long, text string, source string"),
                  spark.createDataFrame(lab, "doc_id long, quality int, toxic int"))
    assert sorted(tuple(r) for r in got.select(*COLS).collect()) == brute(docs, lab)


def test_columns_ascend_in_every_row(spark):
    """Distinct words are counted without sorting: shards' rows stand in the order of the table-wide numbers."""
    docs = [(k, t, p) for k, (_, t, p) in enumerate(odd_docs(7, 60))] + [(99, "plumless a buckeroo plumless", "s")]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3)
    made = A.matrix(d, shard_bytes=900).collect()
    assert sorted(i for r in made for i in r["ids"]) == sorted(k for k, _, _ in docs)
    for r in made:
        indptr, cols = np.frombuffer(r["indptr"], np.int64), np.frombuffer(r["cols"], np.int64)
        assert all((np.diff(cols[lo:hi]) > 0).all() for lo, hi in zip(indptr[:-1], indptr[1:]))


def test_words_of_odd_bytes_and_their_order():
    rnd = random.Random(8)
    texts = [b"", b" ", b"\n a  b\x0b\x0c\r\tb\x1cc ", b"\xff\xfe \x80", " x  y".encode(), b"plumless buckeroo"]
    texts += [bytes(rnd.choice(b"ab \t\n\x00\x1f\x85\xa0#A") for _ in range(rnd.randint(0, 40))) for _ in range(200)]
    sizes, codes, words = A._words(pa.array(texts, pa.binary()))
    assert [words[c] for c in codes.tolist()] == [w for t in texts for w in t.split()]
    assert sizes.tolist() == [len(t.split()) for t in texts] and len(set(words)) == len(words)
    assert crc32(b"plumless") == crc32(b"buckeroo")  # equal checksums: by their bytes
    assert [words[i] for i in A._order(words)] == sorted(words, key=lambda w: (crc32(w), w))
    assert [a.tolist() if isinstance(a, np.ndarray) else a for a in A._words(pa.array([], pa.binary()))] == [[], [], []]


def test_rows_out_of_order_count_each_column_once():
    indptr, cols, counts = np.array([0, 4, 4, 6, 7]), np.array([5, 1 << 41, 5, 2, 1 << 41, 5, 5]), np.ones(7, np.int32)
    block = {"ids": [1, 2, 3, 4], "parts": list("abcd"), "digests": [b""] * 4, "upper": [True] * 4, "symbols": [False] * 4,
             "indptr": indptr.astype(np.int64).tobytes(), "cols": cols.astype(np.int64).tobytes(), "counts": counts.tobytes()}
    (got,) = A._rows([pa.RecordBatch.from_pylist([block])])
    assert (got["words"].to_pylist(), got["distinct"].to_pylist()) == ([4, 0, 2, 1], [3, 0, 2, 1])
