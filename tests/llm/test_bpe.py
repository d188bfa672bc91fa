"""op2: ids and bytes against the tiktoken library."""

import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from quarry.llm import bpe as B

from ..conftest import SF001

PATH = P.path(B.RANK_FILE)


@pytest.fixture(scope="module")
def ranks():
    return B.read_ranks(PATH)


@pytest.fixture(scope="module")
def oracle(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_query_matches_tiktoken(spark, oracle):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    got = B.op2_bpe(spark, SF001).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = oracle.encode_ordinary(texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), sha(",".join(map(str, ids)).encode()), sha((texts[r.doc_id] or "").encode()))


def test_odd_texts_round_trip(spark, oracle):
    random.seed(2)
    pool = [chr(c) for c in [*range(1, 256), 0x2028, 0x3000, 0x200B, 0x1F600, 0x4E2D, 0x660, 0x301, 0x85]]
    data = [(i, "".join(random.choice(pool) for _ in range(random.randint(0, 40)))) for i in range(300)]
    data += [(900, None), (901, ""), (902, "a" * 30_000), (903, " " * 4000 + "x"), (904, "中" * 2000), (905, "dup"), (905, "dup")]
    df = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 as _c0", "'x' as decoded")
    got = B.decode(B.encode(df, PATH, P.PATTERN), PATH).collect()
    assert len(got) == len(data)
    texts = dict(data)
    for r in got:
        t = texts[r.doc_id] or ""
        assert r.ids == oracle.encode_ordinary(t) and bytes(r.decoded) == t.encode()


def test_both_folds_agree(ranks):
    random.seed(4)
    merges = B.Merges(ranks)
    for _ in range(300):
        word = bytes(random.choice(b"abcdeth inou\xc3\xa9\xa8") for _ in range(random.randint(1, 90)))
        assert B.fold(word, merges) == B.fold_long(word, ranks)


def test_sql_fold_of_distinct_words(spark, ranks, oracle):
    words = ["the", " thing", "thionbletion", "é", " çouelle", "\n\n", "a", "中文", "xyzzyq", " the", "", None]
    got = {r.word: r.ids for r in B.word_ids(spark.createDataFrame([(w,) for w in words], "word string"), ranks).collect()}
    assert got == {w: oracle.encode_ordinary(w) for w in words if w}


def test_empty_table_and_null_ids(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert B.decode(B.encode(df, PATH, P.PATTERN), PATH).collect() == []
    ids = spark.createDataFrame([(1, None), (2, []), (3, [262])], "doc_id long, ids array<int>")
    got = {r.doc_id: bytes(r.decoded) for r in B.decode(ids, PATH).collect()}
    assert got[1] == got[2] == b"" and got[3]
