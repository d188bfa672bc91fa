"""The pipeline's stages against the operators' own brute forces, each on its predecessor's rows."""

import hashlib

import public_tokenizers as P
import pytest
import tiktoken

import __spark_entry__ as E
import corpus_pipeline as C
from quarry.llm import bpe, decontam, pii, simhash, toxicity
from quarry.llm.common import staged

from ..conftest import SF001
from .test_decontam import brute as brute_items
from .test_pii import brute as brute_spans
from .test_simhash import brute_fingerprint, brute_groups


@pytest.fixture(scope="module")
def stages(spark):
    docs = [spark.read.parquet(f"{SF001}/documents.parquet")]
    for _, stage in C.STAGES:
        docs.append(staged(stage(spark, docs[-1], SF001), "test"))
    return [{r.doc_id: r for r in d.collect()} for d in docs], docs


def test_columns_and_names(stages):
    _, frames = stages
    assert [n for n, _ in C.STAGES] == ["toxicity", "simhash near-dedup", "benchmark decontamination", "pii redaction",
                                        "byte-level bpe"]
    assert all(f.columns == frames[0].columns for f in frames[:5])


def test_toxicity_stage(spark, stages):
    rows, frames = stages
    model = toxicity.train(frames[0], spark.read.parquet(f"{SF001}/labels.parquet"))
    ex = toxicity.Extractor(model.columns)
    keep = {i for i, r in rows[0].items() if model.above(ex.counts(r.text)[0])[0] < toxicity.REJECT_AT}
    assert set(rows[1]) == keep and len(keep) < len(rows[0])


def test_near_duplicate_stage(stages):
    rows, _ = stages
    low = brute_groups(list(rows[1]), [brute_fingerprint(r.text, simhash.SHINGLE_WORDS) for r in rows[1].values()], simhash.MAX_BITS)
    assert set(rows[2]) == {i for i, g in low.items() if i == g} and len(rows[2]) < len(rows[1])


def test_benchmark_stage(spark, stages):
    rows, _ = stages
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    held = {i for i, _ in brute_items([(i, r.text) for i, r in rows[2].items()], items)}
    assert set(rows[3]) == set(rows[2]) - held
    assert decontam.SHINGLE_WORDS == 5 and decontam.MIN_SIMILARITY == 0.8


def test_redaction_stage(stages):
    rows, _ = stages
    assert set(rows[4]) == set(rows[3])
    changed = 0
    for i, r in rows[4].items():
        old = rows[3][i].text
        assert not any(brute_spans(r.text).values())
        if any(brute_spans(old).values()):
            changed += 1
            assert r.text != old and r.n_chars == len(r.text)
    assert changed and pii.KINDS


def test_token_stage_and_run(spark, stages):
    rows, _ = stages
    ranks = bpe.read_ranks(P.path(bpe.RANK_FILE))
    oracle = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert set(rows[5]) == set(rows[4])
    for i, r in rows[5].items():
        assert r.ids == oracle.encode_ordinary(rows[4][i].text) and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(rows[4][i].text.encode()).hexdigest()
    got = E.queries()["pipeline"](spark, SF001)
    assert {r.doc_id: r.ids_sha256 for r in got.collect()} == {i: r.ids_sha256 for i, r in rows[5].items()}


def test_a_task_of_the_token_stage_holds_one_python_worker(stages, spark):
    _, frames = stages
    out = C.tokens(spark, frames[4], SF001)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and out.columns == frames[5].columns


def test_workers_give_freed_memory_back():
    import numpy as np
    import pyarrow as pa

    from quarry.llm.common import giving_back

    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096 / 1e6

    held = []

    def each():
        for i in range(3):
            some = [np.ones(256) for _ in range(60_000)]  # 120 MB, too small a piece each to be mapped alone
            held.append(some[-1])  # stays: the heap can't shrink from its end
            del some
            yield pa.record_batch({"i": pa.array([i])})

    before, seen = resident(), []
    for batch in giving_back(each()):
        seen.append(batch.column(0)[0].as_py())
    assert seen == [0, 1, 2] and resident() - before < 60


def test_every_dealt_operator_is_registered():
    names = set(E.queries())
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        docs = staged(stage(spark, docs, SF001), "test")
        assert docs.count() == 0
