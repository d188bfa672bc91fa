"""Binary layouts: two-phase writes, ranges of streams, filters that choose what is read."""

import os

import pytest
from pyspark.sql import functions as F

from quarry.sinks import files as S
from quarry.sources import docstream as D
from quarry.sources import indexed_chunks as C
from quarry.sources.fixed_records import RecordRange, plan_ranges, read_fixed_records
from quarry.sources.indexed_chunks import read_indexed_chunks
from quarry.sources.selection import Selection, options


def records(spark, ids, parts):
    return spark.createDataFrame([(bytearray(i.to_bytes(4, "big")),) for i in ids], "r binary").repartition(parts)


def numbers(df):
    return sorted(int.from_bytes(r.record, "big") for r in df.select("record").collect())


def test_failed_writes_leave_the_old_files(spark, tmp_dir):
    out = tmp_dir + "/o"
    S.write_fixed_records(records(spark, range(40), 4), "r", out, 4)
    before = {f: open(f"{out}/{f}", "rb").read() for f in os.listdir(out) if f.startswith("part-")}
    bad = records(spark, range(100, 140), 4).unionByName(spark.createDataFrame([(bytearray(b"toolong"),)], "r binary"))
    with pytest.raises(Exception, match="expected 4"):
        S.write_fixed_records(bad, "r", out, 4)
    left = {f: open(f"{out}/{f}", "rb").read() for f in os.listdir(out) if not f.startswith("_")}
    assert left == before and numbers(read_fixed_records(spark, out, 4)) == list(range(40))
    texts = spark.createDataFrame([(i, f"text {i}") for i in range(30)], "i int, text string").repartition(3)
    S.write_indexed_chunks(texts, "text", tmp_dir + "/z")
    broken = texts.select(F.when(F.col("i") == 29, F.raise_error(F.lit("no"))).otherwise(F.col("text")).alias("text"))
    with pytest.raises(Exception):
        S.write_indexed_chunks(broken, "text", tmp_dir + "/z")
    assert sorted(r.text for r in read_indexed_chunks(spark, tmp_dir + "/z").collect()) == sorted(f"text {i}" for i in range(30))
    S.write_indexed_chunks(texts.limit(2), "text", tmp_dir + "/z")
    assert read_indexed_chunks(spark, tmp_dir + "/z").count() == 2
    assert not [f for f in os.listdir(tmp_dir + "/z") if f.startswith("_attempt")]


def test_smaller_rewrites_and_added_files(spark, tmp_dir):
    out = tmp_dir + "/o"
    assert S.write_fixed_records(records(spark, range(40), 5), "r", out, 4) == {"rows": 40, "bytes": 160, "files": 5}
    S.write_fixed_records(records(spark, range(7), 1), "r", out, 4)
    assert numbers(read_fixed_records(spark, out, 4)) == list(range(7))
    S.write_fixed_records(records(spark, range(50, 55), 2), "r", out, 4, mode="append")
    assert numbers(read_fixed_records(spark, out, 4)) == [*range(7), *range(50, 55)]
    S.write_fixed_records(records(spark, [], 1), "r", out, 4)
    assert numbers(read_fixed_records(spark, out, 4)) == []
    docs = spark.createDataFrame([(f"u{i}", "t" * i) for i in range(20)], "url string, text string").repartition(2)
    S.write_docstream(docs, tmp_dir + "/d", body_col=None)
    S.write_docstream(docs.filter("url = 'u3'").coalesce(1), tmp_dir + "/d", body_col=None)
    assert [(r.url, r.text) for r in D.read_docstream(spark, tmp_dir + "/d").collect()] == [("u3", "ttt")]


def test_chosen_records_alone_are_planned(spark, tmp_dir):
    out = tmp_dir + "/o"
    S.write_fixed_records(records(spark, range(100), 2), "r", out, 4)
    df = read_fixed_records(spark, out, 4, split_bytes=40)
    rows = {(r.path, r.record_no): bytes(r.record) for r in df.collect()}
    path = min(p for p, _ in rows)
    for chosen, keep in (
            ({"records": [7]}, lambda p, n: n == 7), ({"records": range(4, 13)}, lambda p, n: 4 <= n < 13),
            ({"records": [30, 1, 2, 999]}, lambda p, n: n in (1, 2, 30)), ({"paths": path}, lambda p, n: p == path),
            ({"paths": [path, "x"], "records": range(20, 99)}, lambda p, n: p == path and n >= 20), ({"records": []}, lambda p, n: False)):
        some = read_fixed_records(spark, out, 4, split_bytes=40, **chosen)
        assert {(r.path, r.record_no): bytes(r.record) for r in some.collect()} == {k: v for k, v in rows.items() if keep(*k)}
    wanted = Selection(options(None, [50, 8, 7]))
    assert plan_ranges([("f", 400)], 4, 40, wanted) == [RecordRange("f", 7, 2, 4), RecordRange("f", 50, 1, 4)]
    assert read_fixed_records(spark, out, 4, paths=path, records=[7]).rdd.getNumPartitions() == 1
    # scans of one frame don't share what they look for
    a, b = df.filter("record_no = 3"), df.filter("record_no = 5")
    assert sorted(r.record_no for r in a.union(b).collect()) == [3, 3, 5, 5] and df.count() == 100


def test_one_chunk_is_read_alone(spark, tmp_dir, monkeypatch):
    texts = spark.createDataFrame([(os.urandom(300).hex() + str(i),) for i in range(200)], "text string").coalesce(1)
    S.write_indexed_chunks(texts, "text", tmp_dir + "/z")
    every = {r.chunk_no: r.text for r in read_indexed_chunks(spark, tmp_dir + "/z", bytes_per_split=8 * 1024).collect()}
    some = lambda **kw: {r.chunk_no: r.text for r in read_indexed_chunks(spark, tmp_dir + "/z", 8 * 1024, **kw).collect()}
    assert some(chunks=[17]) == {17: every[17]} and some(chunks=[17], paths="other") == {}
    assert some(chunks=range(20, 41)) == {k: every[k] for k in range(20, 41)}
    # counted in the reader itself: bytes of the archive that one chunk costs
    import quarry.sources.fsutil as U

    real, read = U.resolve, []

    class Counted:
        def __init__(self, fs):
            self.open_input_stream, self.file = fs.open_input_stream, fs.open_input_file

        def open_input_file(self, p):
            class File:
                def __enter__(self):
                    return self

                def __exit__(self, *a):
                    own.close()

                def seek(self, n):
                    own.seek(n)

                def read(self, n):
                    out = own.read(n)
                    read.append(len(out))
                    return out

            own = self.file(p)
            return File()

    archives = [(f"{tmp_dir}/z/{f}", os.path.getsize(f"{tmp_dir}/z/{f}")) for f in sorted(os.listdir(tmp_dir + "/z")) if f.endswith(".z")]
    monkeypatch.setattr(U, "resolve", lambda p: (lambda fs, q: (Counted(fs), q))(*real(p)))
    reader = C._Reader({"path": tmp_dir + "/z", "bytes_per_split": "8192", **options(None, [17])})
    got = [r for p in C.plan_ranges(archives, 8192) for b in reader.read(p) for r in b.to_pylist()]
    assert [r["chunk_no"] for r in got] == [17] and len(read) == 1 and read[0] < 1000


def test_small_archives_share_a_partition():
    parts = C.plan_ranges([("a", 10), ("b", 250), ("c", 0), ("d", 30)], 100)
    assert [p.parts for p in parts] == [[("a", 0, None)], [("b", 0, 100)], [("b", 100, 200)],
                                        [("b", 200, None), ("c", 0, None), ("d", 0, None)]]


def test_a_plain_stream_is_read_by_several_tasks(spark, tmp_dir):
    docs = spark.range(3000).select(F.concat(F.lit("u"), "id").alias("url"), F.lit(None).cast("string").alias("body"),
                                    F.repeat(F.lit("xyz "), (F.col("id") % 1000).cast("int")).alias("text"))
    S.write_docstream(docs.coalesce(1), tmp_dir + "/d")
    (stream,) = [f for f in os.listdir(tmp_dir + "/d") if f.endswith(".pb")]
    want = sorted((r.url, r.text) for r in docs.collect())
    size = os.path.getsize(f"{tmp_dir}/d/{stream}")
    for path in (tmp_dir + "/d", f"{tmp_dir}/d/{stream}"):
        df = D.read_docstream(spark, path, range_bytes=1 << 20)
        ranges = sorted(tuple(r) for r in D.stream_ranges(spark, path, 1 << 20).collect())
        assert len(ranges) == df.rdd.getNumPartitions() >= 3 and [r[3] for r in ranges] == list(range(len(ranges)))
        assert sorted((r.url, r.text) for r in df.collect()) == want
        assert df.groupBy(F.spark_partition_id()).count().count() == len(ranges)
    # without the index the length prefixes are walked; messages longer than what is read at a time are passed
    os.rename(f"{tmp_dir}/d/{stream}.starts", f"{tmp_dir}/starts")
    D.WALK_BYTES, old = 100, D.WALK_BYTES
    try:
        walked = D._starts(f"{tmp_dir}/d/{stream}", size, False, 1 << 16)
    finally:
        D.WALK_BYTES = old
    assert len(walked) >= 10 and walked == D._starts(f"{tmp_dir}/d/{stream}", size, False, 1 << 16)
    df = D.read_docstream(spark, tmp_dir + "/d", range_bytes=1 << 16)
    assert df.rdd.getNumPartitions() == len(walked) and sorted((r.url, r.text) for r in df.collect()) == want
    assert spark.read.format("quarry_docstream").option("path", tmp_dir + "/d").load().count() == 3000
    with open(f"{tmp_dir}/cut.pb", "wb") as f:
        f.write(open(f"{tmp_dir}/d/{stream}", "rb").read()[:-3])
    with pytest.raises(Exception, match="ends"):
        D.read_docstream(spark, f"{tmp_dir}/cut.pb", range_bytes=1 << 16).collect()


def test_empty_streams_and_folders(spark, tmp_dir):
    os.makedirs(tmp_dir + "/e")
    assert D.read_docstream(spark, tmp_dir + "/e").collect() == []
    open(tmp_dir + "/e/x.pb", "wb").close()
    assert D.read_docstream(spark, tmp_dir + "/e").collect() == []
    assert read_indexed_chunks(spark, tmp_dir + "/e").collect() == []
