"""Readers and sinks: round trips in a fresh temp folder, and the D13/D15/D18 decisions."""

import gzip
import os
import struct
import zlib

import numpy as np
from pyspark.sql import functions as F

from quarry.sinks import files as S
from quarry.sources import text as TS
from quarry.sources.docstream import decode_document, encode_document, read_docstream
from quarry.sources.fixed_records import plan_ranges, read_fixed_records
from quarry.sources.indexed_chunks import chunk_errors, read_indexed_chunks
from quarry.streaming.pipes import pipe_map_reduce


def test_fixed_records_ranges_and_partial_tail(spark, tmp_dir):
    path = os.path.join(tmp_dir, "r.bin")
    with open(path, "wb") as f:
        for i in range(10):
            f.write(bytes([i]) * 16)
        f.write(b"xx")  # trailing partial record is dropped
    assert [(r.first, r.count) for r in plan_ranges([(path, 162)], 16, 50)] == [(0, 3), (3, 3), (6, 3), (9, 1)]
    df = read_fixed_records(spark, tmp_dir, record_bytes=16, split_bytes=50)
    assert df.rdd.getNumPartitions() == 4
    rows = sorted((r.record_no, bytes(r.record)) for r in df.collect())
    assert rows == [(i, bytes([i]) * 16) for i in range(10)]
    b64 = df.select(S.base64_lines("record").alias("l")).first().l
    assert "\n" not in b64


def test_indexed_chunks_with_bad_chunk(spark, tmp_dir):
    texts = ["первый chunk", "second", "third"]
    chunks = [zlib.compress(t.encode()) for t in texts]
    chunks.insert(1, b"not zlib at all")
    with open(os.path.join(tmp_dir, "a"), "wb") as f:
        f.write(b"".join(chunks))
    with open(os.path.join(tmp_dir, "a.idx"), "wb") as f:
        f.write(np.asarray([len(c) for c in chunks], "<i4").tobytes())
    df = read_indexed_chunks(spark, tmp_dir, bytes_per_split=20)
    rows = sorted((r.chunk_no, r.offset, r.text, r.error is not None) for r in df.collect())
    offs = np.concatenate([[0], np.cumsum([len(c) for c in chunks])[:-1]]).tolist()
    assert [r[0] for r in rows] == [0, 1, 2, 3]
    assert [r[1] for r in rows] == offs                       # start offsets (D14)
    assert [r[2] for r in rows] == [texts[0], None, texts[1], texts[2]]
    assert [r[3] for r in rows] == [False, True, False, False]  # bad chunk reported, scan goes on (D13)
    c = chunk_errors(df).first()
    assert (c.chunks, c.bad_chunks) == (4, 1)


def test_indexed_chunks_writer_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([(f"doc {i} ü",) for i in range(50)], "text string").repartition(3)
    res = S.write_indexed_chunks(df, "text", tmp_dir)
    assert res["rows"] == 50 and res["files"] == 3  # one task result per partition
    back = read_indexed_chunks(spark, tmp_dir, bytes_per_split=64)
    assert sorted(r.text for r in back.collect()) == sorted(f"doc {i} ü" for i in range(50))


def test_docstream_codec_and_reader(spark, tmp_dir):
    msg = encode_document("http://x/", None, "tëxt")
    (n,) = struct.unpack("=i", msg[:4])
    assert decode_document(msg[4:4 + n]) == ("http://x/", None, "tëxt")
    with gzip.open(os.path.join(tmp_dir, "d.pb.gz"), "wb") as f:
        f.write(msg + encode_document("http://y/", "b", None))
    with open(os.path.join(tmp_dir, "e.pb"), "wb") as f:
        f.write(encode_document("http://z/", "", "t"))
    rows = sorted(tuple(r) for r in read_docstream(spark, tmp_dir).collect())
    assert rows == [("http://x/", None, "tëxt"), ("http://y/", "b", None), ("http://z/", "", "t")]


def test_kv_and_url_base64_lines(spark):
    lines = spark.createDataFrame([("q\thttp://a/",), ("noval",), ("a\tb\tc",)], "value string")
    assert [tuple(r) for r in TS.split_kv(lines, "k", "v").collect()] == [("q", "http://a/"), ("noval", ""), ("a", "b\tc")]
    b = spark.createDataFrame([("http://u/\tw69sbw==",), ("bad",), ("a\tb\tc",)], "value string")
    assert [tuple(r) for r in TS.parse_url_base64(b).collect()] == [("http://u/", "ïlo")]
    c = TS.bad_url_base64_lines(b).first()
    assert (c.lines, c.bad_lines) == (3, 2)


def test_rank_state_and_stations(spark, tmp_dir):
    lines = spark.createDataFrame([("1,0.25\t2,3",), ("4,0.5\t",)], "value string")
    got = [tuple(r) for r in TS.parse_rank_state(lines).collect()]
    assert got == [(1, 0.25, [2, 3]), (4, 0.5, [])]
    p = os.path.join(tmp_dir, "isd.csv")
    with open(p, "w") as f:
        f.write('"USAF","WBAN","STATION NAME","CTRY","STATE","ICAO","LAT","LON","ELEV(M)","BEGIN","END"\n')
        f.write('"010010","99999","JAN MAYEN","NO","","ENJA","+70.933","-008.667","+0009.0","19310101","20140403"\n')
        f.write('"010015","99999","BRINGELAND","NO","","ENBL","","","","19870117","20081231"\n')
    st = TS.read_stations(spark, p)
    assert [tuple(r)[:4] for r in st.orderBy("ord").collect()] == [("010010", "+70.933", "-008.667", "JAN MAYEN"), ("010015", "", "", "BRINGELAND")]


def test_weather_lines_bad_rows_dropped(spark):
    good = "%06d%8s%04d%02d%02d%80s%6.1f%2s%6.1f%22s" % (10010, "", 2001, 1, 2, "", 21.6, "", 17.1, "")
    lines = spark.createDataFrame([(good,), ("STN--- WBAN   YEARMODA    TEMP",), ("short",)], "value string")
    rows = TS.parse_weather_lines(lines).collect()
    assert len(rows) == 1 and rows[0].station == 10010 and abs(rows[0].max_c - (-5.7777)) < 1e-3


def test_versioned_table(spark, tmp_dir):
    df = spark.createDataFrame([(f"k{i:03d}", i) for i in range(100)], "row_key string, v int")
    S.write_version(df, tmp_dir + "/t", partitions=4)
    back = S.read_current(spark, tmp_dir + "/t")
    assert back.count() == 100
    S.write_version(df.filter("v < 10"), tmp_dir + "/t")
    assert S.read_current(spark, tmp_dir + "/t").count() == 10


def test_pipe_word_count(spark):
    df = spark.createDataFrame([("a b a",), ("b c",)], "value string").repartition(2)
    mapper = "python3 -c \"import sys\nfor l in sys.stdin:\n  [print(w + chr(9) + '1') for w in l.split()]\""
    reducer = ("python3 -c \"import sys, collections\nc = collections.Counter()\n"
               "for l in sys.stdin:\n  k, v = l.rstrip(chr(10)).split(chr(9))\n  c[k] += int(v)\n"
               "[print(k + chr(9) + str(v)) for k, v in c.items()]\"")
    got = {r.key: int(r.value) for r in pipe_map_reduce(df, mapper, reducer).collect()}
    assert got == {"a": 2, "b": 2, "c": 1}


def test_tsv_and_sorted_sinks(spark, tmp_dir):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("c", 3)], "k string, n int")
    S.write_tsv(df, tmp_dir + "/tsv")
    assert sorted(r.value for r in spark.read.text(tmp_dir + "/tsv").collect()) == ["a\t1", "b\t2", "c\t3"]
    S.write_sorted(df, tmp_dir + "/sorted", "k", partitions=2)
    assert [r.k for r in spark.read.parquet(tmp_dir + "/sorted").orderBy(F.input_file_name()).collect()] == ["a", "b", "c"]
    S.write_scalar(spark, 0.125, tmp_dir + "/scalar")
    assert S.read_scalar(spark, tmp_dir + "/scalar") == 0.125
