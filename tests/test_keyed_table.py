"""Keyed tables: changes rewrite touched files only, reads of keys open the files that hold them."""

import os

import pytest
from pyspark.sql import functions as F

from quarry.operators import keyed as K
from quarry.sinks import keyed_table as T


def loaded(spark, path, n=1000, parts=8):
    df = spark.createDataFrame([(f"k{2 * i:05d}", f"u{i}", None if i % 3 else "x") for i in range(n)],
                               "row_key string, url string, c string")
    T.write_version(df, path, partitions=parts)
    return {r.row_key: (r.url, r.c) for r in df.collect()}


def held(spark, path):
    return {r.row_key: (r.url, r.c) for r in T.read_current(spark, path).collect()}


def files(spark, path):
    return {r.file: (r.least, r.greatest, r.rows) for r in T.manifest(spark, path).collect()}


def cells(rows, changes):
    return K.merge_cells(rows, changes, "c")


def disjoint(spark, path):
    own = sorted(files(spark, path).values())
    assert all(a[1] < b[0] for a, b in zip(own, own[1:]))
    return len(own)


def test_an_upsert_of_one_key_rewrites_one_file(spark, tmp_dir):
    path = tmp_dir + "/t"
    want = loaded(spark, path)
    before = files(spark, path)
    assert len(before) >= 6
    put = spark.createDataFrame([("k00100", "put", "new")], "row_key string, op string, value string")
    done = T.change_version(spark, path, put, cells)
    after = files(spark, path)
    assert (done["rewritten"], done["kept"]) == (1, len(before) - 1)
    assert len(set(before) & set(after)) == len(before) - 1  # taken over by name
    assert len(os.listdir(f"{path}/{done['version']}")) <= 4  # one data file, its checksum and the job's marker
    want["k00100"] = (want["k00100"][0], "new")
    assert held(spark, path) == want and disjoint(spark, path) == len(before)


def test_puts_at_all_places_and_deletes(spark, tmp_dir):
    path = tmp_dir + "/t"
    want = loaded(spark, path)
    rows = [("a", "put", "first"), ("z", "put", "last"), ("k00101", "put", "between"), ("k00006", "delete", None),
            ("k00107", "delete", None), ("k01998", "put", "end")]
    ch = spark.createDataFrame(rows, "row_key string, op string, value string")
    T.change_version(spark, path, ch, cells)
    want |= {"a": (None, "first"), "z": (None, "last"), "k00101": (None, "between")}
    want["k00006"] = (want["k00006"][0], None)
    want["k01998"] = (want["k01998"][0], "end")
    assert held(spark, path) == want
    disjoint(spark, path)
    more = spark.createDataFrame([("k00101", "u!"), ("k00999", "v!")], "row_key string, url string")
    done = T.change_version(spark, path, more, K.upsert_rows)
    want |= {"k00101": ("u!", "between"), "k00999": ("v!", None)}
    assert held(spark, path) == want and done["rewritten"] == 2


def test_a_grown_file_is_split(spark, tmp_dir):
    path = tmp_dir + "/t"
    loaded(spark, path, 80, 4)
    n = len(files(spark, path))
    rows = spark.range(500).select(F.format_string("k00010-%04d", "id").alias("row_key"), F.lit("n").alias("url"))
    T.change_version(spark, path, rows, K.upsert_rows)
    assert T.read_current(spark, path).count() == 580
    assert disjoint(spark, path) > n + 5


def test_a_key_read_opens_one_file(spark, tmp_dir):
    path = tmp_dir + "/t"
    want = loaded(spark, path)
    one = T.point_lookup(spark, path, "k00500")
    assert [(r.url, r.c) for r in one.collect()] == [want["k00500"]] and len(one.inputFiles()) == 1
    assert T.point_lookup(spark, path, "k00501").collect() == [] and T.point_lookup(spark, path, "zz").collect() == []
    some = T.key_range(spark, path, "k00100", "k00120")
    assert sorted(r.row_key for r in some.collect()) == [f"k{k:05d}" for k in range(100, 121, 2)]
    assert len(some.inputFiles()) <= 2 < len(files(spark, path))
    # the key's column chunks have bloom filters
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(one.inputFiles()[0]), conf)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    chunks = {c.getPath().toDotString(): c.getBloomFilterOffset() for c in reader.getFooter().getBlocks()[0].getColumns()}
    reader.close()
    assert chunks["row_key"] > 0 > chunks["url"]


def test_failed_and_rival_changes_leave_the_version(spark, tmp_dir):
    path = tmp_dir + "/t"
    want = loaded(spark, path, 100, 4)
    version = T.current_version(path)
    put = spark.createDataFrame([("k00010", "put", "y")], "row_key string, op string, value string")

    def fails(rows, changes):
        return cells(rows, changes).withColumn("c", F.raise_error(F.lit("no")).cast("string"))

    with pytest.raises(Exception):
        T.change_version(spark, path, put, fails)
    assert T.current_version(path) == version and held(spark, path) == want

    def rival(rows, changes):
        T.write_version(T.read_current(spark, path), path)
        return cells(rows, changes)

    with pytest.raises(RuntimeError, match="was replaced"):
        T.change_version(spark, path, put, rival)
    assert held(spark, path) == want


def test_empty_tables_and_changes(spark, tmp_dir):
    path = tmp_dir + "/t"
    none = spark.createDataFrame([], "row_key string, url string, c string")
    T.write_version(none, path)
    assert held(spark, path) == {} and T.point_lookup(spark, path, "a").collect() == []
    put = spark.createDataFrame([("a", "put", "y")], "row_key string, op string, value string")
    T.change_version(spark, path, put, cells)
    assert held(spark, path) == {"a": (None, "y")}
    version = T.current_version(path)
    assert T.change_version(spark, path, put.limit(0), cells)["rewritten"] == 0 and T.current_version(path) == version


def test_keys_of_other_types(spark, tmp_dir):
    for k, (kind, make) in enumerate((("long", lambda i: i - 50), ("binary", lambda i: bytes([i, 255 - i])))):
        path = f"{tmp_dir}/{k}"
        df = spark.createDataFrame([(make(i), i) for i in range(200)], f"row_key {kind}, v int")
        T.write_version(df, path, partitions=5)
        T.change_version(spark, path, spark.createDataFrame([(make(77), -1)], df.schema), K.upsert_rows)
        assert T.point_lookup(spark, path, make(77)).first().v == -1
        assert T.read_current(spark, path).count() == 200 and disjoint(spark, path)
