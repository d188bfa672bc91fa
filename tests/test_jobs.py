"""Command-line jobs end to end on small files in a fresh folder."""

import gzip
import os

from quarry import jobs


def _write(path, lines, gz=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    data = "".join(l + "\n" for l in lines).encode()
    with (gzip.open(path, "wb") if gz else open(path, "wb")) as f:
        f.write(data)


def _read(spark, path):
    return sorted(r.value for r in spark.read.text(path).collect())


def test_wordcount_and_hostpercents(spark, tmp_dir):
    _write(f"{tmp_dir}/in/a.txt", ["a b  a", "http://h/x", "http://h/y", "http://g/"])
    jobs.main(["wordcount", f"{tmp_dir}/in", f"{tmp_dir}/wc"])
    assert _read(spark, f"{tmp_dir}/wc") == ["a\t2", "b\t1", "http://g/\t1", "http://h/x\t1", "http://h/y\t1"]
    jobs.main(["hostpercents", "--as-written", f"{tmp_dir}/in", f"{tmp_dir}/hp"])
    assert _read(spark, f"{tmp_dir}/hp") == ["H:g\t1.0", "H:h\t2.0"]


def test_seo_job(spark, tmp_dir):
    _write(f"{tmp_dir}/clicks/c.gz", ["y\thttp://a/1", "x\thttp://a/2", "y\thttp://a/3", "x\thttp://a/4",
                                      "z\thttp://b/"], gz=True)
    jobs.main(["seo", "--min-clicks", "2", "--as-written", f"{tmp_dir}/clicks", f"{tmp_dir}/seo"])
    assert _read(spark, f"{tmp_dir}/seo") == ["a\tx\t2", "b\t\t1"]


def test_weather_job(spark, tmp_dir):
    fmt = "%06d%8s%04d%02d%02d%80s%6.1f%2s%6.1f%22s"
    lines = [fmt % (10010, "", y, 1, 2, "", t, "", 0.0, "") for y, t in
             [(2001, 21.74), (2002, 33.8), (2003, 33.8), (2004, 9999.9)]]
    _write(f"{tmp_dir}/w/a.txt", lines)
    jobs.main(["weather", f"{tmp_dir}/w", f"{tmp_dir}/hot"])
    assert _read(spark, f"{tmp_dir}/hot") == ["10010:02.01\t1.0C (2002)"]


def test_pagerank_job(spark, tmp_dir):
    _write(f"{tmp_dir}/g/e.txt.gz", ["# comment", "1\t2", "1\t3", "1\t3", "2\t3", "3\t1", "3\t4", "5\t3"], gz=True)
    jobs.main(["pagerank", "--iterations", "3", "--nodes", "5", "--top", "2", "--resplit", "2",
               f"{tmp_dir}/g", f"{tmp_dir}/pr"])
    assert _read(spark, f"{tmp_dir}/pr/top") == ["(0.20864063,1)", "(0.33380313,3)"] or \
        [v[:11] for v in _read(spark, f"{tmp_dir}/pr/top")] == ["(0.20864062", "(0.33380312"]


def test_bulkload_and_table_wordcount(spark, tmp_dir):
    import base64

    enc = lambda t: base64.b64encode(t.encode()).decode()
    _write(f"{tmp_dir}/tsv/a.txt", [f"http://u/1\t{enc('Hello hello World')}", f"http://u/2\t{enc('world')}", "bad"])
    jobs.main(["bulkload", f"{tmp_dir}/tsv", f"{tmp_dir}/table"])
    jobs.main(["tablewordcount", f"{tmp_dir}/table", f"{tmp_dir}/twc"])
    assert _read(spark, f"{tmp_dir}/twc") == ["hello\t2", "world\t2"]


def test_fixstatus_job(spark, tmp_dir):
    from pyspark.sql import functions as F

    from quarry.sinks.files import read_current, write_version

    pages = spark.createDataFrame([("http://h/en/1", None), ("http://h/fr/2", "Y"), ("http://g/x", "Y")],
                                  "url string, disabled string").select(F.md5("url").alias("row_key"), "url", "disabled")
    write_version(pages, f"{tmp_dir}/pages")
    spark.createDataFrame([("http://h/", "Disallow: /en")], "site string, robots string") \
        .write.parquet(f"{tmp_dir}/sites")
    jobs.main(["fixstatus", f"{tmp_dir}/pages", f"{tmp_dir}/sites", f"{tmp_dir}/pages2"])
    got = {r.url: r.disabled for r in read_current(spark, f"{tmp_dir}/pages2").collect()}
    assert got == {"http://h/en/1": "Y", "http://h/fr/2": None, "http://g/x": None}
    ops = {r.url: r.op for r in spark.read.parquet(f"{tmp_dir}/pages2/_changes").collect()}
    assert ops == {"http://h/en/1": "put", "http://h/fr/2": "delete", "http://g/x": "delete"}


def test_docfreq_docs2tsv_records_jobs(spark, tmp_dir):
    from quarry.sinks.files import write_docstream, write_fixed_records, write_indexed_chunks

    texts = spark.createDataFrame([("Aa bb aa",), ("bb",)], "text string")
    write_indexed_chunks(texts, "text", f"{tmp_dir}/arch")
    jobs.main(["docfreq", f"{tmp_dir}/arch", f"{tmp_dir}/df"])
    assert _read(spark, f"{tmp_dir}/df") == ["aa\t1", "bb\t2"]
    docs = spark.createDataFrame([("http://a/", None, "hé"), ("http://b/", "x", None)], "url string, body string, text string")
    write_docstream(docs, f"{tmp_dir}/ds", compress=True)
    jobs.main(["docs2tsv", f"{tmp_dir}/ds", f"{tmp_dir}/tsv"])
    assert _read(spark, f"{tmp_dir}/tsv") == ["http://a/\taMOp"]
    recs = spark.createDataFrame([(bytearray(b"abcd"),), (bytearray(b"wxyz"),)], "r binary")
    write_fixed_records(recs, "r", f"{tmp_dir}/recs", 4)
    jobs.main(["records2base64", "--record-bytes", "4", f"{tmp_dir}/recs", f"{tmp_dir}/b64"])
    assert _read(spark, f"{tmp_dir}/b64") == ["YWJjZA==", "d3h5eg=="]


def test_tableput_dedupes_and_upserts(spark, tmp_dir):
    import base64

    from quarry.sinks.files import read_current

    enc = lambda t: base64.b64encode(t.encode()).decode()
    _write(f"{tmp_dir}/t1/a.txt", [f"http://u/1\t{enc('one')}", f"http://u/2\t{enc('two')}"])
    jobs.main(["bulkload", f"{tmp_dir}/t1", f"{tmp_dir}/table"])
    _write(f"{tmp_dir}/t2/a.txt", [f"http://u/2\t{enc('zwei')}", f"http://u/2\t{enc('deux')}", f"http://u/3\t{enc('drei')}"])
    jobs.main(["tableput", f"{tmp_dir}/t2", f"{tmp_dir}/table"])
    got = {r.row_key: (r.text, r.size) for r in read_current(spark, f"{tmp_dir}/table").collect()}
    assert got == {"http://u/1": ("one", 3), "http://u/2": ("deux", 4), "http://u/3": ("drei", 4)}
