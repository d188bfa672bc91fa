"""Batch jobs on files, one per job of the reference: ``python -m quarry <job> ...``.

Each job reads its input layout, runs the operator and writes the output
format the reference writes (TSV lines, ordered parts, keyed-table versions).
Submit on a cluster with ``spark-submit --py-files quarry.zip -m quarry ...``
or call the functions from a driver program.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quarry.session import checkpoint_dir, clear_scratch, ensure_importable, get_session, scale_conf


def _session(input_bytes: int | None = None, executors: int | None = None, cores: int | None = None) -> SparkSession:
    """The job's session; with the input's size and the cluster's, its settings are sized for them."""
    extra = scale_conf(input_bytes, executors, cores or 1) if input_bytes and executors else None
    spark = get_session(extra=extra)
    ensure_importable(spark)
    checkpoint_dir(spark)
    return spark


def _counting(df, job, **counters):
    """``df`` with named counters (A18), and a call that reports them on stderr after the job's write."""
    from quarry.operators.quality import observed

    counted, obs = observed(df, job, **counters)

    def report():
        print(f"{job}: {json.dumps(obs.get)}", file=sys.stderr)

    return counted, report


def wordcount(spark, inp, out, java_split=False):
    """A1/A2: text lines -> ``word<TAB>count``."""
    from quarry.operators.text import word_count, word_count_ws
    from quarry.sinks.files import write_tsv

    lines = spark.read.text(inp).withColumnRenamed("value", "text")
    res = word_count_ws(lines) if java_split else word_count(lines)
    write_tsv(res, out, "word", "cnt")


def docfreq(spark, inp, out, bytes_per_split=None, partitions=None):
    """A3 over S5 archives -> ``term<TAB>documents``, ordered by term across part files."""
    from quarry.operators.text import doc_frequency
    from quarry.sources.indexed_chunks import DEFAULT_BYTES_PER_SPLIT, read_indexed_chunks

    chunks = read_indexed_chunks(spark, inp, bytes_per_split or DEFAULT_BYTES_PER_SPLIT)
    res = doc_frequency(chunks.filter(F.col("error").isNull()))
    d = res.repartitionByRange(partitions, "term") if partitions else res.repartitionByRange("term")
    d.sortWithinPartitions("term").select(F.concat_ws("\t", "term", "doc_count").alias("value")) \
        .write.mode("overwrite").text(out)


def hostpercents(spark, inp, out, as_written=False):
    """URL lines -> ``host<TAB>percent`` (or ``H:host<TAB>count`` as written)."""
    from quarry.operators.hosts import host_counts_tagged, host_percent
    from quarry.sinks.files import write_tsv

    from quarry.functions.url import strict_host

    urls, report = _counting(spark.read.text(inp).withColumnRenamed("value", "url"), "hostpercents", Urls=F.count(F.lit(1)),
                             MalformedUrls=F.count_if(strict_host("url").isNull()))
    if as_written:
        write_tsv(host_counts_tagged(urls), out, "key", "value")
    else:
        write_tsv(host_percent(urls), out, "host", "percent")
    report()


def seo(spark, inp, out, min_clicks=0, as_written=False):
    """A9 + O4: ``query<TAB>url`` lines -> ``host<TAB>query<TAB>clicks``, ordered by host."""
    from quarry.operators.hosts import range_sorted_by_host, top_query_per_host
    from quarry.sources.text import read_kv

    clicks = read_kv(spark, inp, "query", "url")
    best = top_query_per_host(clicks, min_clicks=min_clicks, emit_below_threshold=as_written)
    range_sorted_by_host(best).select(F.concat_ws("\t", "host", "query", "clicks").alias("value")) \
        .write.mode("overwrite").text(out)


def weather(spark, inp, out, stations=None, day=None):
    """A8 (+ J1/K9 with a station CSV, + P12 with ``--day dd.MM``) over fixed-width lines."""
    from quarry.operators.weather import hottest_year, station_labels
    from quarry.sources.text import parse_weather_lines, read_stations

    from quarry.functions.weather import has_temp, parse_gsod

    date = [c.isNull() for c in parse_gsod("value")[:4]]
    lines, report = _counting(spark.read.text(inp), "weather", Lines=F.count(F.lit(1)),
                              RejectedLines=F.count_if(date[0] | date[1] | date[2] | date[3]),
                              SkippedValues=F.count_if(~has_temp(parse_gsod("value")[4])))
    hot = hottest_year(parse_weather_lines(lines), tenths=True)
    if day:
        d, m = (int(x) for x in day.split("."))
        hot = hot.filter((F.col("day") == d) & (F.col("month") == m))
    if stations:
        station_labels(hot, read_stations(spark, stations)).select(F.col("label").alias("value")) \
            .write.mode("overwrite").text(out)
    else:
        hot.select(F.concat_ws("\t", "key", "value").alias("value")).write.mode("overwrite").text(out)
    report()


def fixstatus(spark, pages_dir, sites, out_dir):
    """J3/J4/P14 + K3/K4: reconcile the ``disabled`` cell of a keyed page table.

    ``pages_dir`` is a versioned table (row_key, url, disabled); ``sites`` a Parquet
    table (site, robots).  Writes the next version to ``out_dir`` and the change set
    to ``out_dir/_changes``.  Where ``out_dir`` is the table itself, only the files that
    hold a changed page are rewritten.
    """
    from quarry.operators.keyed import merge_cells
    from quarry.operators.robots import changes_as_cells, many_rules_in, status_changes
    from quarry.sinks.keyed_table import change_version, read_current, write_version

    pages = read_current(spark, pages_dir)
    site_rows = spark.read.parquet(sites)
    changes = status_changes(pages, site_rows, many_rules=many_rules_in(site_rows)).checkpoint()
    changes.write.mode("overwrite").parquet(out_dir.rstrip("/") + "/_changes")
    cells = changes_as_cells(changes)
    if out_dir.rstrip("/") == pages_dir.rstrip("/"):
        change_version(spark, out_dir, cells, lambda rows, some: merge_cells(rows, some, "disabled"))
    else:
        write_version(merge_cells(pages, cells, "disabled"), out_dir)


def pagerank(spark, inp, out, iterations=20, variant="set", dangling="redistribute", top=11,
             nodes=None, comment_rule=None, resplit=None, partitions=None, checkpoint_every=1, state=None):
    """Edge list lines -> ranks (Parquet) and the best ``top`` as ``(PR,id)`` lines."""
    from quarry.operators.graph import pagerank as run, parse_edge_lines, ranked, top_k
    from quarry.sinks.files import tuple_line

    rule = comment_rule or ("startswith" if variant == "multi" else "contains")
    lines = spark.read.text(inp)
    if resplit:
        lines = lines.repartition(resplit)
    res = run(parse_edge_lines(lines, rule), iterations=iterations, variant=variant, dangling=dangling,
              n_nodes=nodes, partitions=partitions, checkpoint_every=checkpoint_every, state=state)
    ranked(res.ranks).write.mode("overwrite").parquet(out.rstrip("/") + "/ranks")
    top_k(res.ranks, top).select(tuple_line("pr", "id").alias("value")).coalesce(1) \
        .write.mode("overwrite").text(out.rstrip("/") + "/top")


def _url_docs(spark, inp):
    """``url<TAB>base64(text)`` lines -> one row per url (row_key, text, size); a url seen
    twice keeps its smallest text (A15, D6), so row keys stay unique.  Also a call that
    reports how many lines were read and left out."""
    from quarry.functions.text import utf16_length
    from quarry.operators.keyed import first_per_key
    from quarry.sources.text import parse_url_base64, url_base64_fields

    lines, report = _counting(spark.read.text(inp), "bulkload", Lines=F.count(F.lit(1)),
                              BadInput=F.count_if(F.size(url_base64_fields("value")) != 2))
    docs = first_per_key(parse_url_base64(lines), "url", "text")
    return docs.select(F.col("url").alias("row_key"), "text", utf16_length("text").alias("size")), report


def bulkload(spark, inp, table_dir):
    """S11 + K5: ``url<TAB>base64(text)`` lines -> a new keyed table version, range-sorted by key."""
    from quarry.sinks.files import write_version

    docs, report = _url_docs(spark, inp)
    write_version(docs, table_dir)
    report()


def tableput(spark, inp, table_dir):
    """S11 + A15 + K3: put ``url<TAB>base64(text)`` documents into an existing keyed table
    (new keys inserted, existing rows updated) and publish the next version."""
    from quarry.operators.keyed import upsert_rows
    from quarry.sinks.keyed_table import change_version

    docs, report = _url_docs(spark, inp)
    change_version(spark, table_dir, docs, upsert_rows)
    report()


def docs2tsv(spark, inp, out):
    """S10 + K11: document streams -> ``url<TAB>base64(text)`` for documents with text."""
    from quarry.sinks.files import url_base64_line
    from quarry.sources.docstream import parts_for, read_docstream

    docs = read_docstream(spark, inp, parts_for(spark, inp)).filter(F.col("text").isNotNull())
    docs.select(url_base64_line("url", "text").alias("value")).write.mode("overwrite").text(out)


def tablewordcount(spark, table_dir, out, min_size=None, max_size=None):
    """S7 + A4 (+ P9): term frequency over the ``text`` column of a keyed table."""
    from quarry.operators.text import term_frequency
    from quarry.sinks.files import read_current, write_tsv

    t = read_current(spark, table_dir)
    if min_size is not None and max_size is not None:
        t = t.filter(F.col("size").between(min_size, max_size))
    write_tsv(term_frequency(t.select("text")), out, "term", "term_count")


def records2base64(spark, inp, out, record_bytes=None):
    """S4 + K6 (map-only): fixed-length records -> one base64 line each."""
    from quarry.sinks.files import base64_lines
    from quarry.sources.fixed_records import DEFAULT_RECORD_BYTES, read_fixed_records

    recs = read_fixed_records(spark, inp, record_bytes or DEFAULT_RECORD_BYTES)
    recs.select(base64_lines("record").alias("value")).write.mode("overwrite").text(out)


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="python -m quarry", description=__doc__.splitlines()[0])
    for flag in ("--input-bytes", "--executors", "--cores"):
        ap.add_argument(flag, type=int, help="sizes partitions, splits and skew limits (all three together)")
    sub = ap.add_subparsers(dest="job", required=True)

    def job(name, *pos, **opts):
        p = sub.add_parser(name)
        for a in pos:
            p.add_argument(a)
        for k, (typ, default) in opts.items():
            flag = "--" + k.replace("_", "-")
            if typ is bool:
                p.add_argument(flag, action="store_true")
            else:
                p.add_argument(flag, type=typ, default=default)
        return p

    job("wordcount", "inp", "out", java_split=(bool, False))
    job("docfreq", "inp", "out", bytes_per_split=(int, None), partitions=(int, None))
    job("hostpercents", "inp", "out", as_written=(bool, False))
    job("seo", "inp", "out", min_clicks=(int, 0), as_written=(bool, False))
    job("weather", "inp", "out", stations=(str, None), day=(str, None))
    job("fixstatus", "pages_dir", "sites", "out_dir")
    job("pagerank", "inp", "out", iterations=(int, 20), variant=(str, "set"), dangling=(str, "redistribute"),
        top=(int, 11), nodes=(float, None), comment_rule=(str, None), resplit=(int, None),
        partitions=(int, None), checkpoint_every=(int, 1), state=(str, None))
    job("bulkload", "inp", "table_dir")
    job("tableput", "inp", "table_dir")
    job("docs2tsv", "inp", "out")
    job("tablewordcount", "table_dir", "out", min_size=(int, None), max_size=(int, None))
    job("records2base64", "inp", "out", record_bytes=(int, None))

    a = vars(ap.parse_args(argv))
    spark = _session(a.pop("input_bytes"), a.pop("executors"), a.pop("cores"))
    try:
        JOBS[a.pop("job")](spark, **a)
    finally:
        clear_scratch(spark)
    return 0


JOBS = {f.__name__: f for f in (wordcount, docfreq, hostpercents, seo, weather, fixstatus, pagerank,
                                bulkload, tableput, docs2tsv, tablewordcount, records2base64)}


if __name__ == "__main__":
    sys.exit(main())
