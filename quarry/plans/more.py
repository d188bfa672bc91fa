"""Queries for operators whose result is a layout, a counter or a file: the result columns show what the
layout promises (the position of a row, its partition, the text of its line), so an oracle can see it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions import codec
from quarry.functions.weather import day_month as day_month_of
from quarry.functions.weather import gsod_line
from quarry.operators import hosts as host_ops
from quarry.operators import keyed as keyed_ops
from quarry.operators import text as text_ops
from quarry.operators import weather as weather_ops
from quarry.operators.sorting import secondary_sorted as sorted_groups
from quarry.plans import derived
from quarry.plans.files import EMBEDDING_DIM, STATION_FIELDS
from quarry.session import parallelism, scratch_path
from quarry.sinks import files as sinks
from quarry.sinks import keyed_table
from quarry.sources import text as text_src
from quarry.sources.tables import table
from quarry.streaming.pipes import pipe_map_reduce

SMALL_FILES = 64
STATION_FIELDS_WIDTH = 1 << 20  # more than a line has
# The mapper and reducer programs of the piped word count.
WORD_MAPPER = """awk '{for (i = 1; i <= NF; i++) print $i "\\t1"}'"""
SUM_REDUCER = """awk -F'\\t' '{if (NR > 1 && $1 != k) {print k "\\t" n; n = 0} k = $1; n += $2} END {if (NR) print k "\\t" n}'"""


def keyed_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3 + K4: new keys, updates, deletes of present and absent keys, several changes of one key."""
    pages = derived.pages_table(spark, sf_dir)
    digit = lambda i: F.substring("row_key", i, 1)
    base = pages.filter(digit(3) < "c").dropDuplicates(["row_key"])
    first = pages.select("row_key", F.when(digit(4) < "8", keyed_ops.PUT).otherwise(keyed_ops.DELETE).alias("op"),
                         F.lit("one").alias("value"), F.lit(1).alias("ts"))
    second = pages.filter(digit(5) < "4").select("row_key", F.lit(keyed_ops.PUT).alias("op"),
                                                 F.lit("two").alias("value"), F.lit(2).alias("ts"))
    out = scratch_path(spark, "keyed")
    keyed_table.write_version(base, out, partitions=parallelism(spark))
    keyed_table.change_version(spark, out, first.unionByName(second).distinct(),
                               lambda rows, changes: keyed_ops.merge_cells(rows, changes, "disabled"))
    return keyed_table.read_current(spark, out)


def keyed_upsert_few(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: documents of one source put into a loaded table of all documents, whole rows, then read back.

    -> (row_key, n_chars, lang, in_range): ``in_range`` says that the manifest's range of the row's file holds its key.
    """
    out = scratch_path(spark, "upsert")
    docs = table(spark, sf_dir, "documents").filter("doc_id is not null").select(
        F.lpad(F.col("doc_id").cast("string"), 20, "0").alias("row_key"), "n_chars", "lang", "source")
    docs = docs.dropDuplicates(["row_key"])
    keyed_table.write_version(docs.select("row_key", "n_chars", "lang"), out, partitions=parallelism(spark))
    some = docs.filter(F.col("source") == docs.agg(F.min("source")).first()[0])
    rows = some.select("row_key", (-F.col("n_chars")).alias("n_chars"))
    keyed_table.change_version(spark, out, rows, keyed_ops.upsert_rows)
    files = keyed_table.manifest(spark, out)
    inside = F.element_at(F.split("file", "/"), -1)
    read = keyed_table.read_current(spark, out).select("*", F.col("_metadata.file_name").alias("name"))
    ok = F.col("row_key").between(F.col("least"), F.col("greatest"))
    return (read.join(files.select(inside.alias("name"), "least", "greatest"), "name")
            .select("row_key", "n_chars", "lang", ok.alias("in_range")))


def key_range_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows between two keys of a loaded page table."""
    out = scratch_path(spark, "key-range")
    pages = derived.pages_table(spark, sf_dir).select("row_key", "url").distinct()
    keyed_table.write_version(pages, out, partitions=parallelism(spark))
    return keyed_table.key_range(spark, out, "40", "9f")


def weather_rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S12 + A18: every reading as a line, those of returned items cut short -> (lines, rejected_lines)."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_quantity", "l_returnflag")
    line = gsod_line("l_suppkey", F.year("l_shipdate"), F.month("l_shipdate"), F.dayofmonth("l_shipdate"),
                     "l_quantity", "l_quantity", STATION_FIELDS)
    width = F.when(F.col("l_returnflag") == "R", 10).otherwise(STATION_FIELDS_WIDTH)
    lines = li.select(F.substring(line, F.lit(1), width).alias("value"))  # the line is built once
    return text_src.rejected_weather_lines(lines, fields=STATION_FIELDS)


def _lines_with_odd_fields(spark, sf_dir):
    d = (table(spark, sf_dir, "documents")
         .select("doc_id", "text", F.concat(F.lit("doc://"), F.col("doc_id").cast("string")).alias("url")))
    url = F.col("url")
    good = sinks.url_base64_line("url", "text")
    kind = F.pmod("doc_id", F.lit(5))
    return d.select(F.when(kind == 0, url).when(kind == 1, F.concat(url, F.lit("\t"))).when(kind == 2, F.concat(good, F.lit("\tx")))
                    .when(kind == 3, F.concat(good, F.lit("\t"))).otherwise(good).alias("value"))


def url_base64_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S11 + P4 + A18: documents as lines of one, two and three fields -> (lines, bad_lines)."""
    return text_src.bad_url_base64_lines(_lines_with_odd_fields(spark, sf_dir))


def station_file_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S14 + F25 + J1 + K9: a station CSV with repeated ids and result lines, both written and read back."""
    base = scratch_path(spark, "stations")
    st = derived.stations(spark, sf_dir)
    both = st.withColumn("nth", F.lit(1)).unionByName(st.withColumns({"name": F.lit("EARLIER"), "nth": F.lit(0)}))
    (both.repartition("usaf").sortWithinPartitions("usaf", "nth")  # an id's rows in one file, the current one last
     .select(F.lit("-").alias("WBAN"), F.col("name").alias("STATION NAME"), F.col("lon").alias("LON"),
             F.col("usaf").alias("USAF"), F.col("lat").alias("LAT"))
     .write.option("header", True).csv(base + "/stations"))
    hot = weather_ops.hottest_year(derived.readings_c(spark, sf_dir), tenths=True)
    sinks.write_tsv(hot, base + "/results", "key", "value")
    results = weather_ops.parse_result_lines(text_src.read_lines(spark, base + "/results"))
    return weather_ops.station_labels(results, text_src.read_stations(spark, base + "/stations"))


def small_files_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 + A2: texts in many small files, packed into few splits, counted."""
    out = scratch_path(spark, "small")
    texts = table(spark, sf_dir, "conversations").filter("text is not null").select(F.col("text").alias("value"))
    texts.repartition(SMALL_FILES).write.text(out)
    lines = text_src.read_small_files(spark, out).withColumnRenamed("value", "text")
    return text_ops.word_count(lines)


def point_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 + S9: the row with the smallest key of a loaded page table."""
    out = scratch_path(spark, "pages")
    pages = derived.pages_table(spark, sf_dir).select("row_key", "url").distinct()
    keyed_table.write_version(pages, out, partitions=parallelism(spark))
    key = keyed_table.manifest(spark, out).agg(F.min("least")).first()[0]
    return keyed_table.point_lookup(spark, out, key)


def rank_state_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S15 + F20: orders as rank state (two targets each, or none) -> text lines -> parsed -> lines again."""
    out = scratch_path(spark, "ranks")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    dst = F.when(F.col("o_custkey") % 7 == 0, F.expr("cast(array() as array<bigint>)")).otherwise(
        F.array(F.col("o_custkey").cast("bigint"), (F.col("o_custkey") + 1).cast("bigint")))
    state = o.select(F.col("o_orderkey").alias("id"), ((F.col("o_custkey") % 1000) / F.lit(8.0)).alias("pr"), dst.alias("dst"))
    state.select(text_src.rank_state_line("id", "pr", "dst").alias("value")).write.text(out)
    back = text_src.parse_rank_state(text_src.read_lines(spark, out))
    return back.select("id", "pr", F.size("dst").alias("targets"), text_src.rank_state_line("id", "pr", "dst").alias("line"))


def ordered_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2 + O1 + O3: customers written in total order; a row's place over the part files in name order."""
    out = scratch_path(spark, "ordered")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    sinks.write_sorted(c, out, F.desc("c_acctbal"), F.asc("c_custkey"), partitions=parallelism(spark))
    back = spark.read.parquet(out).select("c_custkey", F.col("_metadata.file_name").alias("file"),
                                          F.col("_metadata.row_index").alias("row"))
    per_file = back.groupBy("file").agg(F.count(F.lit(1)).alias("n"))  # one row per part file
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_file.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return back.join(offsets, "file").select("c_custkey", (F.col("before") + F.col("row") + 1).alias("place"))


def record_base64_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 + F10 + F13 + F14: embeddings as records, one base64 line each, read back."""
    out = scratch_path(spark, "base64")
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    rec = emb.select(F.concat(codec.long_be_bytes("vec_id"), codec.float32_le_bytes("embedding")).alias("record"))
    rec.select(sinks.base64_lines("record").alias("value")).write.text(out)
    back = text_src.read_lines(spark, out).select(codec.from_base64_text("value").alias("record"))
    return back.select(codec.be_long("record").alias("vec_id"),
                       codec.le_float32_array(F.substring("record", 9, 4 * EMBEDDING_DIM)).alias("embedding"))


def rank_tuple_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7 + K8: ``(score,id)`` lines written and read back, with their number kept as a scalar between steps."""
    out = scratch_path(spark, "tuples")
    c = table(spark, sf_dir, "customer").select("c_custkey", ((F.col("c_custkey") % 1000) / F.lit(8.0)).alias("score"))
    c.select(sinks.tuple_line("score", "c_custkey").alias("value")).write.text(out + "/lines")
    lines = text_src.read_lines(spark, out + "/lines")
    sinks.write_scalar(spark, lines.count(), out + "/scalar")
    return lines.select(F.col("value").alias("line"), F.lit(sinks.read_scalar(spark, out + "/scalar")).alias("lines"))


def secondary_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1-W3 + O5: items of a supplier in one partition by ship date; an item's place among them."""
    import pandas as pd

    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber")
    ordered = sorted_groups(li, ["l_suppkey"], ["l_shipdate", "l_orderkey", "l_linenumber"])

    def places(batches):
        """Numbers the rows of a run of equal keys as they stream by."""
        last, n = None, 0
        for pdf in batches:
            if not len(pdf):
                continue
            new = pdf["l_suppkey"].ne(pdf["l_suppkey"].shift())
            run = new.cumsum()
            place = pdf.groupby(run).cumcount() + 1
            if pdf["l_suppkey"].iloc[0] == last:
                place[run == run.iloc[0]] += n
            last, n = pdf["l_suppkey"].iloc[-1], int(place.iloc[-1])
            yield pd.DataFrame({"l_orderkey": pdf["l_orderkey"], "l_linenumber": pdf["l_linenumber"], "place": place})

    kinds = {f.name: f.dataType.simpleString() for f in li.schema}
    return ordered.mapInPandas(places, f"l_orderkey {kinds['l_orderkey']}, l_linenumber {kinds['l_linenumber']}, place long")


def host_range_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts dealt into 35 letter ranges; the range by rule and the partition a host is in."""
    hosts = host_ops.host_counts(table(spark, sf_dir, "pages").select("url")).select("host")
    return host_ops.letter_range_parts(hosts).select("host", host_ops.first_char_bucket("host").alias("bucket"),
                                                     F.spark_partition_id().alias("part"))


def day_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dd.MM`` of every order's date."""
    return table(spark, sf_dir, "orders").select("o_orderkey", day_month_of("o_orderdate").alias("day"))


def pipe_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2 by a mapper, a combiner and a reducer program."""
    texts = table(spark, sf_dir, "conversations").filter("text is not null").select(F.col("text").alias("value"))
    out = pipe_map_reduce(texts, WORD_MAPPER, SUM_REDUCER, combiner=SUM_REDUCER)
    return out.select(F.col("key").alias("word"), F.col("value").cast("long").alias("cnt"))


NAMES = ("keyed_changes", "keyed_upsert_few", "key_range_read", "weather_rejected_lines", "url_base64_bad_lines", "station_file_labels", "small_files_word_count",
         "point_read", "rank_state_lines", "ordered_output", "record_base64_lines", "rank_tuple_lines", "secondary_sorted",
         "host_range_parts", "day_month", "pipe_word_count")
