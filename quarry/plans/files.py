"""Round-trip queries for the file layouts: Spark writes a layout from a test table into
a fresh folder under the shared checkpoint directory, reads it back with the matching
source, and runs the reference's job on it.  The result must equal the same job on
the table itself, which is what the DuckDB oracle computes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import codec
from quarry.functions.weather import layout
from quarry.operators import graph as graph_ops
from quarry.operators import hosts as host_ops
from quarry.operators import text as text_ops
from quarry.operators import weather as weather_ops
from quarry.plans import derived
from quarry.session import parallelism, scratch_path
from quarry.sinks import files as sinks
from quarry.sources import text as text_src
from quarry.sources.docstream import read_docstream
from quarry.sources.fixed_records import read_fixed_records
from quarry.sources.indexed_chunks import read_indexed_chunks
from quarry.sources.tables import table

EMBEDDING_DIM = 64
RECORD_BYTES = 8 + 4 * EMBEDDING_DIM     # big-endian id + little-endian float32 values
DOC_URL_PREFIX = "doc://"
STATION_FIELDS = layout(19)              # wide enough for any BIGINT id
NO_TEXT_LANG = "es"                      # these documents are stored without text (P6)


def _writers(spark: SparkSession) -> int:
    """Files written in parallel when staging a layout (one per task slot)."""
    return parallelism(spark)


def fixed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as fixed-length binary records -> (vec_id, embedding)."""
    out = scratch_path(spark, "fixed-records")
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    rec = emb.select(F.concat(codec.long_be_bytes("vec_id"), codec.float32_le_bytes("embedding")).alias("record"))
    sinks.write_fixed_records(rec, "record", out, RECORD_BYTES)
    back = read_fixed_records(spark, out, RECORD_BYTES)
    return back.select(codec.be_long("record").alias("vec_id"),
                       codec.le_float32_array(F.substring("record", 9, 4 * EMBEDDING_DIM)).alias("embedding"))


def rewritten_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K10 + S4: embeddings written as records in many files, then those of odd ids over them in fewer,
    read back -> (vec_id): nothing of the first write is left."""
    out = scratch_path(spark, "rewritten")
    rec = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.concat(codec.long_be_bytes("vec_id"), codec.float32_le_bytes("embedding")).alias("record"))
    sinks.write_fixed_records(rec.repartition(4 * _writers(spark)), "record", out, RECORD_BYTES)
    sinks.write_fixed_records(rec.filter("vec_id % 2 = 1").repartition(2), "record", out, RECORD_BYTES)
    back = read_fixed_records(spark, out, RECORD_BYTES)
    return back.select(codec.be_long("record").alias("vec_id"))


def indexed_chunks_doc_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 + A3: documents as zlib chunks with an int32 index, read back, document frequency."""
    out = scratch_path(spark, "indexed-chunks")
    docs = table(spark, sf_dir, "documents").select("text")
    sinks.write_indexed_chunks(docs.repartition(_writers(spark)), "text", out)  # one archive per writer
    chunks = read_indexed_chunks(spark, out)
    return text_ops.doc_frequency(chunks.filter(F.col("error").isNull()))


def _docstream(spark, sf_dir, compress=True):
    out = scratch_path(spark, "docstream")
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    msgs = d.select(F.concat(F.lit(DOC_URL_PREFIX), F.col("doc_id").cast("string")).alias("url"),
                    F.col("lang").alias("body"),
                    F.when(F.col("lang") != NO_TEXT_LANG, F.col("text")).alias("text"))
    sinks.write_docstream(msgs.repartition(_writers(spark)), out, compress=compress)  # one stream per writer
    return read_docstream(spark, out, resplit=_writers(spark))


def proto_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10 (gzip): document messages read back -> (url, body, n_chars, text_md5), nulls for messages without text."""
    docs = _docstream(spark, sf_dir)
    return docs.select("url", "body", F.length("text").cast("long").alias("n_chars"),
                       F.md5(F.encode("text", "UTF-8")).alias("text_md5"))


def bulk_sorted_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10 -> K11 -> S11 -> A15 -> K5: stream to ``url<TAB>base64`` lines, parse, one row per
    url, load a keyed table range-sorted by key, publish it, read it back -> (row_key, size, text_md5)."""
    from quarry.functions.text import utf16_length
    from quarry.operators.keyed import first_per_key

    base = scratch_path(spark, "bulk")
    docs = _docstream(spark, sf_dir, compress=False)  # one partition per stream file
    lines = docs.filter(F.col("text").isNotNull()).select(sinks.url_base64_line("url", "text").alias("value"))
    lines.write.mode("overwrite").text(base + "/lines")
    parsed = first_per_key(text_src.parse_url_base64(spark.read.text(base + "/lines")), "url", "text")
    loaded = parsed.select(F.col("url").alias("row_key"), "text", utf16_length("text").alias("size"))
    sinks.write_version(loaded, base + "/table", "row_key")
    t = sinks.read_current(spark, base + "/table")
    return t.select("row_key", "size", F.md5(F.encode("text", "UTF-8")).alias("text_md5"))


def kv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + S3 + K1: the click log as gzip ``query<TAB>url`` lines, re-split, best query per host."""
    out = scratch_path(spark, "clicks")
    sinks.write_tsv(derived.clicks(spark, sf_dir), out, "query", "url", compression="gzip")
    lines = text_src.read_lines(spark, out, resplit=_writers(spark))
    return host_ops.top_query_per_host(text_src.split_kv(lines, "query", "url"))


def edge_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S13 + S3: edge list as gzip text with comment lines, re-split, duplicates collapsed."""
    out = scratch_path(spark, "edges")
    e = derived.edges(spark, sf_dir)
    header = spark.createDataFrame([("# Directed graph: supplier -> part",), ("# FromNodeId\tToNodeId",)], "value string")
    body = e.select(F.concat_ws("\t", F.col("src").cast("string"), F.col("dst").cast("string")).alias("value"))
    header.unionByName(body.repartition(_writers(spark))) \
        .write.mode("overwrite").option("compression", "gzip").text(out)  # one gzip part per writer
    lines = text_src.read_lines(spark, out, resplit=_writers(spark))
    return graph_ops.edges_distinct(graph_ops.parse_edge_lines(lines, "startswith"))


def fixed_width_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings as fixed-width daily lines, parsed back, hottest year per station-day."""
    from quarry.functions.weather import gsod_line

    out = scratch_path(spark, "gsod")
    w = derived.weather(spark, sf_dir)
    w.select(gsod_line("station", "year", "month", "day", "max_f", "max_f", STATION_FIELDS).alias("value")) \
        .write.mode("overwrite").text(out)
    readings = text_src.parse_weather_lines(spark.read.text(out), fields=STATION_FIELDS)
    return weather_ops.hottest_year(readings, "max_c", tenths=True)
