"""Filter interaction audit over a sparse document-term matrix.

Documents are cut into shards; each shard is a CSR block over its own words.  All words are
numbered by a dictionary for the whole table (shards send the words they hold to buckets, a
bucket numbers each distinct word once and answers), then the blocks get the global numbers.
Row sums and non-zero counts decide the word filters, byte counts and digests the others;
the rest is an aggregate over at most 2**5 outcomes a part.
"""

from __future__ import annotations

from hashlib import sha256
from itertools import permutations
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import map_arrow, pick, slots, staged, table

SHARD_BYTES = 8 << 20  # text of one CSR block
BUCKET_WORDS = 1_000_000  # words of all shards that one dictionary bucket numbers
FILTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT, MAX_UPPER = 50, 65, 5  # words; per cent of words; per cent of code points
SYMBOLS = b"#$%&*|"
UPPER = bytes(range(65, 91))
CONTINUED = bytes(range(0x80, 0xC0))  # UTF-8 bytes that start no code point

BLOCK = ("shard long, ids array<long>, parts array<string>, digests array<binary>, upper array<boolean>, "
         "symbols array<boolean>, vocabulary binary, n_vocabulary long, indptr binary, cols binary, counts binary")


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Words of binary values, none of them null: how many each has, all words by their place in a list, that list."""
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_binary()).view(pa.large_string()))  # blanks are 09-0D and 20
    pieces = lists.flatten().view(pa.large_binary())
    full = pc.greater(pc.binary_length(pieces), 0)  # blanks at the ends of a text leave empty pieces
    ends = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
    coded = pieces.filter(full).dictionary_encode()
    return np.diff(ends[bounds]), coded.indices.to_numpy(), coded.dictionary.to_pylist()


def _checksums(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, words), np.uint64, len(words))


def _order(words: list[bytes]) -> np.ndarray:
    """Places of distinct words in the order of their checksums, those of equal ones in the order of their bytes."""
    sums = _checksums(words)
    order = np.argsort(sums, kind="stable")
    after = np.flatnonzero(sums[order][1:] == sums[order][:-1])
    tied = np.union1d(after, after + 1)
    order[tied] = sorted(order[tied].tolist(), key=lambda i: (sums[i], words[i]))
    return order


def _places(order: np.ndarray) -> np.ndarray:
    """Where each entry stands in ``order``."""
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return place


def _block(shard: int, rows: list[pa.RecordBatch], schema: pa.Schema) -> pa.RecordBatch:
    """One CSR block over its own words; they and the columns of each row stand in the order of ``_order``.

    That is the order of the table-wide numbers too: a dictionary bucket's words stand together.
    """
    ids, parts = ([v for r in rows for v in r.column(c).to_pylist()] for c in (0, 1))
    texts = pa.concat_arrays([r.column(2).cast(pa.large_binary()).fill_null(b"") for r in rows])
    sizes, codes, words = _words(texts)
    order = _order(words)
    keys = np.repeat(np.arange(len(ids)) << 32, sizes) | _places(order)[codes]
    keys.sort()
    firsts = np.flatnonzero(np.diff(keys, prepend=-1))
    cells = keys[firsts]
    indptr = np.searchsorted(cells, np.arange(len(ids) + 1) << 32)
    counts = np.diff(firsts, append=len(keys))
    digests, upper, symbols = [], [], []
    for text in texts.to_pylist():
        n = len(text)
        points = n if text.isascii() else len(text.translate(None, CONTINUED))
        digests.append(sha256(text).digest())
        upper.append(100 * (n - len(text.translate(None, UPPER))) > MAX_UPPER * points)
        symbols.append(len(text.translate(None, SYMBOLS)) < n)
    values = [shard, ids, parts, digests, upper, symbols, b" ".join([words[i] for i in order.tolist()]), len(words),
              indptr.astype(np.int64).tobytes(), cells.astype(np.int32).tobytes(), counts.astype(np.int32).tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)


def _blocks(shard_bytes: int):
    kinds = [("shard", pa.int64()), ("ids", pa.list_(pa.int64())), ("parts", pa.list_(pa.string())),
             ("digests", pa.list_(pa.binary())), ("upper", pa.list_(pa.bool_())), ("symbols", pa.list_(pa.bool_())),
             ("vocabulary", pa.binary()), ("n_vocabulary", pa.int64()), ("indptr", pa.binary()),
             ("cols", pa.binary()), ("counts", pa.binary())]
    schema = pa.schema(kinds)

    def run(batches):
        first = TaskContext.get().partitionId() << 32
        rows, size, made = [], 0, 0
        for batch in batches:
            ends = np.cumsum(pc.binary_length(batch.column(2)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
            lo, done = 0, 0
            while lo < batch.num_rows:
                # a block ends with the text that fills it
                hi = min(int(np.searchsorted(ends, done + shard_bytes - size)) + 1, batch.num_rows)
                rows.append(batch.slice(lo, hi - lo))
                size += int(ends[hi - 1]) - done
                lo, done = hi, int(ends[hi - 1])
                if size >= shard_bytes:
                    yield _block(first + made, rows, schema)
                    rows, size, made = [], 0, made + 1
        if rows:
            yield _block(first + made, rows, schema)

    return run


def blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
           shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """CSR blocks over their own words, written once to the shared folder (see ``BLOCK``)."""
    src = pick(docs, id=id_col, part=part_col, text=text_col).select(
        F.col("id").cast("long").alias("id"), F.coalesce(F.col("part").cast("string"), F.lit("")).alias("part"),
        F.col("text").cast("binary").alias("text"))
    return staged(map_arrow(src, _blocks(shard_bytes), BLOCK), "csr-blocks")


def _to_buckets(n: int):
    def run(batches):
        for batch in batches:
            for shard, blob in zip(*[c.to_pylist() for c in batch.columns]):
                words = blob.split()
                bucket = (_checksums(words) * np.uint64(n) >> np.uint64(32)).astype(np.int64)
                cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=n)).tolist() if words else [0]
                own = list(zip(cuts[:-1], cuts[1:]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket[lo] for lo, _ in own], pa.int32()), pa.array([shard] * len(own), pa.int64()),
                     pa.array([lo for lo, _ in own], pa.int64()),
                     pa.array([b" ".join(words[lo:hi]) for lo, hi in own], pa.binary())],
                    names=["bucket", "shard", "start", "words"])

    return run


def _numbered(rows: pa.Table) -> pa.Table:
    """Numbers for the distinct words of one bucket, in the order of ``_order``, sent back to each shard."""
    sizes, codes, words = _words(rows["words"].cast(pa.large_binary()).combine_chunks())
    ids = (_places(_order(words)) + (rows["bucket"][0].as_py() << 40))[codes]
    each = [own.tobytes() for own in np.split(ids, np.cumsum(sizes)[:-1])]
    return pa.table([rows["shard"], rows["start"], pa.array(each, pa.binary())], names=["shard", "start", "ids"])


def word_numbers(made: DataFrame) -> DataFrame:
    """(shard, start, ids): the table-wide numbers of a shard's words from ``start`` on; one number a distinct word.

    A bucket holds each word once a shard however often it occurs, so frequent words weigh
    no more than rare ones.
    """
    total = made.agg(F.coalesce(F.sum("n_vocabulary"), F.lit(0))).first()[0]
    n = max(slots(made.sparkSession), -(-total // BUCKET_WORDS))
    sent = map_arrow(made.select("shard", "vocabulary"), _to_buckets(n), "bucket int, shard long, start long, words binary")
    return sent.groupBy("bucket").applyInArrow(_numbered, "shard long, start long, ids binary")


def _global(left: pa.Table, right: pa.Table) -> pa.Table:
    """One block with table-wide word numbers in place of its own."""
    row = left.drop_columns(["n_vocabulary"])
    n = left["n_vocabulary"][0].as_py()
    own = np.zeros(n, np.int64)
    for start, ids in zip(right["start"].to_pylist(), right["ids"].to_pylist()):
        own[start:start + len(ids) // 8] = np.frombuffer(ids, np.int64)
    cols = own[np.frombuffer(left["cols"][0].as_py(), np.int32)]
    return row.set_column(row.column_names.index("cols"), "cols", pa.array([cols.tobytes()], pa.binary()))


CSR = ("shard long, ids array<long>, parts array<string>, digests array<binary>, upper array<boolean>, "
       "symbols array<boolean>, indptr binary, cols binary, counts binary")


def matrix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
           shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The document-term matrix in CSR blocks: ``indptr`` and ``cols`` (int64), ``counts`` (int32) over ``ids``.

    Columns are table-wide word numbers.  Words are maximal runs of bytes other than 09-0D and
    20, case-sensitive.  Null and empty texts give an empty row; repeated rows and ids a row
    each; an empty table gives no block.
    """
    made = blocks(docs, id_col, text_col, part_col, shard_bytes)
    state = made.drop("vocabulary")
    names = [f.split()[0] for f in CSR.split(", ")]
    return (state.groupBy("shard").cogroup(word_numbers(made).groupBy("shard"))
            .applyInArrow(lambda a, b: _global(a, b).select(names), CSR))


ROW = "id long, part string, digest binary, words long, distinct long, upper boolean, symbols boolean"


def _rows(batches):
    """Row sums and non-zero counts of CSR blocks, a row a document."""
    for batch in batches:
        for k in range(batch.num_rows):
            get = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
            indptr, cols, counts = (np.frombuffer(get[c], t) for c, t in
                                    (("indptr", np.int64), ("cols", np.int64), ("counts", np.int32)))
            sums = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
            n = len(indptr) - 1
            # a row's columns may come in any order: count each once, in rows out of order after sorting
            row = np.repeat(np.arange(n), np.diff(indptr))
            inside = row[1:] == row[:-1]
            if (inside & (cols[1:] <= cols[:-1])).any():
                cols = cols[np.lexsort((cols, row))]
            new = np.ones(len(cols), bool)
            new[1:] = ~inside | (cols[1:] != cols[:-1])
            seen = np.concatenate([[0], np.cumsum(new)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(get["ids"], pa.int64()), pa.array(get["parts"], pa.string()), pa.array(get["digests"], pa.binary()),
                 pa.array(sums[indptr[1:]] - sums[indptr[:-1]]), pa.array(seen[indptr[1:]] - seen[indptr[:-1]]),
                 pa.array(get["upper"], pa.bool_()), pa.array(get["symbols"], pa.bool_())],
                names=["id", "part", "digest", "words", "distinct", "upper", "symbols"])


def flags(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
          shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(id, part, words, distinct, A, B, C, D, E): what every document fails, a row each.

    E: the same text has a smaller id somewhere in the table.  A null id is neither smaller
    nor larger than another, so such rows never fail E and make no other row fail it.
    """
    rows = staged(map_arrow(matrix(docs, id_col, text_col, part_col, shard_bytes), _rows, ROW), "audit-rows")
    first = (rows.groupBy("digest").agg(F.min("id").alias("_first"), F.max("id").alias("_last"))
             .filter("_first < _last").select("digest", "_first"))
    return (rows.join(first, "digest", "left")
            .select("id", "part", "words", "distinct",
                    (F.col("words") < MIN_WORDS).alias("A"),
                    (100 * F.col("distinct") < MIN_DISTINCT * F.col("words")).alias("B"),
                    F.col("upper").alias("C"), F.col("symbols").alias("D"),
                    F.coalesce(F.col("id") > F.col("_first"), F.lit(False)).alias("E")))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """What each filter does at each place of each order of the five, per part; see ``op11_filter_audit``.

    A null part counts as the empty one.  A document is good (toxic) if any label row of its
    id says so; repeated documents count each.  An empty table gives no row.
    """
    marks = (pick(labels, id="doc_id", quality="quality", toxic="toxic").filter("id is not null")
             .groupBy(F.col("id").cast("long").alias("id"))
             .agg(F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
                  F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")))
    fails = [F.col(f).cast("int") * (1 << i) for i, f in enumerate(FILTERS)]
    mask = fails[0]
    for f in fails[1:]:
        mask = mask + f
    seen = (flags(docs, id_col, text_col, part_col, shard_bytes).select("id", "part", mask.alias("mask"))
            .join(marks, "id", "left")
            .groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"),
                                         F.count_if("toxic").alias("toxic")))
    # every order and step as a constant: its filter's bit and the bits before it
    steps = F.array(*[F.struct(F.lit("".join(o)).alias("filter_order"), F.lit(k + 1).alias("step"),
                               F.lit(1 << FILTERS.index(o[k])).alias("bit"),
                               F.lit(sum(1 << FILTERS.index(c) for c in o[:k])).alias("before"))
                      for o in permutations(FILTERS) for k in range(len(FILTERS))])
    own = F.col("mask").bitwiseAND(F.col("bit")) != 0
    gone = F.col("mask").bitwiseAND(F.col("before")) != 0
    total = lambda when, what="n": F.sum(F.when(when, F.col(what)).otherwise(0))
    each = (seen.select("part", "mask", "n", "good", "toxic", F.explode(steps).alias("s"))
            .select("part", "mask", "n", "good", "toxic", "s.*")
            .groupBy("part", "filter_order", "step", "bit")
            .agg(total(~own & ~gone).alias("kept"), total(own & ~gone).alias("removed"),
                 total(own & gone).alias("redundant"), total(F.col("mask") == F.col("bit")).alias("unique_fails"),
                 total(own & ~gone, "good").alias("good_lost"), total(own & ~gone, "toxic").alias("toxic_lost")))
    shares = each.groupBy("part", "bit").agg(F.sum("removed").alias("shapley"))
    return each.join(shares, ["part", "bit"]).drop("bit")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op11: five filters in all 120 orders over the whole ``documents`` table, per source."""
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE_OP11 = """
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM d),
firsts AS (SELECT text, min(doc_id) AS first_id FROM d GROUP BY text),
f AS (
  SELECT w.doc_id, part,
    CAST(len(words) < 50 AS INT) AS a,
    CAST(100 * len(list_distinct(words)) < 65 * len(words) AS INT) AS b,
    CAST(100 * length(regexp_replace(w.text, '[^A-Z]', '', 'g')) > 5 * length(w.text) AS INT) AS c,
    CAST(regexp_matches(w.text, '[#$%&*|]') AS INT) AS d,
    CAST(coalesce(w.doc_id > first_id, false) AS INT) AS e
  FROM w JOIN firsts ON w.text = firsts.text),
l AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
      FROM labels GROUP BY doc_id),
m AS (
  SELECT part, a + 2 * b + 4 * c + 8 * d + 16 * e AS mask, count(*) AS n,
         count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM f LEFT JOIN l ON f.doc_id = l.doc_id GROUP BY 1, 2),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT c AS o FROM letters
  UNION ALL
  SELECT o || c FROM orders JOIN letters ON strpos(o, c) = 0),
steps AS (
  SELECT o, step, (SELECT bit FROM letters WHERE c = substr(o, step, 1)) AS bit,
         list_sum([1 << (ascii(x) - 65) for x in string_split(substr(o, 1, step - 1), '') if x <> '']) AS before
  FROM orders, range(1, 6) AS r(step) WHERE length(o) = 5),
each AS (
  SELECT part, o, step, bit,
    sum(CASE WHEN mask & bit = 0 AND mask & before = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM m, (SELECT o, CAST(step AS INT) AS step, bit, CAST(coalesce(before, 0) AS INT) AS before FROM steps) AS s
  GROUP BY ALL)
SELECT part, o AS filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM each
"""
