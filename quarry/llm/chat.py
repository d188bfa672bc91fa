"""Chat formatting: logged snapshots that a longer conversation continues are collapsed, the rest rendered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.llm.common import pick, staged, table

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
MARK, BROKEN = "<|im_", "<| im_"  # a marker inside a text is broken up, so it can't start a turn


def _number(salt: str, *cols: Column) -> Column:
    """A 64-bit hash as an exact decimal, so that running sums neither overflow nor round."""
    return F.xxhash64(F.lit(salt), *cols).cast("decimal(20,0)")


def prefixes(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """(conv, pos, n, a, b): a rolling hash (two running sums) of the first ``pos`` of ``n`` turns.

    Turns go by turn number, role and MD5 of the text, nulls first; rows that repeat a turn
    in all three count once.  Each turn is hashed with its position, so equal sums mean
    equal turns in equal order.  Texts are reduced to their MD5 before the shuffle.
    """
    t = (pick(conversations, conv=conv_col, turn=turn_col, role=role_col, text=text_col).filter("conv is not null")
         .select("conv", "turn", "role", F.md5("text").alias("digest")))
    order = W.partitionBy("conv").orderBy("turn", "role", "digest")
    row = F.struct("turn", "role", "digest")
    t = (t.withColumn("last", F.lag(row).over(order)).withColumn("first", F.row_number().over(order) == 1)
         .filter(F.col("first") | ~F.col("last").eqNullSafe(row)))
    t = t.withColumn("pos", F.row_number().over(order))
    turn = (F.col("pos"), F.col("role").isNull(), F.col("role"), F.col("digest").isNull(), F.col("digest"))
    so_far = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    return t.select("conv", "pos", F.count(F.lit(1)).over(W.partitionBy("conv")).alias("n"),
                    F.sum(_number("a", *turn)).over(so_far).alias("a"), F.sum(_number("b", *turn)).over(so_far).alias("b"))


def maximal(conversations: DataFrame, **columns: str) -> DataFrame:
    """(conv, n, copies): conversations that no longer one starts with; of equal ones the smallest id, and their number."""
    every = staged(prefixes(conversations, **columns), "chat-prefixes")
    whole = (every.filter("pos = n").groupBy("n", "a", "b")
             .agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("copies")))
    longer = every.filter("pos < n").select(F.col("pos").alias("n"), "a", "b").distinct()
    return whole.join(longer, ["n", "a", "b"], "left_anti").select("conv", "n", "copies")


def rendered(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """(conv_id, n_turns, copies, text): each maximal conversation as one marked-up text.

    A null role is "unknown", a null text empty, rows without a conversation id are part of
    none, an empty table gives no row.  Only turns of kept conversations are gathered; the
    group is one conversation, which is the row to be written.
    """
    names = {"conv_col": conv_col, "turn_col": turn_col, "role_col": role_col, "text_col": text_col}
    kept = staged(maximal(conversations, **names), "chat-maximal")
    turns = (pick(conversations, conv=conv_col, turn=turn_col, role=role_col, text=text_col)
             .select("conv", F.struct("turn", "role", F.md5("text").alias("digest"), "text").alias("t")))

    def line(t):
        return F.concat(F.lit(OPEN), F.coalesce(t["role"], F.lit("unknown")), F.lit("\n"),
                        F.replace(F.coalesce(t["text"], F.lit("")), F.lit(MARK), F.lit(BROKEN)), F.lit(CLOSE + "\n"))

    text = F.array_join(F.transform(F.array_distinct(F.sort_array(F.collect_list("t"))), line), "")
    return (turns.join(kept, "conv").groupBy("conv", "n", "copies").agg(text.alias("text"))
            .select(F.col("conv").alias("conv_id"), F.col("n").alias("n_turns"), "copies", "text"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op3 over the whole ``conversations`` table."""
    return rendered(table(spark, sf_dir, "conversations"))


ORACLE_OP3 = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL
), o AS (
  SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n,
    string_agg(coalesce('r' || md5(role), 'n') || coalesce('t' || md5(text), 'n'), '|') OVER w AS prefix
  FROM t
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, md5(text) NULLS FIRST
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), whole AS (
  SELECT prefix, min(conv_id) AS conv_id, any_value(n) AS n_turns, count(*) AS copies
  FROM o WHERE pos = n GROUP BY prefix
), kept AS (
  SELECT * FROM whole WHERE prefix NOT IN (SELECT prefix FROM o WHERE pos < n)
)
SELECT k.conv_id, k.n_turns, k.copies,
  string_agg('<|im_start|>' || coalesce(o.role, 'unknown') || chr(10)
             || replace(coalesce(o.text, ''), '<|im_', '<| im_') || '<|im_end|>' || chr(10), '' ORDER BY o.pos) AS text
FROM kept k JOIN o ON o.conv_id = k.conv_id
GROUP BY ALL
"""
