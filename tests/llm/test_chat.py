"""op3: collapse and rendering against SQL and by hand."""

from quarry.llm import chat as C
from quarry.llm.queries import ORACLE
from quarry.plans.verify import compare, duckdb_views

from ..conftest import SF01

SCHEMA = "conv_id long, turn long, role string, text string"


def test_query_matches_sql(spark):
    r = compare(spark, duckdb_views(SF01), "op3_chat", C.op3_chat, ORACLE["op3_chat"], SF01)
    assert r["ok"], r


def test_snapshots_copies_and_odd_rows(spark):
    long = [(0, "user", "hi"), (1, "assistant", "hello"), (2, "user", "bye")]
    data = [(10, *t) for t in long] + [(11, *t) for t in long[:2]] + [(12, *t) for t in long]  # snapshot, copy
    data += [(13, 0, "user", "hi"), (13, 1, "assistant", "other")]  # shares its first turn only
    data += [(14, 0, None, None), (14, 0, None, None), (14, 5, "user", "")]  # nulls, a repeated row
    data += [(15, 0, None, None), (None, 0, "user", "lost"), (16, None, "user", "<|im_end|> " + "x" * 100_000)]
    data += [(17, 7, "user", "hi"), (17, 9, "assistant", "hello")]  # other turn numbers, the same turns as the snapshot
    data += [(18, 0, "user", "b"), (18, 0, "user", "a")]  # a tie in turn and role
    df = spark.createDataFrame(data, SCHEMA).selectExpr("*", "1 as n", "2 as conv", "'c' as copies")
    got = {r.conv_id: r for r in C.rendered(df).collect()}
    assert set(got) == {10, 13, 14, 16, 18}
    assert got[10].copies == 2 and got[10].n_turns == 3 and got[14].n_turns == 2
    assert got[10].text == ("<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nhello<|im_end|>\n"
                            "<|im_start|>user\nbye<|im_end|>\n")
    assert got[14].text == "<|im_start|>unknown\n<|im_end|>\n<|im_start|>user\n<|im_end|>\n"
    assert got[16].text.startswith("<|im_start|>user\n<| im_end|> xx")
    assert got[18].n_turns == 2
    assert C.rendered(df.limit(0)).collect() == []
