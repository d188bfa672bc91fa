from pyspark.sql import functions as F

from quarry.operators.sorting import first_in_group, secondary_sorted


def test_secondary_sorted_and_first(spark):
    rows = [("s1", 2001, 3.0), ("s1", 2002, 5.0), ("s1", 2003, 5.0), ("s2", 1999, -1.0)]
    df = spark.createDataFrame(rows, "k string, year int, t double")
    ordered = secondary_sorted(df, ["k"], [F.desc("t"), "year"], partitions=2)
    per_part = ordered.rdd.glom().collect()
    for part in per_part:
        keys = [(r.k, -r.t, r.year) for r in part]
        assert keys == sorted(keys)
    first = {r.k: (r.year, r.t) for r in first_in_group(df, ["k"], [F.desc("t"), "year"]).collect()}
    assert first == {"s1": (2002, 5.0), "s2": (1999, -1.0)}
