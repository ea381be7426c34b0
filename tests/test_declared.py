"""Joins with a declared cardinality, and nested rows of bounded size."""

from collections import Counter

import pytest
from helpers import frame, rows
from pyspark.sql import functions as F

from gradientlab.functions.semantics import null_safe_join
from gradientlab.operators import declared as D
from gradientlab.operators import reshape as R

SITES = "site string, `a.b` int, __n int"


def test_declared_joins_give_the_plain_join(spark):
    left = frame(spark, "site string, x int", ("p", 1), ("p", 2), (None, 3), ("q", 4))
    right = frame(spark, SITES, ("p", 10, 1), (None, 30, 2), ("z", 50, 3))
    plain = null_safe_join(left, right, ["site"])
    got = D.declared_join(left, right, ["site"], "many-to-one")
    assert got.columns == plain.columns and sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    back = D.declared_join(right, left, ["site"], "one-to-many", "full")
    assert back.count() == 5
    assert D.declared_join(left.limit(0), right, ["site"], "one-to-one").count() == 0
    assert D.declared_join(left, right.select("site"), ["site"], "many-to-one", "inner").count() == 3


@pytest.mark.parametrize("repeated", ["p", None])
def test_a_key_that_occurs_twice_is_named(spark, repeated):
    left = frame(spark, "site string, x int", ("q", 1))
    right = frame(spark, "site string, year int, y int", (repeated, 7, 1), (repeated, 7, 2), ("q", 7, 3))
    bad = D.declared_join(left, right, {"site": "site"}, "many-to-one")
    with pytest.raises(Exception, match=rf"right has 2 rows for \(site\) = \({repeated or 'NA'}\)"):
        bad.count()
    with pytest.raises(Exception, match=r"left has 2 rows for \(site, year\) = \(" + (repeated or "NA") + ", 7"):
        D.declared_join(right, left.withColumn("year", F.lit(7)), ["site", "year"], "one-to-one").collect()
    assert D.declared_join(left, right, ["site"], "many-to-many").count() == 1
    with pytest.raises(ValueError):
        D.declared_join(left, right, ["site"], "some-to-one")


def test_the_check_adds_no_exchange_to_a_shuffled_join(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(1000).select((F.col("id") % 10).alias("k"), "id")
        right = spark.range(10).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        count = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        pair = {"k": "k"}
        on = lambda r: left.join(r, "k", "left")
        assert count(on(D.once_per_key(right, ["k"]))) == count(on(right)) == 2
        assert D.declared_join(left, right, pair, "many-to-one").count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_fan_out(spark):
    a = frame(spark, "k string, x int", ("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 2))
    b = frame(spark, "k string, y int", ("a", 1), ("a", 2), ("a", 3), ("b", 1), ("b", 2), (None, 1), (None, 1))
    assert rows(D.fan_out(a, b, ["k"]), "k", "n_left", "n_right", "n_rows") == [("a", 2, 3, 6), (None, 2, 2, 4)]


def test_chunks_are_bounded_and_give_the_rows_back(spark):
    hot = [("hot", i, None if i % 50 == 0 else f"v{i}", "x") for i in range(3000)]
    same = [("same", 1, "v", "x")] * 2000
    other = [(f"k{i % 7}", i, "v", "x") for i in range(500)] + [(None, None, None, "x")] * 3
    df = spark.createDataFrame(hot + same + other, "key string, i int, v string, left_out string")
    nested = R.nest_chunks(df, ["key"], ["i", "v"], 64, bucket_rows=256)
    per = {r["key"]: r for r in nested.groupBy("key").agg(
        F.max(F.size("data")).alias("longest"), F.count("*").alias("chunks"), F.max("chunk").alias("last")).collect()}
    assert max(r["longest"] for r in per.values()) == 64
    assert per["hot"]["chunks"] == 47 and per["hot"]["last"] == 46 and per["same"]["longest"] == 1
    back = R.unnest_chunks(nested, ["key"])
    assert Counter(map(tuple, back.collect())) == Counter(r[:3] for r in hot + same + other)
    assert R.nest_chunks(df.limit(0), ["key"], ["i"]).count() == 0


def test_a_row_repeated_very_often_is_unrolled(spark):
    df = spark.range(150_001).select(F.lit("k").alias("key"), F.lit(1).alias("i"))
    nested = R.nest_chunks(df, ["key"], ["i"], 10)
    assert nested.select(F.size("data")).collect() == [(1,)]
    assert R.unnest_chunks(nested, ["key"]).count() == 150_001
