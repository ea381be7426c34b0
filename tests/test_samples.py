"""Surveys stored by sample: the same totals, without an exchange of records."""

import re

import pytest
from helpers import frame, rows
from pyspark.sql import functions as F

from gradientlab.operators import community as C
from gradientlab.operators import samples as S


@pytest.fixture
def no_broadcast(spark):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    yield spark
    for n, v in old.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def survey(spark, n=9_000):
    """A third of all rows are one sample, and those are equal in every column."""
    hot = F.col("id") % 3 == 0
    return spark.range(0, n, 1, 6).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 97).cast("string"))).alias("UniqueID"),
        F.when(hot, "Poa").otherwise(F.concat(F.lit("sp"), (F.col("id") % 31).cast("string"))).alias("SpeciesName"),
        F.when(hot, 1.0).when(F.col("id") % 50 == 1, None).otherwise((F.col("id") % 7).cast("double")).alias("Cover"),
    )


def test_stored_cover_equals_relative_cover(no_broadcast):
    df = survey(no_broadcast)
    for residual in (False, True):
        store = S.store_samples(df, f"cover_{residual}".lower(), ["UniqueID"], buckets=4, hot_rows=1_000, salts=8)
        got = S.stored_relative_cover(store, no_broadcast, residual=residual)
        columns = ["UniqueID", "SpeciesName", "Cover", "Total_Cover", "Rel_Cover"]
        assert got.columns == columns
        assert rows(got, *columns) == rows(C.relative_cover(df, ["UniqueID"], residual=residual), *columns)
        store.drop(no_broadcast)


def test_no_exchange_between_scan_and_total(no_broadcast):
    store = S.store_samples(survey(no_broadcast), "plain_survey", ["UniqueID"], buckets=4, hot_rows=1_000, salts=8)
    ordinary, hot = S.stored_totals(store, no_broadcast)
    assert "Exchange" not in plan(ordinary)
    other = store.ordinary(no_broadcast).groupBy(S.SAMPLE).agg(F.count_distinct("SpeciesName").alias("species"))
    assert "Exchange" not in plan(ordinary.join(other, S.SAMPLE))
    text = plan(hot)  # hot samples: one row per salt moves, after the sum of the salt's records
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1 and text.count("HashAggregate") == 4
    text = plan(S.stored_relative_cover(store, no_broadcast))
    moved = re.findall(r"Exchange hashpartitioning\(([^)]*)\).*?\n(.*)", text)
    assert all("FileScan" not in below and "Filter" not in below for _, below in moved), text
    assert len(moved) == 2  # the hot samples' parts, and their totals to the salts
    store.drop(no_broadcast)


def test_a_hot_sample_of_equal_rows_is_spread(spark):
    store = S.store_samples(survey(spark), "spread_survey", ["UniqueID"], buckets=4, hot_rows=1_000, salts=8)
    by_salt = [r.n for r in store.hot(spark).groupBy(S.SALT).agg(F.count("*").alias("n")).collect()]
    assert sum(by_salt) == 3_000 and len(by_salt) == 8 and max(by_salt) < 600
    assert store.ordinary(spark).filter("UniqueID = 'hot'").isEmpty() and store.records(spark).count() == 9_000
    store.drop(spark)


def test_missing_keys_empty_and_clashing(spark):
    df = frame(spark, "a string, b int, Cover double", (None, 1, 1.0), ("null", 1, 2.0), ("x", None, None), ("x", None, 3.0), (None, 1, 4.0))
    store = S.store_samples(df, "odd_survey", ["a", "b"], buckets=2, hot_rows=1, salts=2)
    got = S.stored_relative_cover(store, spark, residual=False)
    assert rows(got, "a", "b", "Cover", "Total_Cover") == rows(C.relative_cover(df, ["a", "b"], residual=False), "a", "b", "Cover", "Total_Cover")
    store = S.store_samples(df.limit(0), "odd_survey", ["a", "b"], buckets=2)
    assert S.stored_relative_cover(store, spark).count() == 0
    store.drop(spark)
    with pytest.raises(ValueError, match="sample_id"):
        S.store_samples(df.withColumn("sample_id", F.lit(1)), "clash", ["a"])
