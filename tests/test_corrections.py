"""Corrections, roll-ups and reshaping."""

import pytest

from helpers import frame, rows
from pyspark.sql import functions as F

from gradientlab.operators import corrections as K
from gradientlab.operators import quality as Q
from gradientlab.operators import reshape as R


def test_effort(spark):
    df = frame(spark, "notbad int, cover double", (25, 40.0), (20, 40.0), (10, 40.0), (11, 79.0), (12, None))
    assert [r.cover for r in K.correct_effort(df).collect()] == [40.0, 50.0, 80.0, None]


def test_observer_and_flagged(spark):
    df = frame(spark, "turfID string, year int, recorder string, cover double", ("a", 1, "PM", 10.0), ("a", 2, None, 10.0), ("b", 1, "S", 10.0))
    got = K.correct_observer(df, {"PM": 1.2})
    assert rows(got, "recorder", "cover") == [("PM", 12.0), ("S", 10.0), ("unknown botanist", 10.0)]
    totals = frame(spark, "turfID string, year int, s double, v double", ("b", 1, 10.0, 10.0), ("a", 1, 30.0, 10.0), ("a", 2, 1.0, None))
    low = K.low_samples(totals, ["turfID", "year"], "s", "v", 1.35)
    assert rows(K.scale_flagged(got, low, ["turfID", "year"], 1.3), "turfID", "cover") == [("a", 10.0), ("a", 12.0), ("b", 13.0)]


def test_flag_members_null_key(spark):
    df = frame(spark, "a string, b int", ("x", 1), (None, 1), ("y", 1))
    members = frame(spark, "a string, b int", ("x", 1), (None, 1), ("x", 1))
    assert rows(K.flag_members(df, ["a", "b"], members, "hit"), "a", "hit") == [("x", True), ("y", False), (None, True)]


def test_point_fixes(spark):
    df = frame(spark, "turfID string, year int, species string, cover double", ("t", 1, "a", 10.0), ("t", 1, "b", 10.0), ("t", 2, "a", 9.0), ("u", 2, "a", 9.0))
    fixes = [K.Fix("t", 1, "set", 25, "a"), K.Fix("t", 2, "times", 2 / 3)]
    assert rows(K.apply_point_fixes(df, fixes), "turfID", "species", "cover") == [
        ("t", "a", 25.0), ("t", "a", 6.0), ("t", "b", 10.0), ("u", "a", 9.0)]


def test_pool_observers(spark):
    df = frame(spark, "p int, a string, b string", (1, "1,5", "NF"), (1, "2-5", "4"), (2, "§", "NF"), (3, "x", "2"))
    got = K.pool_observers(df, ["p"], ["a", "b"])
    assert [(r.p, round(r.Cover, 6)) for r in got.orderBy("p").collect()] == [(1, round(8 / 3, 6)), (1, round(8 / 3, 6)), (3, 2.0)]


def test_pin_counts(spark):
    wide = frame(spark, "t int, `Poa a` double, `Poa a...12` double, `X FOCAL` double, Gap double", (1, 1.0, 2.0, 9.0, None), (1, 1.0, 0.0, 9.0, 3.0))
    assert rows(K.pin_counts_wide(wide, ["t"]), "SpeciesName", "cover") == [("Poa a", 4.0)]
    assert rows(K.pin_counts_wide(wide, ["t"], strict=False), "SpeciesName", "cover") == [("Gap", 3.0), ("Poa a", 4.0)]
    tall = frame(spark, "t int, sp string, p1 double, p2 double", (1, "Poa", 1.0, None), (1, "Poa", 1.0, 1.0), (1, "NA", 2.0, 2.0), (1, "FOCAL x", 9.0, 9.0), (1, None, 1.0, 1.0))
    assert rows(K.pin_counts_rows(tall, ["t"], "sp", ["p1", "p2"]), "SpeciesName", "cover") == [("Other", 4.0), ("Poa", 3.0), (None, 2.0)]


def test_retro_correct_keeps_fan_out(spark):
    df = frame(spark, "k int, SpeciesName string, c int", (1, "a", 1), (1, "b", 2), (2, "a", 3))
    pairs = frame(spark, "k int, o string, n string", (1, "a", "x"), (1, "a", "x"), (1, "b", "y"), (1, "b", "z"), (2, None, "q"))
    assert rows(K.retro_correct(df, pairs, ["k"], "o", "n"), "k", "SpeciesName") == [(1, "x"), (1, "y"), (1, "z"), (2, "a")]


def test_rollups(spark):
    q = frame(spark, "p int, v double, f boolean", (1, 1.0, False), (1, None, False), (2, 2.0, False), (2, 5.0, True))
    assert rows(K.quadrat_rollup(q, ["p"], "f", "v"), "p", "cover") == [(1, None), (2, 2.0)]
    b = frame(spark, "p int, bm string, treatment string", (1, "1,5", "ctrl"), (1, "x", "ctrl"), (1, "9", "wet"), (2, "x", "ctrl"))
    assert rows(K.biomass_rollup(b, ["p"]), "p", "biomass") == [(1, 1.5), (2, 0.0)]


def test_greenness_and_stems(spark):
    g = frame(spark, "p int, VascCover double", (1, 35.0))
    assert rows(K.greenness(g, ["p"]), "CoverClass", "OtherCover", "Rel_OtherCover") == [("OtherCover", 65.0, 100.0), ("VascCover", 35.0, 100.0)]
    s = frame(spark, "p int, sp string, Individuals double", (1, "a", 3.0), (1, "b", 1.0), (1, "c", None), (2, "a", None))
    assert rows(K.stem_relative(s, ["p"]), "p", "sp", "Rel_Cover") == [(1, "a", 0.75), (1, "b", 0.25)]


def test_sequence_across_buckets(spark):
    df = spark.range(0, 5000).select(F.col("id").alias("row_no"), F.when(F.col("id") % 3 == 0, "hot").otherwise("x").alias("g"))
    got = R.sequence_in_group(df, ["g"], "row_no", "k", bucket_rows=100)
    bad = got.filter((F.col("g") == "hot") & (F.col("k") != F.col("row_no") / 3 + 1)).count()
    assert bad == 0
    assert got.groupBy("g").agg(F.max("k").alias("m"), F.count("k").alias("n"), F.countDistinct("k").alias("d")).filter("m <> n OR d <> n").count() == 0
    hashed = R.sequence_by_hash(df, ["g"], ["row_no"], "k", 16)  # rows a bucket
    assert hashed.groupBy("g").agg(F.max("k").alias("m"), F.count("k").alias("n"), F.countDistinct("k").alias("d")).filter("m <> n OR d <> n").count() == 0


def test_first_per_key(spark):
    df = frame(spark, "k string, row_no int, v string", ("a", 2, "late"), ("a", 1, None), (None, 5, "n"))
    assert rows(R.first_per_key(df, ["k"], "row_no"), "k", "row_no", "v") == [("a", 1, None), (None, 5, "n")]


def test_separate_pads_and_drops(spark):
    df = frame(spark, "x string", ("a_b_c",), ("a",))
    assert rows(R.separate(df, "x", ["p", "q"], "_"), "p", "q") == [("a", "b"), ("a", None)]
    assert rows(R.extract_columns(df, "x", ["p", "q"], "(.*)_([^_]+)$"), "p", "q") == [("a_b", "c"), (None, None)]


def test_columns(spark):
    df = frame(spark, "id int, a_1 double, a_2 string, b double", (1, 1.0, "x", 2.0))
    assert R.column_range(df, "a_1", "b") == ["a_1", "a_2", "b"]
    assert R.columns_where(df, starts="a_", types=["double"]) == ["a_1"]
    assert rows(R.sum_numeric(df, ["id"]), "id", "a_1", "b") == [(1, 1.0, 2.0)]
    stacked = R.concat_columns(frame(spark, "c1 string, n1 string, c2 string, n2 string", ("a", "A", "b", None)), [{"code": "c1", "taxa": "n1"}, {"code": "c2", "taxa": "n2"}])
    assert rows(stacked, "code", "taxa") == [("a", "A"), ("b", None)]


def test_nest_roundtrip(spark):
    df = frame(spark, "p int, s string, c double", (1, "b", 2.0), (1, "a", 1.0), (2, "a", 3.0))
    nested = R.nest_rows(df, ["p"], ["s", "c"])
    assert [x.s for x in nested.filter("p = 1").collect()[0].data] == ["a", "b"]
    assert rows(R.unnest_rows(nested, ["p"]), "p", "s", "c") == rows(df, "p", "s", "c")


def test_slices_sets_tables(spark):
    df = spark.range(1, 41).select(F.col("id").alias("row_no"))
    got = R.slice_rows(df, {"LOW": (1, 15), "HIGH": (20, 36)})
    assert got.filter("block = 'LOW'").count() == 15 and got.filter("block = 'HIGH'").count() == 17
    a, b = frame(spark, "n string", ("x",), ("x",), (None,), ("y",)), frame(spark, "n string", ("x",), (None,))
    assert rows(R.set_difference(a, b, "n"), "n") == [("y",)]
    t = frame(spark, "r string, c string", ("p", "u"), ("p", "u"), ("q", "v"))
    assert rows(R.crosstab(t, ["r"], "c", ["u", "v"]), "r", "u", "v") == [("p", 2, 0), ("q", 0, 1)]


def test_audits(spark):
    df = frame(spark, "Region string, destSiteID string, Treatment string, Rel_Cover double", ("R", "a", None, 0.5), ("R", None, "Warm", None))
    meta = frame(spark, "Region string, destSiteID string", ("R", "a"), ("R", "z"))
    assert rows(Q.merge_audit(df, meta), "audit", "n") == [
        ("meta_without_data", 1), ("null_rel_cover", 1), ("null_treatment", 1), ("sites_without_meta", 1)]
    assert dict(rows(Q.null_census(df), "column", "n_null")) == {"Region": 0, "destSiteID": 1, "Treatment": 1, "Rel_Cover": 1}
    assert rows(Q.row_growth([("a", df), ("b", meta.union(meta))]), "step", "n") == [(0, 2), (1, 4)]
    assert rows(Q.duplicate_keys(meta.union(meta.limit(1)), ["destSiteID"]), "n") == [(2,)]


def test_tables_refuse_what_they_would_lose(spark):
    df = frame(spark, "id int, k string, v double", (1, "a", 1.0), (1, "a", 2.0))
    with pytest.raises(Exception, match="several rows for one cell"):
        R.spread(df, ["id"], "k", "v", ["a", "b"]).collect()
    with pytest.raises(Exception, match="level of k not listed"):
        R.crosstab(df, ["id"], "k", ["b"]).collect()
    assert rows(R.crosstab(frame(spark, "id int, k string", (1, "a"), (1, None)), ["id"], "k", ["a"]), "id", "a") == [(1, 1)]


def test_two_level_offsets(spark):
    df = spark.range(3000).selectExpr("id AS row_no", "id % 2 AS g")
    got = R._sequence(df, ["g"], R.F.floor(R.F.col("row_no") / 10), ["row_no"], "k", span=7)
    assert all(r.k == r.row_no // 2 + 1 for r in got.collect())
