"""Community operators: rules, scales, totals, splits, metadata, merge."""

import random

import pytest
from helpers import approx, frame, rows
from pyspark.sql import functions as F

from gradientlab.operators import community as C
from gradientlab.operators import reshape as R
from gradientlab.operators.community import Rule

REC = "UniqueID string, SpeciesName string, Cover double"


def records(spark, seed=1, samples=40):
    rnd = random.Random(seed)
    data = []
    for i in range(samples):
        for j in range(rnd.randint(1, 9)):
            data.append((f"s{i}", f"sp{j}", None if rnd.random() < 0.05 else float(rnd.randint(0, 40))))
    return frame(spark, REC, *data)


def test_rules_first_match_and_relation(spark):
    df = frame(spark, "l string, o string, d string", ("c", "H", "L"), ("x", "H", "L"), ("x", "L", "H"), ("x", "L", "L"), (None, "Q", "L"))
    rules = [Rule("Control", label=("c",)), Rule("Warm", relation="down"), Rule("Cold", relation="up"), Rule("Local", relation="same")]
    got = C.assign_treatment(df, rules, label="l", origin="o", dest="d", ranks={"L": 1, "H": 2})
    assert [r.Treatment for r in got.collect()] == ["Control", "Warm", "Cold", "Local", None]


def test_decode_cover(spark):
    df = frame(spark, "c string", ("1",), ("10",), ("11",), ("x",), (None,))
    assert [r.Cover for r in C.decode_cover(df, C.SCALE_10, "c").collect()] == [0.5, 80.0, None, None, None]
    numbers = frame(spark, "c double", (1.0,), (2.5,), (0.0,), (11.0,), (10.0,), (None,))
    assert [r.Cover for r in C.decode_cover(numbers, C.SCALE_10, "c").collect()] == [0.5, 2.5, 0.0, 11.0, 80.0, None]
    texts = frame(spark, "c string", ("2.0",), ("2.5",), ("0",))
    assert [r.Cover for r in C.decode_cover(texts, C.SCALE_10, "c").collect()] == [1.0, None, None]
    plus = C.decode_cover(frame(spark, "c string", ("+",), ("12.5",), ("bad",)), C.SCALE_PLUS, "c", numeric_rest=True)
    assert [r.Cover for r in plus.collect()] == [0.5, 12.5, None]
    assert len(C.SCALE_10) == 10 and len(C.SCALE_11) == 11 and len(C.SCALE_13) == 13


def test_build_ids_chain(spark):
    df = C.build_ids(frame(spark, "a string, b int", ("x", 1), (None, 2)), {"p": ["a", "b"], "u": ["p", "b"]})
    assert rows(df, "u") == [("NA_2_2",), ("x_1_1",)]


def test_collapse(spark):
    df = frame(spark, REC, ("a", "x", 1.0), ("a", "x", 1.0), ("a", "x", 2.0), ("a", "y", None))
    assert rows(C.collapse_duplicates(df, ["UniqueID", "SpeciesName"]), "SpeciesName", "Cover") == [("x", 3.0), ("y", 0.0)]


def test_totals_equal_union_form(spark):
    """The closed form max(100, sum) equals appending the residual row and adding up."""
    df = records(spark).filter("Cover IS NOT NULL")
    union = C.residual_cover(df, ["UniqueID"]).groupBy("UniqueID").agg(F.sum("Cover").alias("t"))
    closed = C.sample_totals(df, ["UniqueID"]).select("UniqueID", F.col("Total_Cover").alias("t"))
    assert rows(union, "UniqueID", "t") == rows(closed, "UniqueID", "t")


def test_shares_add_up_to_one(spark):
    df = records(spark, 7).filter("Cover IS NOT NULL")
    rel = C.relative_cover(df, ["UniqueID"]).select("UniqueID", "Rel_Cover")
    both = rel.unionByName(C.residual_rows(df, ["UniqueID"]).select("UniqueID", "Rel_Cover"))
    for r in both.groupBy("UniqueID").agg(F.sum("Rel_Cover").alias("s")).collect():
        assert approx(r.s, 1.0)
    assert C.sample_totals(df, ["UniqueID"]).filter("Total_Cover < 100").count() == 0


def test_missing_cover_strict_or_not(spark):
    df = frame(spark, REC, ("a", "x", 30.0), ("a", "y", None), ("b", "x", None))
    loose = C.relative_cover(df, ["UniqueID"])
    assert rows(loose, "UniqueID", "SpeciesName", "Rel_Cover") == [("a", "x", 0.3), ("a", "y", None), ("b", "x", None)]
    strict = C.relative_cover(df, ["UniqueID"], strict=True)
    assert [r.Rel_Cover for r in strict.collect()] == [None, None, None]
    assert rows(C.residual_rows(df, ["UniqueID"]), "UniqueID", "Cover") == [("a", 70.0)]


def test_null_sample_keys_are_one_sample(spark):
    df = frame(spark, "UniqueID string, b string, SpeciesName string, Cover double", (None, "1", "x", 40.0), (None, "1", "y", 60.0))
    assert rows(C.relative_cover(df, residual=False), "SpeciesName", "Rel_Cover") == [("x", 0.4), ("y", 0.6)]


def test_zero_total(spark):
    df = frame(spark, REC, ("a", "x", 0.0))
    assert C.relative_cover(df, ["UniqueID"], residual=False).collect()[0].Rel_Cover is None


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_split_is_a_partition(spark, seed):
    df = records(spark, seed).filter("Cover > 0")
    comm, cover = C.split_community(df, ["sp1", "sp2"])
    assert comm.count() + cover.count() == df.count()
    assert comm.filter(F.col("SpeciesName").isin("sp1", "sp2")).count() == 0


def test_split_keeps_null_names_and_relabels(spark):
    df = frame(spark, REC, ("a", None, 1.0), ("a", "moss", 2.0), ("a", "x", 0.0))
    comm, cover = C.split_community(df, ["moss"], {"moss": "Moss"})
    assert rows(comm, "SpeciesName") == [(None,)] and rows(cover, "SpeciesName") == [("Moss",)]


def test_site_meta(spark):
    df = frame(spark, "destSiteID string, Year int", ("A", 2012), ("A", 2015), ("B", 2013))
    got = C.site_meta(df, {"A": (1000, 10.0, 46.0)}, "G", "Land", 2010, 0.25)
    assert got.columns == C.META_COLUMNS
    assert rows(got, "destSiteID", "Elevation", "YearMin", "YearMax", "YearRange") == [
        ("A", 1000.0, 2012, 2015, 5), ("B", None, 2013, 2013, 3)]


def test_union_casts_first(spark):
    a, b = frame(spark, "Year int, x string", (1, "q")), frame(spark, "Year string, y int", ("2", 5))
    got = C.union_tagged({"A": a, "B": b}, types={"Year": "int"})
    assert dict(got.dtypes)["Year"] == "int"
    assert rows(got, "Region", "Year", "x", "y") == [("A", 1, "q", None), ("B", 2, None, 5)]


def test_merge_drops_controls_keeps_missing_treatment(spark):
    comm = frame(
        spark, "Region string, destSiteID string, Treatment string, Year int, SpeciesName string, Cover double, Rel_Cover double",
        ("R", "s", "Warm", 1, "x", 1.0, 0.1), ("R", "s", "Cold", 1, "x", 1.0, 0.1), ("R", None, None, 1, "x", 1.0, 0.1),
        ("R", "s", "NettedControl", 1, "x", 1.0, 0.1), ("R", "t", "LocalControl", 1, "x", 1.0, 0.1),
    )
    meta = frame(spark, "Region string, destSiteID string, Elevation double", ("R", "s", 5.0), ("R", "s", 5.0), ("R", None, 9.0), ("Q", "t", 1.0))
    got = C.merge_community(comm, meta)
    assert got.columns == [*C.COMMUNITY_COLUMNS, "Elevation"]
    assert rows(got, "destSiteID", "Treatment", "Elevation") == [("s", "Warm", 5.0), ("t", "LocalControl", None), (None, None, 9.0)]


def test_unpivot_pivot_identity(spark):
    wide = frame(spark, "id int, a double, b double", (1, 1.0, None), (2, 3.0, 4.0))
    tall = R.gather(wide, ["id"], "k", "v")
    assert tall.count() == 4
    assert rows(R.spread(tall, ["id"], "k", "v", ["a", "b"]), "id", "a", "b") == rows(wide, "id", "a", "b")
