"""Traits and climate."""

import math
import random

from helpers import approx, frame, one, rows
from pyspark.sql import functions as F

from gradientlab.operators import climate as Cl
from gradientlab.operators import traits as Tr


def test_mean_of_means_is_not_the_plain_mean(spark):
    df = frame(
        spark, "Region string, destSiteID string, SpeciesName string, Trait string, PlantID string, Value double",
        ("R", "s", "x", "t", "p1", 1.0), ("R", "s", "x", "t", "p1", 3.0), ("R", "s", "x", "t", "p2", 8.0), ("R", "s", "x", "t", None, None),
    )
    assert rows(Tr.mean_of_means(df), "siteValue", "nRep") == [(5.0, 3)]


def test_gap_fill(spark):
    means = frame(spark, "Region string, destSiteID string, SpeciesName string, Trait string, siteValue double", ("R", "s", "x", "SLA_cm2_g", 5.0), ("R", "s", "unlisted", "SLA_cm2_g", 6.0), ("R", "s", "x", "Odd", 1.0))
    db = frame(
        spark, "Region string, destSiteID string, accepted_name string, leaf_area double, leaf_C double, leaf_N double, leaf_P double, plant_height double, seed_mass double, SLA double, stem_density double",
        ("R", "s", "x", 1.0, None, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0), ("R", "s", None, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0), ("R", "s", "x", 9.0, None, None, None, None, None, 7.0, None),
    )
    got = Tr.gapfill_traits(Tr.spread_traits(means), db)
    assert rows(got, "SpeciesName", "SLA_cm2_g", "Leaf_Area_cm2", "C_percent", "Seed_Mass") == [
        ("x", 5.0, 1.0, None, 6.0), ("x", 5.0, 9.0, None, None), (None, 7.0, 1.0, 2.0, 6.0)]


def test_derived(spark):
    df = frame(spark, "Dry_Mass_g double, Wet_Mass_g double, Leaf_Area_cm2 double", (1.0, 4.0, 8.0), (0.0, 0.0, 1.0), (None, 1.0, 1.0))
    got = Tr.derive_traits(df, {"LDMC": Tr.ldmc(), "SLA": Tr.sla()})
    assert [(r.LDMC, r.SLA) for r in got.collect()] == [(0.25, 8.0), (None, None), (None, None)]


def test_tidy_uses_earlier_traits_and_drops_missing(spark):
    df = frame(spark, "sp string, w string, d string", ("x", "2 g", "1"), ("x", "n/a", "3"), (None, "1", "1"))
    got = Tr.tidy_traits(df, {"sp": "SpeciesName"}, {"W": F.col("w").try_cast("double"), "D": F.col("d").try_cast("double"), "R": F.col("D") * 2}, ["SpeciesName"], {"Country": "L"}, required=["SpeciesName"])
    assert rows(got, "Country", "Trait", "Value") == [("L", "D", 1.0), ("L", "D", 3.0), ("L", "R", 2.0), ("L", "R", 6.0)]


def test_union_of_trait_tables(spark):
    a = frame(spark, "destSiteID string, Individual_number int, Value double", ("s", 1, 1.0))
    b = frame(spark, "destSiteID string, Individual_number string, Value double, Year double", ("t", "x", 2.0, 2018.0))
    got = Tr.merge_site_traits({"A": a, "B": b})
    assert rows(got, "Region", "Individual_number", "Year") == [("A", "1", None), ("B", "x", 2018)]


def test_seasons(spark):
    data = [("s", m, v, float(m)) for m in range(1, 13) for v in ("tavg", "vapr", "prec")]
    got = Cl.seasonal_stats(frame(spark, "site string, month int, var string, value double", *data), ["site"])
    r = got.collect()[0]
    assert (r.T_ann, r.T_sum, r.P_ann, r.P_sum, r.P_win) == (6.5, 7.0, 78.0, 39.0, 39.0)
    assert approx(r.T_win, 6.5) and approx(r.V_sum, 6.5)
    cor = Cl.lapse_correct(got.withColumns({"Elevation_st": F.lit(1100.0), "Elevation": F.lit(1000.0)})).collect()[0]
    assert approx(cor.T_ann_cor, 6.5 + 0.98)


def test_monthly_and_summer(spark):
    df = frame(spark, "s string, `2000_Jun` double, `2001_Jun` double, `2001_Dec` double", ("a", 1.0, 2.0, 3.0))
    tall = Cl.monthly_long(df, ["s"])
    assert rows(tall, "year", "month", "value") == [(2001, "Dec", 3.0), (2001, "Jun", 2.0)]
    grid = frame(spark, "s string, year int, month string, var string, value double", ("a", 2001, "Jun", "tmp", 10.0), ("a", 2001, "Jul", "tmp", 14.0), ("a", 2001, "Jan", "tmp", 99.0), ("a", 2001, "Jun", "pre", 5.0), ("a", 2001, "Jul", "pre", None), ("a", 2002, "Jun", "tmp", 1.0), ("a", 2003, "Jun", "pre", 1.0))
    assert rows(Cl.summer_climate(grid, ["s"]), "year", "avetemp", "sumprec") == [(2001, 12.0, 5.0), (2002, 1.0, None)]


def test_grid_sampling(spark):
    sites = frame(spark, "site string, Longitude double, Latitude double", ("a", 7.06, 46.21), ("edge", 7.5, 46.5), ("out", 120.0, 46.0), ("none", None, 46.0))
    grid = frame(spark, "lon double, lat double, value double", (7.25, 46.25, 1.0), (7.75, 46.25, 2.0), (7.75, 46.75, 3.0))
    got = Cl.sample_grid(sites, grid, -180.0, 90.0, 0.5)
    # a point on a cell corner belongs to the cell right of and below it
    assert rows(got, "site", "value") == [("a", 1.0), ("edge", 2.0), ("none", None), ("out", None)]


def test_tolerance_equals_brute_force(spark):
    rnd = random.Random(4)
    s = [(i, rnd.uniform(-2, 2), rnd.uniform(-2, 2)) for i in range(60)]
    g = [(i, rnd.uniform(-2, 2), rnd.uniform(-2, 2)) for i in range(200)]
    got = Cl.tolerance_match(frame(spark, "i int, Longitude double, Latitude double", *s), frame(spark, "j int, lon double, lat double", *g), 0.2)
    want = {(a[0], b[0]) for a in s for b in g if abs(a[1] - b[1]) < 0.2 and abs(a[2] - b[2]) < 0.2}
    assert {tuple(r) for r in got.select("i", "j").collect()} == want
    assert got.count() == len(want)


def test_stations_equal_brute_force(spark):
    rnd = random.Random(4)
    s = [(i, rnd.choice([-179.9, 179.9, 10.0, rnd.uniform(-180, 180)]), rnd.choice([89.5, -89.5, 46.0, rnd.uniform(-90, 90)])) for i in range(60)]
    t = [(i, rnd.choice([-179.5, 179.5, 11.0, rnd.uniform(-180, 180)]), rnd.choice([89.0, -89.0, 46.5, rnd.uniform(-90, 90)])) for i in range(150)]

    def km(a, b):
        p, q = math.radians(a[2]), math.radians(b[2])
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
        return 2 * Cl.EARTH_KM * math.asin(min(1, math.sqrt(h)))

    got = Cl.stations_within(frame(spark, "i int, Longitude double, Latitude double", *s), frame(spark, "j int, st_lon double, st_lat double", *t), 300.0)
    want = {(a[0], b[0]) for a in s for b in t if km(a, b) <= 300.0}
    assert want and {tuple(r) for r in got.select("i", "j").collect()} == want
    assert got.count() == len(want)


def test_site_coords(spark):
    df = frame(spark, "gradient string, site string, lat string, long string, elev string, year1 int, yearn int", ("g", "s", "1", "2", "100", 2010, 2014), ("g", "s", "3", "x", None, 2012, 2016))
    assert one(Cl.site_coords(df), "site = 's'", "lat", "long", "elev", "yearn", "Yearrange") == (2.0, 2.0, 100.0, 2015.0, 4.0)
