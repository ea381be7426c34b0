"""Every regional profile on its hand-made raw tables, and the merged products."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from helpers import approx, frame, one, rows
from pyspark.sql import functions as F

import fixtures
from gradientlab.operators import community as C
from gradientlab.operators import quality as Q
from gradientlab.operators import taxonomy as T
from gradientlab.plans import products as P
from gradientlab.plans.profile import build_bundle
from gradientlab.plans.regions import NORWAY_GRADIENTS, PROFILES


@pytest.fixture(scope="module")
def bundles(spark):
    raw = {region: make(spark) for region, make in fixtures.REGIONS.items()}
    built = P.build_bundles(raw)
    with ThreadPoolExecutor(8) as pool:
        staged = dict(zip(built, pool.map(lambda r: P.stage_bundle(r, built[r]), built)))
    return staged


# region -> {(UniqueID, SpeciesName): (Treatment, Rel_Cover)}; None = no row of that species
EXPECTED = {
    "NO_Ulvhaugen": {
        ("2011_Ulvhaugen_Ulvhaugen_U1_U1_t1", "Agr.cap"): ("LocalControl", 0.48),
        ("2011_Ulvhaugen_Alrust_A1_U1_t2", "Agr.cap"): ("Warm", 0.8),
        ("2011_Ulvhaugen_Alrust_A1_U1_111 TT2 137", "Agr.cap"): ("Warm", 0.25),
    },
    "NO_Lavisdalen": {("2011_Lavisdalen_Lavisdalen_L1_L1_t5", "Agr.cap"): ("LocalControl", 0.65)},
    "CH_Lavey": {
        ("2017_RIO_CRE_T1", "Poa badensis"): ("Warm", 0.625), ("2018_RIO_CRE_T1", "Poa badensis"): ("Warm", 3 / 7),
        ("2019_RIO_MAR_T4", "Poa alpina"): ("Warm", 0.5 / 41.5), ("2019_RIO_RIO_T3", "Carex"): ("LocalControl", 0.1 / 97.6),
    },
    "CH_Calanda": {
        ("2013_Pea_Cal_p1", "Poa alpina"): ("Warm", 0.15), ("2013_Pea_Pea_p2", "Poa alpina"): ("LocalControl", 0.6),
    },
    "CH_Calanda2": {
        ("2017_Cal_Nes_n1", "Poa alpina"): ("Warm", 0.4), ("2017_NA_Nes_n5", "Poa alpina"): (None, 1.0),
    },
    "US_Colorado": {
        ("2018_pf_um_1_um1xxxw1yypf2zz", "Carex"): ("Warm", 0.25), ("2018_mo_mo_3_mo3xxxnuyymo3zz", "Poa"): ("NettedControl", 0.1),
    },
    "US_Montana": {("2014_High_Low_2", "Poa"): ("Warm", 1.0), ("2014_Low_Low_1", "Poa"): ("LocalControl", 0.3)},
    "US_Arizona": {("2014_MC_MC_MC2", "POPR"): ("LocalControl", 0.75)},
    "CN_Gongga": {
        ("2013_H_A_A1_Warm_2_H1-1", "Potentilla stenophylla"): ("Warm", 0.3), ("2013_A_A_A1_LocalControl_2_A1-O", "Poa alpina"): ("LocalControl", 1.0),
    },
    "CN_Damxung": {("2014_HIGH_LOW_b", "Kobresia"): ("Warm", 0.035), ("2014_LOW_HIGH_d", "Kobresia"): (None, 0.005)},
    "IN_Kashmir": {("LOW_LOW_1_2014", "Fragaria sp."): ("LocalControl", 1.0), ("LOW_LOW_1_2015", "Fragaria sp."): ("LocalControl", 0.08)},
    "CN_Heibei": {("2008_3800_3200_2", "Stipa"): ("Warm", 70 / 130), ("2008_3200_3200_1", "Stipa"): ("LocalControl", 0.25)},
    "DE_Grainau": {("2014_LOW_LOW_p", "Poa"): ("LocalControl", 0.865)},
    "DE_Susalps": {("2017_EB_BT_7", "Poa"): ("Warm", 0.5)},
    "DE_TransAlps": {("2018_BT_SP_9", "Poa"): ("Cold", 1.0)},
    "FR_AlpeHuez": {("2014_HIGH_LOW_a", "Poa alpina"): ("Warm", 0.125), ("2014_HIGH_HIGH_c", "Carex"): ("LocalControl", 0.55)},
    "SE_Abisko": {("2013_Mid_Mid_12", "Bet nan"): ("LocalControl", 0.75), ("2013_Low_High_13", "Emp nig"): ("Cold", 0.03)},
    "FR_Lautaret": {("2018_G_L_01", "Carex sempervirens"): ("Warm", 0.06), ("2022_G_L_03", "Pilosella sp."): ("Warm", 0.12), ("2018_L_G_02", "Poa sp."): ("Cold", 0.04)},
    "IT_MatschMazia1": {("High_Low_B_2", "Carex x"): ("Warm", 70 / 130), ("High_High_C_3", "Poa alpina"): ("LocalControl", 0.2)},
    "IT_MatschMazia2": {("Low_Low_A_1", "Poa alpina"): ("LocalControl", 0.3), ("High_High_C_3", "Carex x"): ("LocalControl", 0.05)},
}


def test_all_regions_have_a_profile():
    assert len(PROFILES) == 22 and set(PROFILES) == set(fixtures.REGIONS)
    assert sum(len(v) for v in NORWAY_GRADIENTS.values()) == 12


@pytest.mark.parametrize("region", list(EXPECTED))
def test_region_community(bundles, region):
    got = {(r.UniqueID, r.SpeciesName): (r.Treatment, r.Rel_Cover) for r in bundles[region].community.collect()}
    for key, (treatment, rel) in EXPECTED[region].items():
        assert got[key][0] == treatment and approx(got[key][1], rel), (key, got[key])
    assert not {s for _, s in got} & set(PROFILES[region].classes)


def test_cover_classes(bundles):
    assert one(bundles["CH_Lavey"].cover, "UniqueID = '2017_RIO_CRE_T1' AND CoverClass = 'Bareground'", "OtherCover", "Rel_OtherCover") == (3.0, 0.375)
    assert one(bundles["US_Colorado"].cover, "destPlotID = 'um1xxxw1yypf2zz' AND CoverClass = 'Bareground'", "OtherCover") == 90.0
    assert one(bundles["CN_Damxung"].cover, "UniqueID = '2014_LOW_LOW_a' AND CoverClass = 'Other'", "OtherCover") == 12.0
    assert rows(bundles["US_Arizona"].cover, "CoverClass", "OtherCover") == [("OtherCover", 65.0), ("VascCover", 35.0)]
    assert one(bundles["NO_Ulvhaugen"].cover, "destSiteID = 'Alrust' AND OtherCover = 20", "CoverClass") == "Other"


def test_metadata(bundles):
    assert one(bundles["CH_Calanda"].meta, "destSiteID = 'Cal'", "Elevation", "YearRange", "Country") == (2000.0, 1, "Switzerland")
    assert one(bundles["NO_Ulvhaugen"].meta, "destSiteID = 'Alrust'", "Elevation", "YearRange", "PlotSize_m2") == (789.0, 8, 0.0625)
    for b in bundles.values():
        assert b.meta.columns == C.META_COLUMNS


def test_traits(bundles):
    have = {r for r, b in bundles.items() if b.trait is not None}
    assert have == {"NO_Ulvhaugen", "NO_Lavisdalen", "NO_Gudmedalen", "NO_Skjellingahaugen", "CH_Calanda", "US_Colorado",
                    "CN_Gongga", "FR_AlpeHuez", "FR_Lautaret", "IT_MatschMazia1", "IT_MatschMazia2"}
    calanda = bundles["CH_Calanda"].trait
    assert one(calanda, "Trait = 'Wet_Mass_g'", "Value") == 0.123
    assert one(calanda, "Trait = 'Leaf_Area_cm2'", "Value") == 10.5
    assert one(calanda, "Trait = 'Plant_Veg_Height_cm' AND destSiteID = 'Pea'", "Value") == 12.0
    assert rows(bundles["US_Colorado"].trait.filter("destPlotID IS NULL"), "destSiteID", "Treatment", "Trait") == [
        ("mo", "Control", "Plant_Veg_Height_cm"), ("mo", "Control", "Wet_Mass_g")]
    assert rows(bundles["FR_AlpeHuez"].trait, "destSiteID", "Value") == [("HIGH", 3.0), ("LOW", 5.0), ("LOW", 7.5)]
    assert one(bundles["FR_Lautaret"].trait, "Trait = 'N_percent'", "Value", "Treatment") == (2.5, "Warm")
    assert one(bundles["IT_MatschMazia1"].trait, "Trait = 'CN_ratio'", "Value") == 15.0
    assert rows(bundles["IT_MatschMazia2"].trait.select("destSiteID").distinct(), "destSiteID") == [("High",)]
    assert bundles["IT_MatschMazia2"].trait.filter("Trait = 'CN_ratio'").count() == 0
    assert {r[0] for r in rows(bundles["CN_Gongga"].trait, "Gradient")} == {"CN_Gongga"}


def test_compat_mode(spark):
    raw = fixtures.damxung(spark)
    strict = build_bundle(PROFILES["CN_Damxung"], raw, compat=True).community
    assert one(strict, "UniqueID = '2014_HIGH_LOW_b'", "Rel_Cover") is None
    italy = build_bundle(PROFILES["IT_MatschMazia1"], fixtures.matsch1(spark), compat=True).cover
    assert one(italy, "UniqueID = 'Low_Low_A_1'", "OtherCover") == 130.0


def test_staged_records_give_the_same(spark):
    raw = fixtures.heibei(spark)
    a, b = build_bundle(PROFILES["CN_Heibei"], raw), build_bundle(PROFILES["CN_Heibei"], raw, stage=True)
    assert rows(a.community, *a.community.columns) == rows(b.community, *a.community.columns)


def test_merged_community(bundles):
    dat = P.dat(bundles).cache()
    assert dat.columns == [*C.COMMUNITY_COLUMNS, "Elevation"]
    assert dat.filter(F.col("Treatment").isin("Cold", "Control", "NettedControl")).count() == 0
    assert one(dat, "UniqueID = '2014_HIGH_LOW_a'", "Region", "Elevation") == ("FR_AlpeHuez", 1481.0)
    assert one(dat, "UniqueID = '2011_Ulvhaugen_Alrust_A1_U1_t2'", "Elevation", "turfID") == (789.0, "t2")
    assert dat.filter("Region = 'US_Arizona' AND Cover IS NULL AND Rel_Cover IS NOT NULL").count() == 3
    # looking elevations up in the metadata tables gives the same
    by_meta = C.merge_community(P.all_communities(bundles), P.all_meta(bundles))
    assert rows(dat, *dat.columns) == rows(by_meta, *dat.columns)
    audit = dict(rows(Q.merge_audit(dat, P.all_meta(bundles)), "audit", "n"))
    assert audit["sites_without_meta"] == 0 and audit["null_rel_cover"] == 0
    dat.unpersist()


def test_taxonomy_and_traits_end_to_end(spark, bundles):
    norway = T.norway_codebook(fixtures.norway(spark)["taxon"])
    arizona = T.arizona_codebook(fixtures.arizona(spark)["species_list"])
    backbone = frame(
        spark, "gni_uuid string, matched_name string", ("u1", "Poa alpina"), ("u2", "Agrostis capillaris"),
        ("u3", "Achillea millefolium"), ("u4", "Nardus strictus"), ("u5", "Stipa"),
    )
    cleaned = P.cleaned_species(bundles, [(T.NORWAY_REGIONS, norway), (["US_Arizona"], arizona)], backbone).cache()
    get = lambda cond, *c: one(cleaned, cond, *c)
    assert get("Region = 'NO_Lavisdalen'", "SpeciesName", "original_name", "gni_uuid") == ("Agr.cap", "Agrostis capillaris", "u2")
    assert get("Region = 'US_Arizona' AND SpeciesName = 'ACMI' AND destSiteID = 'MC'", "matched_name", "score") == ("Achillea millefolium", 1.0)
    assert get("Region = 'CH_Calanda' AND SpeciesName = 'Nardus stricta'", "matched_name") == "Nardus strictus"
    assert get("Region = 'CN_Gongga' AND SpeciesName = 'Potentilla stenophylla'", "submitted_name").startswith("CN_Gongga_NID_")
    labels = [r[0] for r in rows(cleaned.filter("gni_uuid IS NULL"), "submitted_name")]
    assert len(labels) == len(set(labels))
    species = frame(spark, "species_row int, gni_uuid string, accepted_name string, submitted_name string, genus string", (1, "u1", "Poa alpina", "Poa alpina", "Poa"), (2, "zz", "Carex nigra", "Carex nigra", "Carex"))
    categorical = frame(spark, "species_row int, growth string", (1, "graminoid"), (2, "sedge"))
    numeric = frame(spark, "species_row int, leaf_area double, leaf_C double, leaf_N double, leaf_P double, plant_height double, seed_mass double, SLA double, stem_density double", (1, 3.0, 44.0, 2.2, 0.2, 15.0, 0.3, 180.0, 0.5), (2, 9.0, 45.0, 1.9, 0.1, 30.0, 0.9, 150.0, 0.4))
    traits = P.all_traits(bundles, cleaned, species, categorical, numeric)
    r = traits.filter("Region = 'CH_Calanda' AND destSiteID = 'Pea' AND SpeciesName = 'Poa alpina'").collect()[0]
    assert (r.Leaf_Area_cm2, r.SLA_cm2_g, r.C_percent, r.P_percent, r.growth) == (10.5, 210.0, 44.0, 0.2, "graminoid")
    carex = traits.filter("original_name = 'Carex curvula'").collect()[0]
    assert carex.try_name == "Carex nigra" and carex.Leaf_Area_cm2 == 9.0
    assert traits.count() == cleaned.count()
    cleaned.unpersist()


def test_site_climate(spark, bundles):
    meta = bundles["CH_Calanda"].meta
    data = [(9.25, 46.75, m, v, x) for m in range(1, 13) for v, x in (("tavg", float(m)), ("vapr", 1.0), ("prec", 10.0))]
    grid = frame(spark, "lon double, lat double, month int, var string, value double", *data, (9.25, 46.75, None, "elevation", 1500.0))
    got = P.site_climate(meta, grid, -180.0, 90.0, 0.5)
    r = got.filter("destSiteID = 'Cal'").collect()[0]
    assert (r.T_ann, r.P_ann, r.Elevation_st) == (6.5, 120.0, 1500.0)
    assert approx(r.T_ann_cor, 6.5 + 0.0098 * (1500.0 - 2000.0))


def test_saved_table_reads_back(spark, bundles, tmp_path):
    path = P.save(P.all_communities({k: bundles[k] for k in ("CN_Heibei", "DE_Grainau")}), str(tmp_path / "dat"))
    back = spark.read.parquet(path)
    assert back.filter("Region = 'DE_Grainau'").count() == 2 and back.count() == 6
    plan = back.filter("Region = 'DE_Grainau'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Region" in plan
