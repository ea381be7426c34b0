"""What several steps read is prepared once: stored tables are read instead of their sources."""

from dataclasses import fields

import pytest
from helpers import frame

from gradientlab.plans.products import cleaned_species
from gradientlab.plans.profile import SiteBundle
from gradientlab.queries import REGISTRY


def test_the_census_is_read_once(spark, tmp_path):
    frame(
        spark, "destSiteID string, SpeciesName string, Treatment string, Cover double",
        ("s", "Poa alpin", "Warm", 1.0), ("s", "Poa alpin", "Warm", 2.0), ("s", None, "Cold", 1.0), (None, "Zea", None, 1.0),
    ).write.parquet(f"{tmp_path}/community")
    community = spark.read.parquet(f"{tmp_path}/community")
    bundle = SiteBundle(**{f.name: community if f.name == "community" else None for f in fields(SiteBundle)})
    got = cleaned_species({"A": bundle, "B": bundle}, [], frame(spark, "matched_name string, gni_uuid int", ("Poa alpina", 1)))
    assert not [f for f in got.inputFiles() if str(tmp_path) in f]
    assert {tuple(r) for r in got.select("Region", "destSiteID", "SpeciesName", "gni_uuid").collect()} == {
        (r, s, n, i) for r in "AB" for s, n, i in (("s", "Poa alpin", 1), (None, "Zea", None), ("s", None, None))}


@pytest.fixture
def tables(spark, tmp_path):
    made = {
        "part": frame(spark, "p_partkey bigint, p_name string, p_type string", (0, "red bolt", "SMALL"), (1, "new rod", "ECONOMY")),
        "orders": frame(spark, "o_orderkey bigint", *[(k,) for k in range(8)]),
        "lineitem": frame(
            spark, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_returnflag string, l_quantity double",
            *[(k, n, n % 2, "ANR"[n % 3], 1.0 + n) for k in range(8) for n in range(1, 4)]),
    }
    for name, df in made.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name", ["profile_lavey", "product_dat"])
def test_the_sheet_is_joined_once(spark, tables, name):
    got = REGISTRY[name](spark, tables)
    assert not [f for f in got.inputFiles() if "lineitem" in f]
    assert got.count() > 0
