"""Grids stored in tiles: values as by the plain grid join, and only the touched tiles read."""

import random
from pathlib import Path

from helpers import frame, rows

from gradientlab.operators import climate as Cl
from gradientlab.operators import tiles as Ti

TILING = Ti.Tiling(res=3.0, cells=5)


def grid(spark):
    cells = [(x + 1.5, y - 1.5, x * 1000 + y) for x in range(-180, 180, 3) for y in range(90, -90, -3)]
    return spark.createDataFrame([(float(a), float(b), float(v)) for a, b, v in cells], "lon double, lat double, v double")


def test_tile_keys_are_unique_and_in_one_tile(spark):
    placed = grid(spark).withColumns(TILING.keys("lon", "lat"))
    per = placed.groupBy("tile").count().collect()
    assert TILING.across() == (24, 12)
    assert len(per) == 24 * 12 and {r["count"] for r in per} == {25}


def test_sampling_is_that_of_the_plain_grid(spark, tmp_path):
    table = spark.read.parquet(Ti.write_tiles(grid(spark), str(tmp_path / "g"), TILING))
    rng = random.Random(5)
    places = [(i, rng.uniform(-180, 180), rng.uniform(-90, 90)) for i in range(300)]
    places += [(300, -180.0, 90.0), (301, 180.0, 0.0), (302, 0.0, -90.0), (303, None, 1.0), (304, 500.0, 1.0), (305, 0.0, 0.0), (305, 0.0, 0.0)]
    sites = frame(spark, "tile int, Longitude double, Latitude double", *places)
    got = Ti.sample_tiles(sites, table, TILING, ["v"])
    plain = Cl.sample_grid(sites, grid(spark), TILING.x0, TILING.y0, TILING.res)
    assert rows(got, "tile", "v") == rows(plain, "tile", "v")
    assert got.columns == ["tile", "Longitude", "Latitude", "v"]
    assert Ti.sample_tiles(sites.limit(0), table, TILING, ["v"]).count() == 0


def test_only_touched_tiles_are_read(spark, tmp_path):
    path = Ti.write_tiles(grid(spark), str(tmp_path / "g"), TILING)
    schema = spark.read.parquet(path).schema
    sites = frame(spark, "s string, Longitude double, Latitude double", ("a", 10.0, 50.0), ("b", 11.0, 50.0), ("c", -100.0, -20.0))
    touched = {r.tile for r in sites.select(TILING.keys("Longitude", "Latitude")["tile"].alias("tile")).collect()}
    assert len(touched) == 2
    broken = 0
    for part in Path(path).glob("tile=*"):
        if int(part.name.split("=")[1]) not in touched:
            (part / "part-broken.parquet").write_bytes(b"no parquet file")  # opening it would fail
            broken += 1
    assert broken == 24 * 12 - 2
    got = Ti.sample_tiles(sites, spark.read.schema(schema).parquet(path), TILING, ["v"])
    assert "dynamicpruning" in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got, "s", "v") == [("a", 9000.0 + 51.0), ("b", 9000.0 + 51.0), ("c", -102000.0 - 18.0)]


def test_saving_one_tile_leaves_the_others(spark, tmp_path):
    path = Ti.write_tiles(grid(spark), str(tmp_path / "g"), TILING)
    Ti.write_tiles(frame(spark, "lon double, lat double, v double", (1.5, 1.5, -1.0)), path, TILING)
    after = spark.read.parquet(path)
    assert after.count() == 120 * 60 - 24 and rows(after.filter("v = -1"), "cell_x", "cell_y") == [(60, 29)]
