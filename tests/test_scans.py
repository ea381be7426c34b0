"""Row numbers made at the scan, rejects of typed scans, sinks that write what changed."""

import math
import random
from pathlib import Path

import pytest
from helpers import frame, rows
from pyspark.sql import functions as F

from gradientlab.operators import climate as Cl
from gradientlab.operators.reshape import first_per_key
from gradientlab.session import scratch_path
from gradientlab.sources import readers as Rd
from gradientlab.sources import scans as Sc


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def test_row_numbers_follow_the_lines_of_split_files(small_splits, tmp_path):
    spark = small_splits
    wanted = []
    for name, n in (("big one", 30_000), ("b+c", 1), ("empty", 0), ("mid", 4_000)):
        lines = [f"{name}{k}" for k in range(n)]
        (tmp_path / f"{name}.csv").write_text("id,x\n" + "".join(f"{t},{k % 7}\n" for k, t in enumerate(lines)))
        wanted += [(t, k, f"{name}.csv") for k, t in enumerate(lines, 1)]
    read = Rd.read_delimited(spark, str(tmp_path), "id string, x int")
    assert read.rdd.getNumPartitions() > 20
    numbered = Sc.with_row_numbers(read, file="file").withColumn("file", F.element_at(F.split("file", "/"), -1))
    assert rows(numbered, "id", "row_no", "file") == sorted(wanted)
    filtered = Sc.with_row_numbers(read).filter("x = 3")
    assert rows(filtered, "id", "row_no") == sorted((t, k) for t, k, _ in wanted if (k - 1) % 7 == 3)
    assert rows(Rd.row_window(Sc.with_row_numbers(read), 2, 3), "id") == sorted([("big one1",), ("big one2",), ("mid1",), ("mid2",)])
    first = first_per_key(Sc.with_row_numbers(read, file="file"), ["file", "x"], "row_no")
    assert first.filter("id = 'big one6' AND x = 6").count() == 1 and first.count() == 7 + 1 + 7


def test_numbering_shuffles_no_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id\n1\n2\n")
    text = Sc.with_row_numbers(Rd.read_delimited(spark, str(tmp_path), "id int"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text and "Window" not in text


def test_every_line_is_a_row_or_a_reject(small_splits, tmp_path):
    spark = small_splits
    rng = random.Random(5)
    lines, good, bad = ["k,v,d,s"], [], []
    for k in range(3000):
        cells = [str(k), f"{k / 4}", f"2020-01-{k % 28 + 1:02}", rng.choice(["a", "NA", "", '"x, y"'])]
        kind = rng.randrange(8)
        if kind == 0:
            cells[1] = "1.5.2"
            bad.append((k + 2, "v", "1.5.2"))
        if kind in (0, 1):
            cells[2] = "31.12.2020"
            bad.append((k + 2, "d", "31.12.2020"))
        if kind == 2:
            cells = cells[:3]
            bad.append((k + 2, None, ",".join(cells)))
        if kind == 3:
            cells = [*cells, "more"]
            bad.append((k + 2, None, ",".join(cells)))
        if kind == 4:
            cells[1] = "NA"
        if kind > 3:
            good.append((k, None if kind == 4 else k / 4, {"NA": None, "": None, '"x, y"': "x, y"}.get(cells[3], cells[3])))
        lines.append(",".join(cells))
    (tmp_path / "f.csv").write_text("\n".join(lines) + "\n")
    got, rejects = Sc.read_checked(spark, str(tmp_path / "f.csv"), "k bigint, v double, d date, s string")
    assert got.columns == ["k", "v", "d", "s"] and got.filter("d IS NULL").count() == 0
    assert rows(got, "k", "v", "s") == sorted(good, key=lambda t: tuple((x is None, str(x)) for x in t))
    assert rows(rejects, "line", "column", "raw") == sorted(bad, key=lambda t: tuple((x is None, str(x)) for x in t))
    assert got.count() + rejects.select("line").distinct().count() == 3000
    assert {r.file.rsplit("/", 1)[-1] for r in rejects.select("file").distinct().collect()} == {"f.csv"}


def test_saving_one_region_keeps_the_others(spark):
    path = scratch_path(spark, "regions")
    Rd.write_table(frame(spark, "Region string, x int", ("A", 1), ("B", 2), (None, 3)), path)
    Rd.write_table(frame(spark, "Region string, x int", ("B", 5), ("C", 6)), path)
    assert rows(spark.read.parquet(path), "Region", "x") == [("A", 1), ("B", 5), ("C", 6), (None, 3)]


def test_only_changed_regions_are_rewritten(spark):
    path = scratch_path(spark, "changed")
    first = [("A", 1, "x"), ("A", 2, None), ("B", 2, "y"), ("C", 3, "z"), (None, 4, "n")]
    make = lambda data: frame(spark, "Region string, x int, s string", *data)
    files = lambda: {p: p.stat().st_mtime_ns for p in Path(path.removeprefix("file:")).glob("Region=*/*.parquet")}
    assert rows(Rd.save_changed(make(first), path), "Region", "rows") == [("A", 2), ("B", 1), ("C", 1), (None, 1)]
    before = files()
    assert Rd.save_changed(make(first[::-1]).select("s", "x", "Region"), path).count() == 0 and files() == before
    second = [("A", 2, None), ("A", 1, "x"), ("B", 2, "Y"), ("C", 3, "z"), ("D", 1, "d"), (None, 4, "n")]
    assert rows(Rd.save_changed(make(second), path), "Region") == [("B",), ("D",)]
    after = files()
    assert {p for p in before if p in after} == {p for p in before if "Region=B" not in str(p)}
    assert rows(spark.read.parquet(path), "Region", "x", "s") == rows(make(second), "Region", "x", "s")
    # a region that the next run doesn't build stays, also its fingerprint
    assert Rd.save_changed(make(second[:2]), path).count() == 0
    assert Rd.save_changed(make(second), path).count() == 0


def brute_nearest(sites, stations, k, within=math.inf):
    def km(a, b):
        (lo1, la1), (lo2, la2) = ([math.radians(v) for v in p] for p in (a, b))
        h = math.sin((la2 - la1) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin((lo2 - lo1) / 2) ** 2
        return 2 * Cl.EARTH_KM * math.asin(math.sqrt(min(1.0, h)))

    out = []
    for name, *place in sites:
        if None in place:
            continue
        found = sorted((round(km(place, at), 6), other) for other, *at in stations if None not in at)
        out += [(name, rank, other) for rank, (d, other) in enumerate(found[:k], 1) if d <= within]
    return sorted(out)


@pytest.mark.parametrize("within", [None, 900.0])
def test_nearest_stations_against_all_pairs(spark, within):
    rng = random.Random(3)
    stations = [(f"s{k:03}", rng.gauss(10, 4), rng.gauss(47, 3)) for k in range(150)]
    stations += [(f"t{k:03}", rng.uniform(-180, 180), math.degrees(math.asin(rng.uniform(-1, 1)))) for k in range(60)]
    stations += [("pole", 12.0, 90.0), ("line", 179.9, -17.0), ("twin1", 8.0, 46.0), ("twin2", 8.0, 46.0), ("none", None, 46.0)]
    sites = [("line", -179.9, -17.0), ("north", 0.0, 89.9), ("south", 100.0, -90.0), ("there", 8.0, 46.0), ("lost", None, 1.0), ("sea", -140.0, -40.0)]
    sites += [(f"x{k}", rng.gauss(10, 4), rng.gauss(47, 3)) for k in range(40)]
    st = frame(spark, "station string, st_lon double, st_lat double", *stations)
    df = frame(spark, "siteID string, Longitude double, Latitude double", *sites)
    for k in (1, 4):
        got = Cl.nearest_stations(df, st, k, within_km=within)
        assert rows(got, "siteID", "rank", "station") == brute_nearest(sites, stations, k, within or math.inf)
    assert Cl.nearest_stations(df, st.limit(0), 2).count() == 0
    few = Cl.nearest_stations(df, st.filter("station LIKE 'twin%'"), 3, start_km=1.0)
    assert {r["count"] for r in few.groupBy("siteID").count().collect()} == {2}


def test_nearest_stations_keep_the_best_before_the_shuffle(spark):
    st = frame(spark, "station string, st_lon double, st_lat double", ("a", 1.0, 1.0))
    df = frame(spark, "siteID string, Longitude double, Latitude double", ("x", 1.0, 1.0))
    from pyspark.sql import Window

    near = Cl.stations_within(df, st, 10.0).withColumn("rank", F.row_number().over(Window.partitionBy("siteID").orderBy("distance_km")))
    assert "WindowGroupLimit" in near.filter("rank <= 2")._jdf.queryExecution().executedPlan().toString()
    assert rows(Cl.stations_within(df, st, 0.0), "station") == [("a",)]
