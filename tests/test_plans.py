"""Plan guards: what must hold for the plans to survive large and skewed tables."""

import re
from pathlib import Path

import pytest
from helpers import frame, rows
from pyspark.sql import functions as F

from gradientlab.functions.semantics import null_safe_join
from gradientlab.operators import community as C
from gradientlab.queries import REGISTRY
from gradientlab.session import scratch_root
from gradientlab.sources import readers as Rd

FOLDER = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not present")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@needs_tables
def test_no_nested_loops_no_python_no_forced_broadcast(no_broadcast):
    """With broadcasting switched off every join must still be a partitioned equi-join."""
    for name, query in REGISTRY.items():
        text = plan(query(no_broadcast, FOLDER))
        for word in ("CartesianProduct", "BroadcastNestedLoop", "BroadcastExchange", "Python"):
            assert word not in text, (name, word)
        if name not in ("sequence_in_group", "number_unresolved", "product_cleaned_species", "product_all_traits", "nest_chunks", "unnest_chunks"):  # numbering, in buckets
            assert not re.search(r"\bWindow \[", text), name


@needs_tables
def test_flagship_shuffles_line_items_once(no_broadcast):
    text = plan(REGISTRY["merge_community"](no_broadcast, FOLDER))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,0.0)" in text
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    lines = [re.sub(r"#\d+L?", "", s) for s in scans if "l_orderkey" in s]
    assert sorted(lines) == ["l_orderkey,l_partkey,l_suppkey,l_quantity", "l_orderkey,l_quantity"]
    assert len(re.findall(r"Exchange hashpartitioning\(l_orderkey#", text)) == 2  # rows, and pre-aggregated totals
    assert "partial_sum(Cover" in text


@needs_tables
def test_filters_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    text = plan(REGISTRY["filters"](spark, FOLDER))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThan(l_quantity,10.0)" in text and "In(l_returnflag, [A,R])" in text and "l_extendedprice" not in text


def test_null_safe_join_is_an_equi_join(no_broadcast):
    a = frame(no_broadcast, "k string, v int", ("x", 1))
    assert "SortMergeJoin" in plan(null_safe_join(a, a.withColumnRenamed("v", "w"), ["k"]))


def test_pivot_needs_no_extra_job(spark):
    from gradientlab.operators.reshape import crosstab

    df = frame(spark, "r string, c string", ("p", "u"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("pivot", "pivot")
    crosstab(df, ["r"], "c", ["u", "v"])
    assert not tracker.getJobIdsForGroup("pivot")


def test_hot_sample_is_split_and_exact(spark):
    """One sample holds a third of all rows: its side of the join is split, the result is whole."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        n = 300_000
        df = spark.range(0, n, 1, 8).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 1000).cast("string"))).alias("UniqueID"),
            F.sha2(F.col("id").cast("string"), 256).alias("SpeciesName"), F.lit(1.0).alias("Cover"),
        )
        rel = C.relative_cover(df, ["UniqueID"])
        got = rel.groupBy(F.col("UniqueID") == "hot").agg(F.count("*").alias("n"), F.min("Total_Cover").alias("lo"), F.max("Total_Cover").alias("hi"))
        assert sum(r.n for r in got.collect()) == n
        rel.write.format("noop").mode("overwrite").save()
        hot = rel.filter("UniqueID = 'hot'").agg(F.count("*").alias("n"), F.max("Total_Cover").alias("t"), F.sum("Rel_Cover").alias("s")).collect()[0]
        assert (hot.n, hot.t) == (n / 3, n / 3) and abs(hot.s - 1.0) < 1e-6
        out = rel.select(F.sum("Rel_Cover"))
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
        for residual in (False, True):  # as the queries call it: an order is the sample, then further joins on it
            lines = df.select((F.when(F.col("UniqueID") == "hot", 0).otherwise(F.crc32("UniqueID"))).alias("l_orderkey"), "SpeciesName", "Cover")
            out = C.relative_cover(lines, ["l_orderkey"], residual=residual)
            plots = lines.select(F.col("l_orderkey").alias("o_orderkey")).distinct()
            out = out.join(plots, out["l_orderkey"] == plots["o_orderkey"]).select(F.sum("Rel_Cover"), F.max("SpeciesName"))
            out.collect()
            assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_sources(spark, tmp_path):
    df = frame(spark, "a int, b string", (1, "x"), (2, None), (3, "NA;q"))
    for sep in (",", ";"):
        back = Rd.read_delimited(spark, Rd.write_csv(df, str(tmp_path / f"s{ord(sep)}"), sep=sep), "a int, b string", sep=sep)
        assert rows(back, "a", "b") == [(1, "x"), (2, None), (3, "NA;q")]
    folder = tmp_path / "CRE_RIO_2018"
    folder.mkdir()
    for sheet, v in (("1 plot", 5), ("2.b", 6), ("notes", 7)):
        (folder / f"{sheet}.csv").write_text(f"sp,n\nPoa,{v}\n")
    sheets = Rd.read_sheets(spark, str(folder), "sp string, n int")
    assert rows(sheets, "turfID", "n") == [("T1", 5), ("T2", 6)]
    tagged = Rd.with_file_tags(Rd.read_delimited(spark, str(folder), "sp string, n int"), siteID="CRE_CRE|CRE_RIO", year=(r"_(\d{4})/", 1))
    assert rows(tagged.select("siteID", "year").distinct(), "siteID", "year") == [("CRE_RIO", "2018")]
    union = Rd.read_union(spark, [(str(folder / "notes.csv"), "sp string, n int"), (str(folder / "2.b.csv"), "sp string, m int")])
    assert union.columns == ["sp", "n", "m"] and union.count() == 2
    named = Rd.read_named(spark, {"species": str(folder / "notes.csv")}, {"species": "sp string, n int"})
    assert named["species"].count() == 1
    assert Rd.row_window(spark.range(1, 20).withColumnRenamed("id", "row_no"), 3, 5).count() == 3
    assert scratch_root(spark)
