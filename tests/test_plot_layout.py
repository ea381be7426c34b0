"""The data behind turf maps, dealt out to tasks of a bounded number of rows."""

from pyspark.sql import functions as F

from gradientlab.operators import quality as Q


def test_plot_layout_is_dealt_out_by_rows(spark):
    df = spark.range(1000).select(
        F.concat(F.lit("s"), F.col("id") % 5).alias("destSiteID"), (F.col("id") % 100).cast("string").alias("destPlotID"),
        (F.col("id") % 4 + 2000).cast("int").alias("Year"),
        (F.col("id") % 500).cast("string").alias("SpeciesName"), F.when(F.col("id") != 3, 1.5).alias("Cover"))
    expected = sorted(
        (f"s{k % 5}", str(k % 100), 2000 + k % 4, str(k), 1.5 if k == 3 else 3.0, f"Site s{k % 5}: plot {k % 100}") for k in range(500))
    for given in (None, 1000):
        got = Q.plot_layout(df, rows=given, task_rows=100)
        assert sorted(tuple(r) for r in got.collect()) == expected
        assert got.select(F.spark_partition_id().alias("p")).distinct().count() > 5
    assert Q.plot_layout(df.limit(0)).count() == 0
