"""The star-schema tables seen as a plant survey.

A line item is one species record; its order is the sample (one plot visit).
The customer's nation is the site a turf came from; the destination site is the
nation numbered ``o_orderkey % 25``.  The region key ranks sites by elevation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.semantics import paste
from ..operators.community import Rule, assign_treatment

NATIONS = 25
CONTROL_LABEL = "4-NOT SPECIFIED"
RULES = [
    Rule("Control", label=(CONTROL_LABEL,)),
    Rule("LocalControl", relation="same"),
    Rule("Warm", relation="down"),
    Rule("Cold", relation="up"),
]
# Site constants: (elevation, longitude, latitude) of every nation.
SITES = {
    f"NATION_{k}": (300.0 + 100.0 * k, -180.0 + 14.3 * k, -60.0 + 5.1 * k) for k in range(NATIONS)
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def visits(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order: region, year, sites, block, treatment label and keys.

    Sites are attached to orders, not to line items, so the large table is not
    shuffled for them.
    """
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    origin = nation.select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("originSiteID"),
        F.col("n_regionkey").alias("origin_rank"),
    )
    dest = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.col("n_nationkey").alias("dest_key"), F.col("n_name").alias("destSiteID"),
        F.col("n_regionkey").alias("dest_rank"), F.col("r_name").alias("Region"),
    )
    return (
        orders.withColumn("dest_key", F.col("o_orderkey") % NATIONS)
        .join(customer, orders["o_custkey"] == customer["c_custkey"])
        .join(origin, "c_nationkey")
        .join(dest, "dest_key")
        .select(
            "o_orderkey", "Region", F.year("o_orderdate").alias("Year"), "originSiteID", "destSiteID",
            F.col("o_orderpriority").alias("destBlockID"),
            F.col("o_orderkey").cast("string").alias("destPlotID"),
            "origin_rank", "dest_rank", "o_totalprice", "o_orderdate",
        )
    )


def treated_visits(spark: SparkSession, folder: str) -> DataFrame:
    df = assign_treatment(
        visits(spark, folder), RULES, label="destBlockID", origin_rank="origin_rank", dest_rank="dest_rank"
    )
    return df.withColumn("UniqueID", paste("Year", "originSiteID", "destSiteID", "destPlotID"))


def obs(spark: SparkSession, folder: str) -> DataFrame:
    """One row per species record with all survey columns."""
    lines = table(spark, folder, "lineitem")
    part = table(spark, folder, "part").select("p_partkey", F.col("p_name").alias("SpeciesName"), "p_type")
    plots = treated_visits(spark, folder)
    return (
        lines.join(plots, lines["l_orderkey"] == plots["o_orderkey"])
        .join(part, lines["l_partkey"] == part["p_partkey"])
        .withColumns({
            "turfID": F.col("l_suppkey").cast("string"),
            "Cover": F.col("l_quantity"),
        })
    )


def site_table(spark: SparkSession, folder: str) -> DataFrame:
    """Elevation and position of every destination site, with its region."""
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    key = F.col("n_nationkey")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.col("r_name").alias("Region"), F.col("n_name").alias("destSiteID"),
        (F.lit(300.0) + F.lit(100.0) * key).alias("Elevation"),
        (F.lit(-180.0) + F.lit(14.3) * key).alias("Longitude"),
        (F.lit(-60.0) + F.lit(5.1) * key).alias("Latitude"),
    )


# The same view in SQL.
VISITS_SQL = """
visits AS (
  SELECT o.o_orderkey, r.r_name AS Region, CAST(year(o.o_orderdate) AS INTEGER) AS Year,
         og.n_name AS originSiteID, ds.n_name AS destSiteID, o.o_orderpriority AS destBlockID,
         CAST(o.o_orderkey AS VARCHAR) AS destPlotID, og.n_regionkey AS origin_rank,
         ds.n_regionkey AS dest_rank, o.o_totalprice, o.o_orderdate,
         CASE WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN 'Control'
              WHEN og.n_regionkey = ds.n_regionkey THEN 'LocalControl'
              WHEN og.n_regionkey > ds.n_regionkey THEN 'Warm' ELSE 'Cold' END AS Treatment,
         concat_ws('_', year(o.o_orderdate), og.n_name, ds.n_name, o.o_orderkey) AS UniqueID
  FROM orders o
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation og ON og.n_nationkey = c.c_nationkey
  JOIN nation ds ON ds.n_nationkey = o.o_orderkey % 25
  JOIN region r ON r.r_regionkey = ds.n_regionkey
)"""
OBS_SQL = VISITS_SQL + """,
obs AS (
  SELECT v.*, l.*, p.p_name AS SpeciesName, p.p_type, CAST(l.l_suppkey AS VARCHAR) AS turfID,
         l.l_quantity AS Cover
  FROM lineitem l JOIN visits v ON v.o_orderkey = l.l_orderkey JOIN part p ON p.p_partkey = l.l_partkey
)"""
SITES_SQL = """
sites AS (
  SELECT r_name AS Region, n_name AS destSiteID, 300.0::DOUBLE + 100 * n_nationkey AS Elevation,
         -180.0::DOUBLE + 14.3::DOUBLE * n_nationkey AS Longitude,
         -60.0::DOUBLE + 5.1::DOUBLE * n_nationkey AS Latitude
  FROM nation JOIN region ON r_regionkey = n_regionkey
)"""
