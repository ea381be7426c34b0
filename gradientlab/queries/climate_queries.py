"""Queries for climate.

Orders are monthly readings: the month of the order date, the value is the
whole part of the order price; the customer is the grid cell or the site.
"""

from pyspark.sql import functions as F

from ..functions.semantics import natural_left_join
from ..operators import climate as Cl
from ..operators import tiles as Ti
from ..session import scratch_path
from .mapping import SITES_SQL, site_table, table
from .registry import query

VARS = ["tavg", "vapr", "prec"]
GRID_SQL = """
grid AS (
  SELECT o_custkey AS site, CAST(month(o_orderdate) AS INTEGER) AS month, CAST(year(o_orderdate) AS INTEGER) AS year,
         CASE o_orderkey % 3 WHEN 0 THEN 'tavg' WHEN 1 THEN 'vapr' ELSE 'prec' END AS var,
         floor(o_totalprice) AS value
  FROM orders
)"""


def readings(spark, folder):
    k = F.col("o_orderkey") % 3
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("site"), F.month("o_orderdate").alias("month"), F.year("o_orderdate").alias("year"),
        F.when(k == 0, "tavg").when(k == 1, "vapr").otherwise("prec").alias("var"),
        F.floor("o_totalprice").cast("double").alias("value"),
    )


def _season_sql():
    cols = []
    for var, (p, how, summer) in Cl.SEASONS.items():
        for name, months in (("ann", range(1, 13)), ("sum", summer), ("win", Cl.WINTER_HALF)):
            inside = f"var = '{var}' AND month IN ({', '.join(map(str, months))})"
            total = f"sum(CASE WHEN {inside} THEN value END)::DOUBLE"
            if how == "avg":
                total += f" / nullif(count(CASE WHEN {inside} THEN 1 END), 0)"
            cols.append(f"{total} AS {p}_{name}")
    return "WITH" + GRID_SQL + " SELECT site, " + ", ".join(cols) + " FROM grid GROUP BY site"


@query("seasonal_stats", _season_sql())
def seasonal_stats(spark, folder):
    return Cl.seasonal_stats(readings(spark, folder), ["site"])


@query("lapse_correct", """
SELECT c_custkey, c_acctbal AS T_ann, round(c_acctbal + 0.0098::DOUBLE * (100 * c_nationkey - 250), 6) AS T_ann_cor
FROM customer
""")
def lapse_correct(spark, folder):
    df = table(spark, folder, "customer").select(
        "c_custkey", F.col("c_acctbal").alias("T_ann"), (F.col("c_nationkey") * 100).alias("Elevation_st"),
        F.lit(250).alias("Elevation"),
    )
    out = Cl.lapse_correct(df, ["T_ann"])
    return out.select("c_custkey", "T_ann", F.round("T_ann_cor", 6).alias("T_ann_cor"))


@query("monthly_long", """
SELECT l_orderkey, l_linenumber, l_partkey, year, month, value::DOUBLE AS value FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, unnest([2001, 2001, 2019]) AS year, unnest(['Jan', 'Feb', 'Dec']) AS month,
         unnest([l_quantity, l_tax, l_discount]) AS value FROM lineitem)
""")
def monthly_long(spark, folder):
    df = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_extendedprice").alias("1999_Dec"),
        F.col("l_extendedprice").alias("2000_Dec"), F.col("l_quantity").alias("2001_Jan"),
        F.col("l_tax").alias("2001_Feb"), F.col("l_discount").alias("2019_Dec"),
    )
    return Cl.monthly_long(df, ["l_orderkey", "l_linenumber", "l_partkey"])


@query("summer_climate", "WITH" + GRID_SQL + """,
t AS (SELECT site, year, sum(value)::DOUBLE / count(*) AS avetemp FROM grid
      WHERE var = 'tavg' AND month IN (6, 7, 8) GROUP BY 1, 2),
p AS (SELECT site, year, sum(value)::DOUBLE AS sumprec FROM grid WHERE var = 'prec' AND month IN (6, 7, 8) GROUP BY 1, 2)
SELECT t.site, t.year, avetemp, sumprec
FROM t LEFT JOIN p ON p.site = t.site AND p.year = t.year
""")
def summer_climate(spark, folder):
    return Cl.summer_climate(readings(spark, folder), ["site"], "tavg", "prec", (6, 7, 8))


@query("natural_join", "WITH" + GRID_SQL + """,
t AS (SELECT site, year, max(value) AS high FROM grid WHERE var = 'tavg' GROUP BY 1, 2),
p AS (SELECT site, year, min(value) AS low FROM grid WHERE var = 'prec' GROUP BY 1, 2)
SELECT t.site, t.year, t.high, p.low FROM t LEFT JOIN p ON p.site = t.site AND p.year = t.year
""")
def natural_join(spark, folder):
    df = readings(spark, folder)
    t = df.filter(F.col("var") == "tavg").groupBy("site", "year").agg(F.max("value").alias("high"))
    p = df.filter(F.col("var") == "prec").groupBy("site", "year").agg(F.min("value").alias("low"))
    return natural_left_join(t, p)


# Customers are points; coordinates follow from their key.
POINT_SQL = """
pts AS (
  SELECT c_custkey, (c_custkey * 7919 % 36000)::DOUBLE / 100 - 180 AS lon,
         (c_custkey * 104729 % 17000)::DOUBLE / 100 - 85 AS lat FROM customer
)"""


def points(spark, folder):
    k = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        "c_custkey", ((k * 7919 % 36000).cast("double") / 100 - 180).alias("lon"),
        ((k * 104729 % 17000).cast("double") / 100 - 85).alias("lat"),
    )


@query("sample_grid", "WITH" + POINT_SQL + """,
cells AS (SELECT floor((lon + 180) / 10) AS cx, floor((90 - lat) / 10) AS cy, count(*) AS n, max(c_custkey) AS top
          FROM pts GROUP BY 1, 2),
s AS (SELECT s_suppkey, (s_suppkey * 613 % 3600)::DOUBLE / 10 - 180 AS lon, (s_suppkey * 977 % 1700)::DOUBLE / 10 - 85 AS lat
      FROM supplier)
SELECT s.s_suppkey, c.n, c.top FROM s
LEFT JOIN cells c ON c.cx = floor((s.lon + 180) / 10) AND c.cy = floor((90 - s.lat) / 10)
""")
def sample_grid(spark, folder):
    """Suppliers sampled on a 10 degree grid of customer counts."""
    cx, cy = Cl.cell_keys("lon", "lat", -180.0, 90.0, 10.0)
    cells = points(spark, folder).groupBy(cx.alias("cx"), cy.alias("cy")).agg(
        F.count(F.lit(1)).alias("n"), F.max("c_custkey").alias("top")
    ).select(
        (F.col("cx") * 10 - 175).cast("double").alias("lon"), (F.lit(85) - F.col("cy") * 10).cast("double").alias("lat"),
        "n", "top",
    )
    k = F.col("s_suppkey")
    sites = table(spark, folder, "supplier").select(
        "s_suppkey", ((k * 613 % 3600).cast("double") / 10 - 180).alias("Longitude"),
        ((k * 977 % 1700).cast("double") / 10 - 85).alias("Latitude"),
    )
    return Cl.sample_grid(sites, cells, -180.0, 90.0, 10.0).select("s_suppkey", "n", "top")




@query("tolerance_match", "WITH" + POINT_SQL + "," + SITES_SQL + """
SELECT s.destSiteID, p.c_custkey FROM sites s
JOIN pts p ON abs(p.lat - s.Latitude) < 5.0013 AND abs(p.lon - s.Longitude) < 5.0013
""")
def tolerance_match(spark, folder):
    """The grid points around each of the fixed sites."""
    out = Cl.tolerance_match(site_table(spark, folder), points(spark, folder), 5.0013)
    return out.select("destSiteID", "c_custkey")


@query("tolerance_summary", "WITH" + POINT_SQL + "," + SITES_SQL + """
SELECT s.destSiteID, count(*) AS n, min(p.c_custkey) AS first_point, round(avg(p.lat), 6) AS mean_lat FROM sites s
JOIN pts p ON abs(p.lat - s.Latitude) < 5.0013 AND abs(p.lon - s.Longitude) < 5.0013 GROUP BY 1
""")
def tolerance_summary(spark, folder):
    """The matched points of a site as one aggregate."""
    out = Cl.tolerance_match(site_table(spark, folder), points(spark, folder), 5.0013)
    return out.groupBy("destSiteID").agg(
        F.count(F.lit(1)).alias("n"), F.min("c_custkey").alias("first_point"), F.round(F.avg("lat"), 6).alias("mean_lat"))


@query("stations_within", "WITH" + POINT_SQL + "," + SITES_SQL + """,
d AS (SELECT s.destSiteID, p.c_custkey, 2 * 6371.0088 * asin(sqrt(least(1,
        pow(sin(radians(p.lat - s.Latitude) / 2), 2) + cos(radians(s.Latitude)) * cos(radians(p.lat))
        * pow(sin(radians(p.lon - s.Longitude) / 2), 2)))) AS km
      FROM sites s, pts p)
SELECT destSiteID, c_custkey, round(km, 3) AS distance_km FROM d WHERE km <= 800.0013
""")
def stations_within(spark, folder):
    stations = points(spark, folder).withColumnsRenamed({"lon": "st_lon", "lat": "st_lat"})
    out = Cl.stations_within(site_table(spark, folder), stations, 800.0013)
    return out.select("destSiteID", "c_custkey", F.round("distance_km", 3).alias("distance_km"))


@query("nearest_stations", "WITH" + POINT_SQL + "," + SITES_SQL + """,
d AS (SELECT s.destSiteID, p.c_custkey, 2 * 6371.0088 * asin(sqrt(least(1,
        pow(sin(radians(p.lat - s.Latitude) / 2), 2) + cos(radians(s.Latitude)) * cos(radians(p.lat))
        * pow(sin(radians(p.lon - s.Longitude) / 2), 2)))) AS km
      FROM sites s, pts p),
r AS (SELECT *, row_number() OVER (PARTITION BY destSiteID ORDER BY round(km, 6), c_custkey) AS rank FROM d)
SELECT destSiteID, CAST(rank AS INTEGER) AS rank, c_custkey, round(km, 3) AS distance_km FROM r WHERE rank <= 5
""")
def nearest_stations(spark, folder):
    """The five nearest stations of each site."""
    stations = points(spark, folder).withColumnsRenamed({"lon": "st_lon", "lat": "st_lat"})
    out = Cl.nearest_stations(site_table(spark, folder), stations, 5, "destSiteID", "c_custkey")
    return out.select("destSiteID", "rank", "c_custkey", F.round("distance_km", 3).alias("distance_km"))


@query("site_coords", """
SELECT c_mktsegment AS gradient, c_nationkey AS site, avg(c_custkey % 90) AS lat,
       avg(c_custkey) AS long, avg(c_nationkey + 2010) AS yearn, avg(c_nationkey + 2000) AS year1,
       avg(c_nationkey) AS elev, avg(c_nationkey + 2010) - avg(c_nationkey + 2000) AS Yearrange
FROM customer GROUP BY 1, 2
""")
def site_coords(spark, folder):
    k = F.col("c_nationkey")
    df = table(spark, folder, "customer").select(
        F.col("c_mktsegment").alias("gradient"), k.alias("site"), (F.col("c_custkey") % 90).cast("string").alias("lat"),
        F.col("c_custkey").cast("string").alias("long"), k.alias("elev"), (k + 2000).alias("year1"),
        (k + 2010).alias("yearn"),
    )
    return Cl.site_coords(df)


@query("sample_tiles", "WITH" + POINT_SQL + """,
cells AS (SELECT floor((lon + 180) / 2) AS cx, floor((90 - lat) / 2) AS cy, count(*) AS n, max(c_custkey) AS top
          FROM pts GROUP BY 1, 2),
s AS (SELECT s_suppkey, (s_suppkey * 613 % 3600)::DOUBLE / 10 - 180 AS lon, (s_suppkey * 977 % 1700)::DOUBLE / 10 - 85 AS lat
      FROM supplier)
SELECT s.s_suppkey, c.n, c.top FROM s
LEFT JOIN cells c ON c.cx = floor((s.lon + 180) / 2) AND c.cy = floor((90 - s.lat) / 2)
""")
def sample_tiles(spark, folder):
    """Customer counts on a 2 degree grid, stored in tiles of 20 degrees and sampled at the suppliers."""
    tiling = Ti.Tiling(res=2.0, cells=10)
    cx, cy = Cl.cell_keys("lon", "lat", tiling.x0, tiling.y0, tiling.res)
    grid = points(spark, folder).groupBy(cx.alias("cx"), cy.alias("cy")).agg(
        F.count(F.lit(1)).alias("n"), F.max("c_custkey").alias("top")
    ).select((F.col("cx") * 2.0 - 179.0).alias("lon"), (F.lit(89.0) - F.col("cy") * 2.0).alias("lat"), "n", "top")
    path = Ti.write_tiles(grid, scratch_path(spark, "tiles/customers"), tiling)
    k = F.col("s_suppkey")
    sites = table(spark, folder, "supplier").select(
        "s_suppkey", ((k * 613 % 3600).cast("double") / 10 - 180).alias("Longitude"),
        ((k * 977 % 1700).cast("double") / 10 - 85).alias("Latitude"))
    return Ti.sample_tiles(sites, spark.read.parquet(path), tiling, ["n", "top"]).select("s_suppkey", "n", "top")
