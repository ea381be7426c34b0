"""Queries for raw-survey corrections and roll-ups, and for the relational scans."""

from pyspark.sql import functions as F

from ..functions.semantics import null_safe_join
from ..operators import corrections as K
from ..operators.community import assign_treatment
from ..sources.relational import run_sql
from .mapping import OBS_SQL, RULES, VISITS_SQL, obs, table, visits
from .registry import query

# Line items as turf records: recorder, usable sub-plots and raw cover.
TURF_SQL = """
turf AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS turfID, CAST(year(l_shipdate) AS INTEGER) AS year, l_linenumber, l_partkey,
         CASE l_returnflag WHEN 'N' THEN NULL ELSE l_returnflag END AS recorder,
         8 + l_linenumber AS notbad, l_quantity AS cover
  FROM lineitem
)"""


def turf_records(spark, folder):
    lines = table(spark, folder, "lineitem")
    return lines.select(
        F.col("l_orderkey").cast("string").alias("turfID"), F.year("l_shipdate").alias("year"),
        "l_linenumber", "l_partkey",
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("recorder"),
        (F.col("l_linenumber") + 8).alias("notbad"), F.col("l_quantity").alias("cover"),
    )


@query("sql_origin_dest", """
SELECT o.o_orderkey AS turfID, og.n_name AS originSiteID, ro.r_name AS originBlockID, ds.n_name AS destSiteID,
       rd.r_name AS destBlockID, o.o_orderstatus AS TTtreat
FROM orders o, customer c, nation og, nation ds, region ro, region rd
WHERE o.o_custkey = c.c_custkey AND c.c_nationkey = og.n_nationkey AND og.n_regionkey = ro.r_regionkey
  AND o.o_orderkey % 25 = ds.n_nationkey AND ds.n_regionkey = rd.r_regionkey
""")
def sql_origin_dest(spark, folder):
    """Comma-style joins with self-joined site tables, as SQL over named tables."""
    tables = {
        "turfs": table(spark, folder, "orders").select(
            F.col("o_orderkey").alias("turfID"), F.col("o_custkey").alias("originPlotID"),
            (F.col("o_orderkey") % 25).alias("destinationPlotID"), F.col("o_orderstatus").alias("TTtreat"),
        ),
        "plots": table(spark, folder, "customer").select(
            F.col("c_custkey").alias("plotID"), F.col("c_nationkey").alias("siteKey")
        ),
        "sites": table(spark, folder, "nation"),
        "blocks": table(spark, folder, "region"),
    }
    return run_sql(spark, """
        SELECT t.turfID, os.n_name AS originSiteID, ob.r_name AS originBlockID,
               ds.n_name AS destSiteID, db.r_name AS destBlockID, t.TTtreat
        FROM {turfs} t, {plots} p, {sites} os, {blocks} ob, {sites} ds, {blocks} db
        WHERE t.originPlotID = p.plotID AND p.siteKey = os.n_nationkey AND os.n_regionkey = ob.r_regionkey
          AND t.destinationPlotID = ds.n_nationkey AND ds.n_regionkey = db.r_regionkey
    """, tables)


@query("scalar_subquery_count", """
SELECT o.o_orderkey AS turfID, CAST(year(o.o_orderdate) AS INTEGER) AS year,
       (SELECT count(*) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'N') AS notbad
FROM orders o
""")
def scalar_subquery_count(spark, folder):
    """Usable sub-plots per turf as a correlated count (0, not NULL, where there is none)."""
    tables = {
        "turfEnvironment": table(spark, folder, "orders").select(
            F.col("o_orderkey").alias("turfID"), F.year("o_orderdate").alias("year")
        ),
        "subTurfEnvironment": table(spark, folder, "lineitem").select(
            F.col("l_orderkey").alias("turfID"),
            F.when(F.col("l_returnflag") == "N", "").otherwise("x").alias("bad"),
        ),
    }
    return run_sql(spark, """
        SELECT t.turfID, t.year,
               (SELECT count(e.bad) FROM {subTurfEnvironment} e
                 WHERE e.turfID = t.turfID AND e.bad = '') AS notbad
        FROM {turfEnvironment} t
    """, tables)


@query("inner_chain_sum", """
SELECT n.n_name AS siteID, r.r_name AS blockID, o.o_orderkey AS turfID, o.o_totalprice AS totalVascular,
       sum(l.l_quantity) AS SumOfCover
FROM region r JOIN nation n ON n.n_regionkey = r.r_regionkey JOIN customer c ON c.c_nationkey = n.n_nationkey
JOIN orders o ON o.o_custkey = c.c_custkey JOIN lineitem l ON l.l_orderkey = o.o_orderkey
WHERE l.l_returnflag = 'R' GROUP BY 1, 2, 3, 4
""")
def inner_chain_sum(spark, folder):
    """Site to community chain; the cover is added up per turf before the other tables are joined."""
    cover = (
        table(spark, folder, "lineitem").filter(F.col("l_returnflag") == "R")
        .groupBy("l_orderkey").agg(F.coalesce(F.sum("l_quantity"), F.lit(0.0)).alias("SumOfCover"))
    )
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    customer, orders = table(spark, folder, "customer"), table(spark, folder, "orders")
    return (
        cover.join(orders, cover["l_orderkey"] == orders["o_orderkey"])
        .join(customer, orders["o_custkey"] == customer["c_custkey"])
        .join(nation, customer["c_nationkey"] == nation["n_nationkey"])
        .join(region, nation["n_regionkey"] == region["r_regionkey"])
        .select(
            F.col("n_name").alias("siteID"), F.col("r_name").alias("blockID"), F.col("o_orderkey").alias("turfID"),
            F.col("o_totalprice").alias("totalVascular"), "SumOfCover",
        )
    )


@query("semi_key", "WITH" + TURF_SQL + """,
low AS (SELECT DISTINCT turfID, year FROM turf WHERE recorder = 'R' AND cover < 10)
SELECT t.turfID, t.year, t.l_linenumber, t.l_partkey, t.cover,
       concat(t.turfID, ' ', t.year) IN (SELECT concat(turfID, ' ', year) FROM low) AS flagged
FROM turf t
""")
def semi_key(spark, folder):
    turf = turf_records(spark, folder)
    low = turf.filter((F.col("recorder") == "R") & (F.col("cover") < 10))
    flagged = K.flag_members(turf, ["turfID", "year"], low, "flagged")
    return flagged.select("turfID", "year", "l_linenumber", "l_partkey", "cover", "flagged")


@query("effort_correction", "WITH" + TURF_SQL + """
SELECT turfID, year, l_linenumber, l_partkey, notbad, least(cover * 25 / notbad, 80) AS cover
FROM turf WHERE notbad > 10
""")
def effort_correction(spark, folder):
    df = K.correct_effort(turf_records(spark, folder))
    return df.select("turfID", "year", "l_linenumber", "l_partkey", "notbad", "cover")


@query("observer_correction", "WITH" + TURF_SQL + """,
total AS (SELECT turfID, year, sum(cover) AS SumOfCover FROM turf WHERE recorder = 'R' GROUP BY 1, 2),
est AS (SELECT CAST(o_orderkey AS VARCHAR) AS turfID, 5 + o_custkey % 40 AS totalVascular FROM orders),
low AS (SELECT DISTINCT t.turfID, t.year FROM total t JOIN est e ON e.turfID = t.turfID
        WHERE SumOfCover / totalVascular < 1.35)
SELECT t.turfID, t.year, t.l_linenumber, t.l_partkey, coalesce(t.recorder, 'unknown botanist') AS recorder,
       round(t.cover * CASE WHEN t.recorder = 'A' THEN 1.2::DOUBLE ELSE 1 END
                     * CASE WHEN l.turfID IS NULL THEN 1 ELSE 1.3::DOUBLE END, 6) AS cover
FROM turf t LEFT JOIN low l ON l.turfID = t.turfID AND l.year = t.year
""")
def observer_correction(spark, folder):
    turf = turf_records(spark, folder)
    totals = turf.filter(F.col("recorder") == "R").groupBy("turfID", "year").agg(F.sum("cover").alias("SumOfCover"))
    estimate = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("turfID"), (F.col("o_custkey") % 40 + 5).alias("totalVascular")
    )
    low = K.low_samples(
        totals.join(estimate, "turfID"), ["turfID", "year"], "SumOfCover", "totalVascular", 1.35
    )
    fixed = K.correct_observer(turf, {"A": 1.2})
    fixed = K.scale_flagged(fixed, low, ["turfID", "year"], 1.3)
    return fixed.select(
        "turfID", "year", "l_linenumber", "l_partkey", "recorder", F.round("cover", 6).alias("cover")
    )


POINT_FIXES = [
    K.Fix("1", 1998, "set", 25.0, "1"), K.Fix("3", 1997, "times", 0.5), K.Fix("7", 1995, "times", 2.0 / 3.0),
]


@query("point_fixes", "WITH" + TURF_SQL + """
SELECT turfID, year, l_linenumber, l_partkey, round(CASE
  WHEN turfID = '1' AND year = 1998 AND l_linenumber = 1 THEN 25::DOUBLE
  WHEN turfID = '3' AND year = 1997 THEN cover * 0.5::DOUBLE
  WHEN turfID = '7' AND year = 1995 THEN cover * 2 / 3 ELSE cover END, 6) AS cover
FROM turf
""")
def point_fixes(spark, folder):
    turf = turf_records(spark, folder).withColumn("species", F.col("l_linenumber").cast("string"))
    fixed = K.apply_point_fixes(turf, POINT_FIXES)
    return fixed.select("turfID", "year", "l_linenumber", "l_partkey", F.round("cover", 6).alias("cover"))


@query("pool_observers", """
WITH r AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag,
    CASE l_returnflag WHEN 'A' THEN 'NF' ELSE replace(CAST(CAST(l_discount AS DECIMAL(6,2)) AS VARCHAR), '.', ',') END AS a,
    replace(CAST(CAST(l_tax AS DECIMAL(6,2)) AS VARCHAR), '.', '-') AS b
  FROM lineitem),
n AS (SELECT *, TRY_CAST(replace(nullif(a, 'NF'), ',', '.') AS DOUBLE) AS Cov1,
             TRY_CAST(replace(b, '-', '.') AS DOUBLE) AS Cov2 FROM r),
g AS (SELECT l_orderkey, l_returnflag,
             round((coalesce(sum(CAST(Cov1 AS DECIMAL(18,4))), 0) + coalesce(sum(CAST(Cov2 AS DECIMAL(18,4))), 0))::DOUBLE
                   / (count(Cov1) + count(Cov2)), 6) AS Cover FROM n GROUP BY 1, 2)
SELECT n.l_orderkey, n.l_linenumber, n.l_partkey, n.Cov1, n.Cov2, g.Cover
FROM n JOIN g ON g.l_orderkey = n.l_orderkey AND g.l_returnflag = n.l_returnflag
""")
def pool_observers(spark, folder):
    text = lambda c: F.col(c).cast("decimal(6,2)").cast("string")
    df = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag",
        F.when(F.col("l_returnflag") == "A", "NF").otherwise(F.translate(text("l_discount"), ".", ",")).alias("Cov1"),
        F.translate(text("l_tax"), ".", "-").alias("Cov2"),
    )
    out = K.pool_observers(df, ["l_orderkey", "l_returnflag"], ["Cov1", "Cov2"])
    return out.select(
        "l_orderkey", "l_linenumber", "l_partkey", "Cov1", "Cov2", F.round("Cover", 6).alias("Cover")
    )


@query("pin_counts", """
SELECT turfID, SpeciesName, sum(cover)::DOUBLE AS cover FROM (
  SELECT l_suppkey AS turfID, 'Poa' AS SpeciesName, l_linenumber AS cover FROM lineitem
  UNION ALL SELECT l_suppkey, 'Poa', l_quantity FROM lineitem
  UNION ALL SELECT l_suppkey, 'Other', CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END FROM lineitem)
GROUP BY 1, 2
""")
def pin_counts(spark, folder):
    """Two numbered columns of one species are added up, the focal one is left out, blanks are Other."""
    blank = F.when(F.col("l_returnflag") == "A", 1).otherwise(0)
    df = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("turfID"), F.col("l_linenumber").alias("Poa...1"), F.col("l_quantity").alias("Poa...12"),
        F.col("l_tax").alias("FOCAL Poa"), blank.alias("Other"),
    )
    return K.pin_counts_wide(df, ["turfID"])


@query("pin_rows", """
SELECT l_suppkey AS turfID, CASE WHEN l_returnflag = 'N' THEN 'Other' ELSE l_returnflag END AS SpeciesName,
       sum(l_quantity + l_linenumber) AS cover
FROM lineitem WHERE NOT contains(l_returnflag, 'R') GROUP BY 1, 2
""")
def pin_rows(spark, folder):
    df = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("turfID"), F.col("l_returnflag").alias("sp"), "l_quantity", "l_linenumber"
    )
    return K.pin_counts_rows(df, ["turfID"], "sp", ["l_quantity", "l_linenumber"], focal="R", blank="N")


@query("retro_correct", "WITH" + OBS_SQL + """,
pairs AS (SELECT DISTINCT destSiteID, SpeciesName AS sp_old, replace(SpeciesName, 'old ', 'aged ') AS sp_new
          FROM obs WHERE SpeciesName LIKE 'old %' AND Year = 1998 AND l_linenumber = 1)
SELECT o.destSiteID, o.Year, o.UniqueID, coalesce(p.sp_new, o.SpeciesName) AS SpeciesName, o.Cover
FROM obs o LEFT JOIN pairs p ON p.destSiteID = o.destSiteID AND p.sp_old = o.SpeciesName
""")
def retro_correct(spark, folder):
    df = obs(spark, folder)
    pairs = df.filter(
        F.col("SpeciesName").startswith("old ") & (F.col("Year") == 1998) & (F.col("l_linenumber") == 1)
    ).select(
        "destSiteID", F.col("SpeciesName").alias("sp_old"),
        F.regexp_replace("SpeciesName", "^old ", "aged ").alias("sp_new"),
    )
    rows = df.select("destSiteID", "Year", "UniqueID", "SpeciesName", "Cover")
    return K.retro_correct(rows, pairs, ["destSiteID"], "sp_old", "sp_new")


@query("quadrat_rollup", """
SELECT l_suppkey AS plot, l_partkey AS species, sum(l_quantity) AS cover
FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1, 2
""")
def quadrat_rollup(spark, folder):
    df = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("plot"), F.col("l_partkey").alias("species"),
        (F.col("l_returnflag") == "R").alias("is_focal"), F.col("l_quantity").alias("cover_cm2"),
    )
    return K.quadrat_rollup(df, ["plot", "species"])


@query("biomass_rollup", """
SELECT l_suppkey AS turfID, CAST(year(l_shipdate) AS INTEGER) AS year, l_partkey AS species,
       round(sum(CAST(l_tax AS DECIMAL(18,2)))::DOUBLE, 6) AS biomass
FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2, 3
""")
def biomass_rollup(spark, folder):
    comma = F.translate(F.col("l_tax").cast("decimal(6,2)").cast("string"), ".", ",")
    df = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("turfID"), F.year("l_shipdate").alias("year"), F.col("l_partkey").alias("species"),
        F.when(F.col("l_linestatus") == "F", "ctrl").otherwise("wet").alias("treatment"), comma.alias("bm"),
    )
    out = K.biomass_rollup(df, ["turfID", "year", "species"])
    return out.withColumn("biomass", F.round("biomass", 6))


@query("greenness", """
SELECT o_orderkey AS plot, 'VascCover' AS CoverClass, (o_custkey % 101)::DOUBLE AS OtherCover,
       100::DOUBLE AS Rel_OtherCover FROM orders
UNION ALL
SELECT o_orderkey, 'OtherCover', 100::DOUBLE - o_custkey % 101, 100 FROM orders
""")
def greenness(spark, folder):
    df = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("plot"), (F.col("o_custkey") % 101).alias("VascCover")
    )
    return K.greenness(df, ["plot"])


@query("stem_relative", """
WITH s AS (SELECT l_orderkey AS plot, l_linenumber, l_partkey,
                  coalesce(CASE WHEN l_returnflag <> 'A' THEN l_quantity END, 0)::DOUBLE AS Individuals FROM lineitem)
SELECT plot, l_linenumber, l_partkey, Individuals, Total_Cover, Individuals / Total_Cover AS Rel_Cover
FROM (SELECT *, sum(Individuals) OVER (PARTITION BY plot) AS Total_Cover FROM s)
WHERE Total_Cover > 0 AND Individuals > 0
""")
def stem_relative(spark, folder):
    df = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("plot"), "l_linenumber", "l_partkey",
        F.when(F.col("l_returnflag") != "A", F.col("l_quantity")).alias("Individuals"),
    )
    return K.stem_relative(df, ["plot"])


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("rule_table_join", "WITH" + VISITS_SQL + """
SELECT o_orderkey, Treatment FROM visits
""")
def rule_table_join(spark, folder):
    """Treatments looked up in a rule table with one row per (label, origin, destination)."""
    keys = ["origin_rank", "dest_rank", "destBlockID"]
    plots = visits(spark, folder)
    labels = spark.createDataFrame([(x,) for x in PRIORITIES], "destBlockID string")
    grid = labels.select("destBlockID", F.explode(F.sequence(F.lit(0), F.lit(24))).alias("pair")).select(
        "destBlockID", F.floor(F.col("pair") / 5).cast(plots.schema["origin_rank"].dataType).alias("origin_rank"),
        (F.col("pair") % 5).cast(plots.schema["origin_rank"].dataType).alias("dest_rank"),
    )
    rules = assign_treatment(
        grid, RULES, label="destBlockID", origin=F.lit(None), dest=F.lit(None), origin_rank="origin_rank", dest_rank="dest_rank",
    )
    return null_safe_join(plots, rules, keys).select("o_orderkey", "Treatment")
