"""Queries for traits.  Parts sold are measured plants; part keys name the plants."""

from pyspark.sql import functions as F

from ..functions.semantics import paste
from ..functions.text import clean_number
from ..operators import traits as Tr
from .mapping import table
from .registry import query

# Line items as leaves: region = ship year parity, site = line status, plant = supplier.
LEAF_SQL = """
leaf AS (
  SELECT CASE year(l_shipdate) % 2 WHEN 0 THEN 'even' ELSE 'odd' END AS Region, l_linestatus AS destSiteID,
         p_name AS SpeciesName, CAST(l_suppkey % 10 AS VARCHAR) AS PlantID,
         l_quantity AS Leaf_Area_cm2, CASE WHEN p_size > 5 THEN p_size::DOUBLE END AS SLA_cm2_g,
         CASE WHEN l_returnflag = 'A' THEN l_linenumber::DOUBLE END AS N_percent
  FROM lineitem JOIN part ON p_partkey = l_partkey
),
tall AS (
  SELECT Region, destSiteID, SpeciesName, PlantID, Trait, Value FROM (
    SELECT *, unnest(['Leaf_Area_cm2', 'SLA_cm2_g', 'N_percent']) AS Trait,
              unnest([Leaf_Area_cm2, SLA_cm2_g, N_percent]) AS Value FROM leaf) WHERE Value IS NOT NULL
),
plants AS (
  SELECT Region, destSiteID, SpeciesName, Trait, PlantID,
         sum(CAST(Value AS DECIMAL(18,4)))::DOUBLE / count(*) AS mValue FROM tall GROUP BY ALL
),
means AS (
  SELECT Region, destSiteID, SpeciesName, Trait, round(avg(mValue), 6) AS siteValue, count(*) AS nRep
  FROM plants GROUP BY ALL
)"""


def leaf_traits(spark, folder):
    lines = table(spark, folder, "lineitem")
    part = table(spark, folder, "part").select("p_partkey", "p_name", "p_size")
    df = lines.join(part, lines["l_partkey"] == part["p_partkey"]).select(
        F.when(F.year("l_shipdate") % 2 == 0, "even").otherwise("odd").alias("Region"),
        F.col("l_linestatus").alias("site"), F.col("p_name").alias("name"),
        (F.col("l_suppkey") % 10).cast("string").alias("plant"),
        F.col("l_quantity").alias("area"), F.col("p_size"), "l_returnflag", "l_linenumber",
    )
    return Tr.tidy_traits(
        df,
        {"site": "destSiteID", "name": "SpeciesName", "area": "Leaf_Area_cm2"},
        {
            "Leaf_Area_cm2": F.col("Leaf_Area_cm2"),
            "SLA_cm2_g": F.when(F.col("p_size") > 5, F.col("p_size")),
            "N_percent": F.when(F.col("l_returnflag") == "A", F.col("l_linenumber")),
        },
        ["Region", "destSiteID", "SpeciesName"],
        plant_id=F.col("plant"),
    )


@query("tidy_traits", """
WITH w AS (
  SELECT p_partkey, p_name AS SpeciesName, 'Star' AS Country, p_brand || '_' || p_partkey || '_' || p_name AS PlantID,
         p_retailprice AS Wet_Mass_g, p_size::DOUBLE AS Dry_Mass_g,
         CASE WHEN p_retailprice <> 0 THEN p_size::DOUBLE / p_retailprice END AS LDMC,
         CASE WHEN p_type <> 'PROMO' THEN p_size / 10.0::DOUBLE END AS Plant_Veg_Height_cm FROM part)
SELECT p_partkey, SpeciesName, Country, PlantID, Trait, round(Value, 9) AS Value FROM (
  SELECT *, unnest(['Wet_Mass_g', 'Dry_Mass_g', 'LDMC', 'Plant_Veg_Height_cm']) AS Trait,
            unnest([Wet_Mass_g, Dry_Mass_g, LDMC, Plant_Veg_Height_cm]) AS Value FROM w) WHERE Value IS NOT NULL
""")
def tidy_traits(spark, folder):
    """Text sheet with thousands commas, units and junk to long traits with derived LDMC."""
    price = F.format_number(F.col("p_retailprice"), 2)
    df = table(spark, folder, "part").select(
        "p_partkey", F.col("p_name").alias("species"), "p_brand",
        F.concat(price, F.lit(" g")).alias("leaf.fresh.weight"),
        F.concat(F.lit("~"), F.col("p_size").cast("string")).alias("leaf.dry.weight"),
        F.when(F.col("p_type") == "PROMO", "n/a").otherwise(F.concat(F.col("p_size").cast("string"), F.lit("mm")))
        .alias("height"),
    )
    out = Tr.tidy_traits(
        df,
        {"species": "SpeciesName", "leaf.fresh.weight": "wet", "leaf.dry.weight": "dry"},
        {
            "Wet_Mass_g": clean_number("wet"), "Dry_Mass_g": clean_number("dry"), "LDMC": Tr.ldmc(),
            "Plant_Veg_Height_cm": clean_number("height") / 10,
        },
        ["p_partkey", "SpeciesName"],
        {"Country": "Star"},
        plant_id=paste("p_brand", "p_partkey", "SpeciesName"),
    )
    return out.withColumn("Value", F.round("Value", 9))


@query("derive_traits", """
SELECT p_partkey, p_size / p_retailprice AS LDMC, CASE WHEN p_size <> 25 THEN 10.0::DOUBLE / (p_size - 25) END AS SLA_cm2_g,
       p_retailprice / p_size AS CN_ratio FROM part
""")
def derive_traits(spark, folder):
    df = table(spark, folder, "part").select(
        "p_partkey", F.col("p_size").alias("Dry_Mass_g"), F.col("p_retailprice").alias("Wet_Mass_g"),
        F.lit(10.0).alias("Leaf_Area_cm2"), (F.col("p_size") - 25).alias("shifted"),
    )
    out = Tr.derive_traits(df, {
        "LDMC": Tr.ldmc(), "SLA_cm2_g": Tr.sla("Leaf_Area_cm2", "shifted"),
        "CN_ratio": Tr.cn_ratio("Wet_Mass_g", "Dry_Mass_g"),
    })
    return out.select("p_partkey", "LDMC", "SLA_cm2_g", "CN_ratio")


@query("merge_site_traits", """
SELECT 'parts' AS Region, p_name AS SpeciesName, CAST(NULL AS INTEGER) AS Year, p_retailprice AS Value FROM part
UNION ALL
SELECT 'orders', CAST(NULL AS VARCHAR), CAST(year(o_orderdate) AS INTEGER), o_totalprice FROM orders
""")
def merge_site_traits(spark, folder):
    parts = table(spark, folder, "part").select(
        F.col("p_name").alias("SpeciesName"), F.col("p_retailprice").alias("Value")
    )
    orders = table(spark, folder, "orders").select(
        F.year("o_orderdate").cast("long").alias("Year"), F.col("o_totalprice").alias("Value")
    )
    return Tr.merge_site_traits({"parts": parts, "orders": orders})


@query("mean_of_means", "WITH" + LEAF_SQL + " SELECT * FROM means")
def mean_of_means(spark, folder):
    out = Tr.mean_of_means(leaf_traits(spark, folder))
    return out.withColumn("siteValue", F.round("siteValue", 6))


WIDE_SQL = LEAF_SQL + """,
wide AS (
  SELECT Region, destSiteID, SpeciesName,
         CAST(NULL AS DOUBLE) AS Plant_Veg_Height_cm,
         max(CASE Trait WHEN 'Leaf_Area_cm2' THEN siteValue END) AS Leaf_Area_cm2,
         max(CASE Trait WHEN 'SLA_cm2_g' THEN siteValue END) AS SLA_cm2_g,
         CAST(NULL AS DOUBLE) AS C_percent,
         max(CASE Trait WHEN 'N_percent' THEN siteValue END) AS N_percent
  FROM means GROUP BY 1, 2, 3
)"""


def site_wide(spark, folder):
    means = Tr.mean_of_means(leaf_traits(spark, folder)).withColumn("siteValue", F.round("siteValue", 6))
    return Tr.spread_traits(means)


@query("spread_traits", "WITH" + WIDE_SQL + " SELECT * FROM wide")
def spread_traits(spark, folder):
    return site_wide(spark, folder)


@query("gapfill_traits", "WITH" + WIDE_SQL + """,
db AS (
  SELECT p_partkey, CASE p_partkey % 2 WHEN 0 THEN 'even' ELSE 'odd' END AS Region, 'O' AS destSiteID,
         CASE WHEN p_size > 40 THEN NULL ELSE p_name END AS accepted_name, p_retailprice AS leaf_area,
         p_size::DOUBLE AS leaf_C, 1.5::DOUBLE AS leaf_N, 0.1::DOUBLE AS leaf_P, p_retailprice * 2 AS plant_height
  FROM part
)
SELECT db.p_partkey, db.Region, db.destSiteID, db.accepted_name AS SpeciesName, db.plant_height AS Plant_Veg_Height_cm,
       coalesce(w.Leaf_Area_cm2, db.leaf_area) AS Leaf_Area_cm2, coalesce(w.SLA_cm2_g, 7) AS SLA_cm2_g,
       db.leaf_C AS C_percent, coalesce(w.N_percent, db.leaf_N) AS N_percent, db.leaf_P AS P_percent
FROM wide w RIGHT JOIN db ON db.Region = w.Region AND db.destSiteID = w.destSiteID AND db.accepted_name = w.SpeciesName
""")
def gapfill_traits(spark, folder):
    part = table(spark, folder, "part")
    database = part.select(
        "p_partkey", F.when(F.col("p_partkey") % 2 == 0, "even").otherwise("odd").alias("Region"),
        F.lit("O").alias("destSiteID"), F.when(F.col("p_size") <= 40, F.col("p_name")).alias("accepted_name"),
        F.col("p_retailprice").alias("leaf_area"), F.col("p_size").cast("double").alias("leaf_C"),
        F.lit(1.5).alias("leaf_N"), F.lit(0.1).alias("leaf_P"), (F.col("p_retailprice") * 2).alias("plant_height"),
        F.lit(None).cast("double").alias("seed_mass"), F.lit(7.0).alias("SLA"),
        F.lit(None).cast("double").alias("stem_density"),
    )
    out = Tr.gapfill_traits(site_wide(spark, folder), database)
    return out.select("p_partkey", "Region", "destSiteID", "SpeciesName", *Tr.SITE_TRAITS, "P_percent")
