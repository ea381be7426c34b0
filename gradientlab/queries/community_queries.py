"""Queries for the community operators."""

import uuid

from pyspark.sql import functions as F

from ..functions.semantics import null_safe_join, number_text
from ..operators import community as C
from ..operators.samples import store_samples, stored_relative_cover
from .mapping import (
    OBS_SQL, RULES, SITES, SITES_SQL, VISITS_SQL, obs, site_table, table, treated_visits, visits,
)
from .registry import query

CLASS_LABELS = {"PROMO": "Litter", "ECONOMY": "Moss"}
CLASSED_SQL = OBS_SQL + """,
classed AS (
  SELECT UniqueID, CASE p_type WHEN 'PROMO' THEN 'PROMO' WHEN 'ECONOMY' THEN 'ECONOMY'
                   ELSE SpeciesName END AS SpeciesName, Cover
  FROM obs
),
rel AS (
  SELECT c.*, Cover / sum(Cover) OVER (PARTITION BY UniqueID) AS Rel_Cover FROM classed c
)"""


def _relative_lines(spark, folder, residual):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", F.col("l_quantity").alias("Cover"))
    return C.relative_cover(lines, ["l_orderkey"], residual=residual)


def _records(spark, folder):
    """Records by sample, the sample key being found from the order alone."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", F.col("l_quantity").alias("Cover"))
    plots = treated_visits(spark, folder).select("o_orderkey", "UniqueID")
    part = table(spark, folder, "part").select("p_partkey", F.col("p_name").alias("SpeciesName"))
    return lines.join(plots, lines["l_orderkey"] == plots["o_orderkey"]).join(
        part, lines["l_partkey"] == part["p_partkey"]).select("UniqueID", "SpeciesName", "Cover")


def _classed(spark, folder):
    name = F.when(F.col("p_type").isin(list(CLASS_LABELS)), F.col("p_type")).otherwise(F.col("SpeciesName"))
    return obs(spark, folder).select("UniqueID", name.alias("SpeciesName"), "Cover")


@query("merge_community", "WITH" + OBS_SQL + "," + SITES_SQL + """,
tot AS (SELECT l_orderkey, sum(l_quantity) AS s FROM lineitem GROUP BY 1)
SELECT o.Region, o.Year, o.originSiteID, CAST(NULL AS VARCHAR) AS originBlockID, o.destSiteID, o.destBlockID,
       o.destPlotID, o.Treatment, o.turfID, o.UniqueID, o.SpeciesName, o.Cover,
       o.Cover / greatest(100, tot.s) AS Rel_Cover, s.Elevation
FROM obs o JOIN tot ON tot.l_orderkey = o.l_orderkey
LEFT JOIN sites s ON s.Region = o.Region AND s.destSiteID = o.destSiteID
WHERE o.Treatment NOT IN ('NettedControl', 'Cold', 'Control') AND o.Cover > 0
""")
def merge_community(spark, folder):
    """Relative abundance by region, site, year, plot and species, with elevation.

    The relative cover is computed on the line items alone and the sites are
    joined on the same order key, so the line items are shuffled once for both.
    """
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", F.col("l_quantity").alias("Cover")
    )
    rel = C.relative_cover(lines, ["l_orderkey"], residual=True)
    plots = treated_visits(spark, folder)
    part = table(spark, folder, "part").select("p_partkey", F.col("p_name").alias("SpeciesName"))
    records = (
        rel.join(plots, rel["l_orderkey"] == plots["o_orderkey"])
        .join(part, rel["l_partkey"] == part["p_partkey"])
        .withColumn("turfID", F.col("l_suppkey").cast("string"))
    )
    community, _ = C.split_community(records, [C.OTHER])
    return C.merge_community(community, site_table(spark, folder))


@query("relative_cover", """
SELECT l_orderkey, l_partkey, l_quantity AS Cover, sum(l_quantity) OVER (PARTITION BY l_orderkey) AS Total_Cover,
       l_quantity / sum(l_quantity) OVER (PARTITION BY l_orderkey) AS Rel_Cover FROM lineitem
""")
def relative_cover(spark, folder):
    return _relative_lines(spark, folder, False)


@query("relative_cover_residual", """
SELECT l_orderkey, l_partkey, l_quantity AS Cover,
       greatest(100::DOUBLE, sum(l_quantity) OVER (PARTITION BY l_orderkey)) AS Total_Cover,
       l_quantity / greatest(100, sum(l_quantity) OVER (PARTITION BY l_orderkey)) AS Rel_Cover FROM lineitem
""")
def relative_cover_residual(spark, folder):
    return _relative_lines(spark, folder, True)


@query("stored_cover", """
SELECT l_orderkey, l_partkey, l_quantity AS Cover,
       greatest(100::DOUBLE, sum(l_quantity) OVER (PARTITION BY l_orderkey)) AS Total_Cover,
       l_quantity / greatest(100, sum(l_quantity) OVER (PARTITION BY l_orderkey)) AS Rel_Cover FROM lineitem
""")
def stored_cover(spark, folder):
    """Relative cover of a survey that is stored by sample: no exchange of records after that."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", F.col("l_quantity").alias("Cover"))
    store = store_samples(lines, f"survey_{uuid.uuid4().hex[:12]}", ["l_orderkey"])
    return stored_relative_cover(store, spark)


@query("residual_rows", "WITH" + OBS_SQL + """
SELECT UniqueID, 'Other' AS SpeciesName, greatest(100 - sum(Cover), 0::DOUBLE) AS Cover,
       greatest(100::DOUBLE, sum(Cover)) AS Total_Cover,
       greatest(100 - sum(Cover), 0) / greatest(100, sum(Cover)) AS Rel_Cover
FROM obs GROUP BY UniqueID
""")
def residual_rows(spark, folder):
    return C.residual_rows(obs(spark, folder).select("UniqueID", "SpeciesName", "Cover"), ["UniqueID"])


@query("residual_cover", "WITH" + OBS_SQL + """
SELECT UniqueID, SpeciesName, Cover FROM obs
UNION ALL SELECT UniqueID, 'Other', greatest(100 - sum(Cover), 0::DOUBLE) FROM obs GROUP BY UniqueID
""")
def residual_cover(spark, folder):
    return C.residual_cover(_records(spark, folder), ["UniqueID"])


@query("split_community", "WITH" + CLASSED_SQL + """
SELECT 'community' AS part, UniqueID, SpeciesName, Cover FROM classed
WHERE SpeciesName NOT IN ('PROMO', 'ECONOMY') AND Cover > 0
UNION ALL
SELECT 'cover', UniqueID, CASE SpeciesName WHEN 'PROMO' THEN 'Litter' ELSE 'Moss' END, Cover FROM classed
WHERE SpeciesName IN ('PROMO', 'ECONOMY')
""")
def split_community(spark, folder):
    return C.tag_community(_classed(spark, folder), list(CLASS_LABELS), CLASS_LABELS)


@query("cover_summary", "WITH" + CLASSED_SQL + """
SELECT UniqueID, CASE SpeciesName WHEN 'PROMO' THEN 'Litter' ELSE 'Moss' END AS CoverClass,
       sum(Cover) AS OtherCover, round(sum(Rel_Cover), 6) AS Rel_OtherCover
FROM rel WHERE SpeciesName IN ('PROMO', 'ECONOMY') GROUP BY 1, 2
""")
def cover_summary(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", F.col("l_quantity").alias("Cover"))
    rel = C.relative_cover(lines, ["l_orderkey"], residual=False)  # an order is a sample
    classes = table(spark, folder, "part").filter(F.col("p_type").isin(list(CLASS_LABELS)))
    classes = classes.select("p_partkey", F.col("p_type").alias("SpeciesName"))
    plots = treated_visits(spark, folder).select("o_orderkey", "UniqueID")
    rel = rel.join(classes, rel["l_partkey"] == classes["p_partkey"]).join(plots, rel["l_orderkey"] == plots["o_orderkey"])
    _, cover = C.split_community(rel, list(CLASS_LABELS), CLASS_LABELS)
    return C.cover_summary(cover).withColumn("Rel_OtherCover", F.round("Rel_OtherCover", 6))


@query("assign_treatment", "WITH" + VISITS_SQL + """
SELECT Region, originSiteID, destSiteID, destBlockID, Treatment, count(*) AS n FROM visits GROUP BY ALL
""")
def assign_treatment(spark, folder):
    df = C.assign_treatment(
        visits(spark, folder), RULES, label="destBlockID", origin_rank="origin_rank", dest_rank="dest_rank"
    )
    return df.groupBy("Region", "originSiteID", "destSiteID", "destBlockID", "Treatment").agg(
        F.count(F.lit(1)).alias("n")
    )


def _decode_sql(scale):
    cases = " ".join(f"WHEN {k} THEN {v}::DOUBLE" for k, v in scale.items())
    return f"""
SELECT class_no, CASE class_no {cases} ELSE class_no END AS Cover, count(*) AS n
FROM (SELECT CASE WHEN l_linenumber = 1 THEN l_quantity / 4 WHEN l_linenumber = 2 THEN NULL
             ELSE l_quantity - 1 END AS class_no FROM lineitem) GROUP BY 1, 2"""


def _decode(scale):
    def run(spark, folder):
        line, quantity = F.col("l_linenumber"), F.col("l_quantity")  # fractions, 0, missing ones and numbers off the scale too
        df = table(spark, folder, "lineitem").select(
            F.when(line == 1, quantity / 4).when(line != 2, quantity - 1).alias("class_no"))
        return C.decode_cover(df, scale, "class_no", "Cover").groupBy("class_no", "Cover").agg(
            F.count(F.lit(1)).alias("n")
        )
    return run


for _name, _scale in (("10", C.SCALE_10), ("11", C.SCALE_11), ("13", C.SCALE_13)):
    query(f"decode_cover_{_name}", _decode_sql(_scale))(_decode(_scale))


@query("decode_cover_letters", """
SELECT letter, CASE letter WHEN '1' THEN 3.5::DOUBLE WHEN '3' THEN 37.5 WHEN '4' THEN 62.5 WHEN '5' THEN 87.5
       WHEN '2a' THEN 10 WHEN '2b' THEN 20 WHEN '+' THEN 0.5 WHEN 'r' THEN 0.1 END AS Cover, count(*) AS n
FROM (SELECT CASE split_part(o_orderpriority, '-', 1)
             WHEN '2' THEN CASE o_orderstatus WHEN 'F' THEN '2a' WHEN 'O' THEN '2b' ELSE '2' END
             ELSE split_part(o_orderpriority, '-', 1) END AS letter FROM orders) GROUP BY 1, 2
""")
def decode_cover_letters(spark, folder):
    digit = F.split("o_orderpriority", "-").getItem(0)
    status = F.col("o_orderstatus")
    letter = F.when(
        digit == "2", F.when(status == "F", "2a").when(status == "O", "2b").otherwise("2")
    ).otherwise(digit)
    df = table(spark, folder, "orders").select(letter.alias("letter"))
    return C.decode_cover(df, C.SCALE_LETTERS, "letter", "Cover").groupBy("letter", "Cover").agg(
        F.count(F.lit(1)).alias("n")
    )


@query("build_ids", "WITH" + VISITS_SQL + """
SELECT o_orderkey, concat_ws('_', originSiteID, destSiteID, destBlockID) AS destPlotID,
       concat_ws('_', originSiteID, destSiteID, destBlockID, Year) AS UniqueID FROM visits
""")
def build_ids(spark, folder):
    df = visits(spark, folder).drop("destPlotID")
    df = C.build_ids(df, {
        "destPlotID": ["originSiteID", "destSiteID", "destBlockID"], "UniqueID": ["destPlotID", "Year"],
    })
    return df.select("o_orderkey", "destPlotID", "UniqueID")


@query("collapse_duplicates", "WITH" + OBS_SQL + """
SELECT destSiteID, Year, SpeciesName, sum(Cover) AS Cover
FROM (SELECT DISTINCT destSiteID, Year, SpeciesName, Cover FROM obs) GROUP BY 1, 2, 3
""")
def collapse_duplicates(spark, folder):
    df = obs(spark, folder).select("destSiteID", "Year", "SpeciesName", "Cover")
    return C.collapse_duplicates(df, ["destSiteID", "Year", "SpeciesName"])


@query("site_meta", "WITH" + VISITS_SQL + "," + SITES_SQL + """
SELECT 'Star' AS Gradient, v.destSiteID, round(any_value(s.Longitude), 6) AS Longitude,
       round(any_value(s.Latitude), 6) AS Latitude, any_value(s.Elevation) AS Elevation,
       1990 AS YearEstablished, min(v.Year) AS YearMin, max(v.Year) AS YearMax,
       max(v.Year) - 1990 AS YearRange, 0.25::DOUBLE AS PlotSize_m2, 'Nowhere' AS Country
FROM visits v LEFT JOIN sites s ON s.destSiteID = v.destSiteID GROUP BY v.destSiteID
""")
def site_meta(spark, folder):
    df = C.site_meta(visits(spark, folder), SITES, "Star", "Nowhere", 1990, 0.25)
    return df.withColumns({c: F.round(c, 6) for c in ("Longitude", "Latitude")})


@query("taxa_list", "SELECT DISTINCT p_name AS SpeciesName FROM part")
def taxa_list(spark, folder):
    return C.taxa_list(table(spark, folder, "part").select(F.col("p_name").alias("SpeciesName")))


@query("site_species", "WITH" + OBS_SQL + " SELECT DISTINCT Region, destSiteID, SpeciesName FROM obs")
def site_species(spark, folder):
    return C.site_species(obs(spark, folder))


@query("union_by_name", """
SELECT 'customers' AS Region, c_custkey AS row_id, c_acctbal AS Cover, CAST(NULL AS VARCHAR) AS SpeciesName,
       c_mktsegment AS label FROM customer
UNION ALL
SELECT 'parts', p_partkey, p_retailprice, p_name, NULL FROM part
""")
def union_by_name(spark, folder):
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("row_id"), F.col("c_acctbal").alias("Cover"), F.col("c_mktsegment").alias("label")
    )
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("row_id"), F.col("p_retailprice").alias("Cover"), F.col("p_name").alias("SpeciesName")
    )
    return C.union_tagged({"customers": customers, "parts": parts}, types={"Cover": "double"})


@query("site_elevation_join", "WITH" + VISITS_SQL + "," + SITES_SQL + """
SELECT v.Region, v.destSiteID, v.UniqueID, s.Elevation FROM visits v
LEFT JOIN sites s ON s.Region = v.Region AND s.destSiteID = v.destSiteID
""")
def site_elevation_join(spark, folder):
    df = treated_visits(spark, folder).select("Region", "destSiteID", "UniqueID")
    meta = site_table(spark, folder).select("Region", "destSiteID", "Elevation").distinct()
    return null_safe_join(df, meta, ["Region", "destSiteID"])


@query("relative_cover_by_exclusion", """
SELECT l_orderkey, l_suppkey, l_partkey AS SpeciesName, l_quantity AS Cover,
       sum(l_quantity) OVER (PARTITION BY l_orderkey, l_suppkey) AS Total_Cover,
       l_quantity / sum(l_quantity) OVER (PARTITION BY l_orderkey, l_suppkey) AS Rel_Cover FROM lineitem
""")
def relative_cover_by_exclusion(spark, folder):
    """The sample is every column but species and cover."""
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_suppkey", F.col("l_partkey").alias("SpeciesName"), F.col("l_quantity").alias("Cover"))
    return C.relative_cover(lines, residual=False)


@query("number_text", """
SELECT l_orderkey, l_linenumber, CAST(l_orderkey * 100000 AS VARCHAR) AS large,
       CASE l_linenumber % 2 WHEN 0 THEN '0.0001' ELSE CAST(l_linenumber AS VARCHAR) END AS small FROM lineitem
""")
def number_text_query(spark, folder):
    """Numbers from 1e7 up and below 1e-3 print without an exponent."""
    line = F.col("l_linenumber")
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", number_text((F.col("l_orderkey") * 100000).cast("double")).alias("large"),
        number_text(F.when(line % 2 == 0, F.lit(0.0001)).otherwise(line.cast("double"))).alias("small"))
