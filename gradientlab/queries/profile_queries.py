"""Regional profiles and the products built from them, on star tables laid out as raw sheets.

A line item is one record, its order the plot.  The SQL states the published
rules on the same sheets.
"""

from pyspark.sql import functions as F

from ..operators.climate import LAPSE_RATE
from ..plans import products as P
from ..plans.profile import build_bundle
from ..plans.regions import PROFILES
from ..session import stage_table
from ..sources.relational import TURF_RECORDS, recorder_totals, run_sql
from .mapping import table
from .registry import query
from .taxonomy_queries import backbone, trait_list

SHEET_SQL = """
sheet AS (
  SELECT l_orderkey AS k, l_linenumber, l_returnflag, CAST(l_quantity AS INTEGER) AS q, p_partkey,
         CASE p_type WHEN 'PROMO' THEN 'litter' WHEN 'ECONOMY' THEN 'Moss' ELSE
           CASE p_partkey % 7 WHEN 1 THEN '?' || p_name || 'zzz' WHEN 2 THEN p_name || 'q' ELSE p_name END END AS name
  FROM lineitem JOIN part ON p_partkey = l_partkey
)"""
DAMXUNG_SQL = SHEET_SQL + """,
turf AS (
  SELECT CAST(2013 + k % 4 AS INTEGER) AS Year, CASE k // 2 % 2 WHEN 0 THEN 'LOW' ELSE 'HIGH' END AS originSiteID,
         CASE k % 2 WHEN 0 THEN 'LOW' ELSE 'HIGH' END AS destSiteID, CAST(k % 3 AS VARCHAR) AS destBlockID,
         CAST(k AS VARCHAR) AS destPlotID, name AS SpeciesName,
         CASE q % 13 WHEN 1 THEN 0.5::DOUBLE WHEN 2 THEN 1 WHEN 3 THEN 3.5 WHEN 4 THEN 8 WHEN 5 THEN 15.5 WHEN 6 THEN 25.5
              WHEN 7 THEN 35.5 WHEN 8 THEN 45.5 WHEN 9 THEN 55.5 WHEN 10 THEN 80 ELSE q % 13 END AS Cover
  FROM sheet
),
damxung AS (
  SELECT *, concat_ws('_', Year, originSiteID, destSiteID, destPlotID) AS UniqueID,
         CASE WHEN originSiteID = destSiteID THEN 'LocalControl' WHEN originSiteID = 'HIGH' THEN 'Warm' END AS Treatment,
         sum(Cover) OVER (PARTITION BY destPlotID) AS s FROM turf
),
damxung_community AS (
  SELECT Year, originSiteID, destSiteID, destBlockID, destPlotID, UniqueID, Treatment, SpeciesName, Cover,
         greatest(100::DOUBLE, s) AS Total_Cover, Cover / greatest(100, s) AS Rel_Cover
  FROM damxung WHERE SpeciesName NOT IN ('litter', 'Moss') AND Cover > 0
)"""
SUSALPS_SQL = """
harvest AS (
  SELECT CASE WHEN name = 'litter' THEN 'Dead biomass' ELSE name END AS SpeciesName, CAST(k AS VARCHAR) AS destPlotID, 2017 AS Year,
         ['BT', 'EB', 'FE', 'GW'][k % 4 + 1] AS originSiteID, ['BT', 'EB', 'FE', 'GW'][k // 4 % 4 + 1] AS destSiteID, sum(q) / 4 AS Cover
  FROM sheet WHERE l_returnflag <> 'A' GROUP BY ALL
),
susalps_community AS (
  SELECT Year, originSiteID, destSiteID, destPlotID, concat_ws('_', Year, originSiteID, destSiteID, destPlotID) AS UniqueID,
         CASE WHEN originSiteID = destSiteID THEN 'LocalControl'
              WHEN originSiteID || destSiteID IN ('EBBT', 'EBFE', 'EBGW', 'FEBT', 'GWBT', 'GWFE') THEN 'Warm' END AS Treatment,
         SpeciesName, Cover, Total_Cover, Cover / Total_Cover AS Rel_Cover
  FROM (SELECT *, sum(Cover) OVER (PARTITION BY destPlotID) AS Total_Cover FROM harvest)
  WHERE SpeciesName NOT IN ('Moss', 'Dead biomass') AND Cover > 0
)"""
ARIZONA_SQL = """
stems AS (
  SELECT k, unnest(['ACMI', 'CARX', 'POPR']) AS SpeciesName,
         unnest([sum(q) FILTER (l_returnflag = 'A'), sum(q) FILTER (l_returnflag = 'N'), sum(q) FILTER (l_returnflag = 'R')])::DOUBLE AS n
  FROM sheet GROUP BY k
),
arizona_community AS (
  SELECT Year, "Date", originSiteID, destSiteID, Treatment, destPlotID, UniqueID, SpeciesName, n AS Individuals, Total_Cover,
         n / Total_Cover AS Rel_Cover
  FROM (
    SELECT *, sum(n) OVER (PARTITION BY k) AS Total_Cover, concat_ws('_', originSiteID, destSiteID, plotID) AS destPlotID,
           concat_ws('_', Year, originSiteID, destSiteID, plotID) AS UniqueID
    FROM (SELECT k, SpeciesName, n, CAST(2014 + k % 3 AS INTEGER) AS Year, 'd' || k % 9 AS "Date", CASE k % 2 WHEN 0 THEN 'MC' ELSE 'PP' END AS originSiteID,
                 CASE k // 2 % 2 WHEN 0 THEN 'MC' ELSE 'PP' END AS destSiteID,
                 CASE k // 2 % 2 WHEN 0 THEN 'MC' ELSE 'PP' END || k AS plotID,
                 CASE k % 3 WHEN 0 THEN 'Warm' ELSE 'LocalControl' END AS Treatment FROM stems))
  WHERE n > 0
)"""
DAT_SQL = DAMXUNG_SQL + "," + SUSALPS_SQL + "," + ARIZONA_SQL + """,
places(Region, destSiteID, Elevation) AS (
  VALUES ('CN_Damxung', 'HIGH', 4800::DOUBLE), ('CN_Damxung', 'LOW', 4313), ('DE_Susalps', 'BT', 350), ('DE_Susalps', 'FE', 600),
         ('DE_Susalps', 'GW', 860), ('DE_Susalps', 'EB', 1260), ('US_Arizona', 'MC', 2620), ('US_Arizona', 'PP', 2344)),
dat AS (
  SELECT 'CN_Damxung' AS Region, Year, originSiteID, destSiteID, destBlockID, destPlotID, Treatment, UniqueID, SpeciesName, Cover, Rel_Cover
  FROM damxung_community
  UNION ALL SELECT 'DE_Susalps', Year, originSiteID, destSiteID, NULL, destPlotID, Treatment, UniqueID, SpeciesName, Cover, Rel_Cover
  FROM susalps_community
  UNION ALL SELECT 'US_Arizona', Year, originSiteID, destSiteID, NULL, destPlotID, Treatment, UniqueID, SpeciesName, NULL, Rel_Cover
  FROM arizona_community
)"""


def _sheet(spark, folder):
    part = table(spark, folder, "part").select("p_partkey", "p_type", "p_name")
    odd = F.col("p_partkey") % 7
    plain = F.when(odd == 1, F.concat(F.lit("?"), "p_name", F.lit("zzz"))).when(odd == 2, F.concat("p_name", F.lit("q"))).otherwise(F.col("p_name"))
    name = F.when(F.col("p_type") == "PROMO", "litter").when(F.col("p_type") == "ECONOMY", "Moss").otherwise(plain)
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("k"), "l_linenumber", "l_partkey", "l_returnflag", F.col("l_quantity").cast("int").alias("q"))
    return lines.join(part.select("p_partkey", name.alias("name")), F.col("l_partkey") == F.col("p_partkey"))


def _stored_sheet(spark, folder):
    """The sheet written once, for what reads it many times."""
    return stage_table(_sheet(spark, folder).select("k", "l_linenumber", "l_returnflag", "q", "name"), "surveys/sheet")


def _pick(column, *values):
    return F.get(F.array(*[F.lit(v) for v in values]), column.cast("int"))


def _half(n):
    return F.floor(F.col("k") / F.lit(n))


def _damxung(spark, folder, sheet=None):
    k = F.col("k")
    sheet = (sheet or _sheet(spark, folder)).select(
        _pick(k % 2, "LOW", "HIGH").alias("SITE"), (k % 3).cast("int").alias("BLOCK"), F.lit(1).alias("PLOT"),
        k.cast("string").alias("PLOT.ID"), _pick(_half(2) % 2, "low_turf", "high_turf").alias("TREATMENT"),
        (k % 4 + 2013).cast("int").alias("YEAR"), F.col("name").alias("Species name"), (F.col("q") % 13).alias("cover class"),
    )
    return build_bundle(PROFILES["CN_Damxung"], {"community": sheet})


def _susalps(spark, folder, sheet=None):
    k, q, sites = F.col("k"), F.col("q"), ("BT", "EB", "FE", "GW")
    sheet = (sheet or _sheet(spark, folder)).select(
        k.alias("Plot_label"), _pick(k % 4, *sites).alias("Origin_site"), _pick(_half(4) % 4, *sites).alias("Transplant_site"),
        F.when(F.col("name") == "litter", "Dead biomass").otherwise(F.col("name")).alias("Species_name"), F.lit("2017 June").alias("Harvest_title"),
        F.when(F.col("l_returnflag") != "A", "ctrl").otherwise("wet").alias("treatment"),
        F.concat_ws(",", F.floor(q / 4).cast("string"), F.lpad((q % 4 * 25).cast("string"), 2, "0")).alias("bm"),
    )
    return build_bundle(PROFILES["DE_Susalps"], {"community": sheet})


def _arizona(spark, folder, sheet=None):
    k = F.col("k")
    stems = lambda flag: F.sum(F.when(F.col("l_returnflag") == flag, F.col("q"))).cast("double")
    wide = (sheet or _sheet(spark, folder)).groupBy("k").agg(stems("A").alias("ACMI"), stems("N").alias("CARX"), stems("R").alias("POPR"))
    site = _pick(_half(2) % 2, "MC", "PP")
    sheet = wide.select(
        (k % 3 + 2014).cast("int").alias("Year"), F.concat(F.lit("d"), (k % 9).cast("string")).alias("Date Collected"),
        _pick(k % 2, "MC", "PP").alias("Ecosystem"), F.when(k % 3 == 0, "Warming").otherwise("Control").alias("Warming.Treat"),
        F.concat(site, k.cast("string")).alias("Plot"), F.lit(1).alias("Teabag number"), F.lit("x").alias("other project"), "ACMI", "CARX", "POPR",
    )
    raw = {
        "community": sheet, "greenness": sheet.drop("ACMI", "CARX", "POPR").withColumn("% cover at peak biomass", F.lit(35.0)),
        "species_list": spark.createDataFrame([("Achillea", "millefolium")], "Genus string, Species string"),
        "ignored_columns": ["other project"],
    }
    return build_bundle(PROFILES["US_Arizona"], raw)


def _bundles(spark, folder):
    sheet = _stored_sheet(spark, folder)
    return {
        "CN_Damxung": _damxung(spark, folder, sheet), "DE_Susalps": _susalps(spark, folder, sheet),
        "US_Arizona": _arizona(spark, folder, sheet)}


@query("profile_damxung", "WITH" + DAMXUNG_SQL + " SELECT * FROM damxung_community")
def profile_damxung(spark, folder):
    """Cover classes, with a residual row in the totals."""
    return _damxung(spark, folder).community


@query("profile_damxung_cover", "WITH" + DAMXUNG_SQL + """,
classes AS (
  SELECT UniqueID, CASE SpeciesName WHEN 'litter' THEN 'Litter' ELSE SpeciesName END AS CoverClass, Cover, Cover / greatest(100, s) AS Rel_Cover
  FROM damxung WHERE SpeciesName IN ('litter', 'Moss')
  UNION ALL SELECT UniqueID, 'Other', greatest(100 - sum(Cover), 0), greatest(100 - sum(Cover), 0) / greatest(100, sum(Cover))
  FROM damxung GROUP BY UniqueID
)
SELECT UniqueID, CoverClass, sum(Cover) AS OtherCover, round(sum(Rel_Cover), 6) AS Rel_OtherCover FROM classes GROUP BY 1, 2
""")
def profile_damxung_cover(spark, folder):
    return _damxung(spark, folder).cover.withColumn("Rel_OtherCover", F.round("Rel_OtherCover", 6))


@query("profile_susalps", "WITH" + SHEET_SQL + "," + SUSALPS_SQL + " SELECT * FROM susalps_community")
def profile_susalps(spark, folder):
    """Biomass with decimal commas, control rows only, added up per species and plot."""
    return _susalps(spark, folder).community.drop("destBlockID")


@query("profile_arizona", "WITH" + SHEET_SQL + "," + ARIZONA_SQL + " SELECT * FROM arizona_community")
def profile_arizona(spark, folder):
    """Stem counts of a wide sheet."""
    return _arizona(spark, folder).community.drop("destBlockID")


@query("profile_meta", "WITH" + DAMXUNG_SQL + """
SELECT 'CN_Damxung' AS Gradient, destSiteID, CASE destSiteID WHEN 'HIGH' THEN 91.05491 ELSE 91.0646299 END::DOUBLE AS Longitude,
       CASE destSiteID WHEN 'HIGH' THEN 30.53141 ELSE 30.4971 END::DOUBLE AS Latitude, CASE destSiteID WHEN 'HIGH' THEN 4800 ELSE 4313 END::DOUBLE AS Elevation,
       2013 AS YearEstablished, min(Year)::INTEGER AS YearMin, max(Year)::INTEGER AS YearMax, (max(Year) - 2013)::INTEGER AS YearRange,
       0.25::DOUBLE AS PlotSize_m2, 'China' AS Country FROM damxung_community GROUP BY destSiteID
""")
def profile_meta(spark, folder):
    return _damxung(spark, folder).meta


@query("product_dat", "WITH" + DAT_SQL + """
SELECT dat.Region, Year, originSiteID, CAST(NULL AS VARCHAR) AS originBlockID, dat.destSiteID, destBlockID, destPlotID, Treatment,
       CAST(NULL AS VARCHAR) AS turfID, UniqueID, SpeciesName, Cover, Rel_Cover, Elevation
FROM dat LEFT JOIN places p ON p.Region = dat.Region AND p.destSiteID = dat.destSiteID
WHERE Treatment IS NULL OR Treatment NOT IN ('NettedControl', 'Cold', 'Control')
""")
def product_dat(spark, folder):
    """The merged community of three regions of different kinds."""
    return P.dat(_bundles(spark, folder))


@query("product_cleaned_species", "WITH" + DAT_SQL + """,
census AS (SELECT DISTINCT Region, destSiteID, SpeciesName FROM dat),
known AS (SELECT p_name AS matched_name, min(p_partkey) AS gni_uuid FROM part GROUP BY 1),
near AS (
  SELECT n.SpeciesName, matched_name, gni_uuid, levenshtein(n.SpeciesName, matched_name) AS distance
  FROM (SELECT DISTINCT SpeciesName FROM census) n, known WHERE levenshtein(n.SpeciesName, matched_name) <= 2
),
best AS (SELECT * FROM near QUALIFY row_number() OVER (PARTITION BY SpeciesName ORDER BY distance, matched_name) = 1)
SELECT c.Region, c.destSiteID, c.SpeciesName, coalesce(b.matched_name, c.Region || '_NID_') AS matched_name, b.gni_uuid
FROM census c LEFT JOIN best b ON b.SpeciesName = c.SpeciesName
""")
def product_cleaned_species(spark, folder):
    """Resolved names of every site; which number an unknown name gets is arbitrary, so it is left out."""
    backbone = table(spark, folder, "part").groupBy(F.col("p_name").alias("matched_name")).agg(F.min("p_partkey").alias("gni_uuid"))
    out = P.cleaned_species(_bundles(spark, folder), [], backbone)
    return out.select("Region", "destSiteID", "SpeciesName", F.regexp_replace("matched_name", r"_NID_\d+$", "_NID_").alias("matched_name"), "gni_uuid")


# -- two observers, and traits from sheet to merged table --------------------

CALANDA_SQL = """
calanda_sheet AS (
  SELECT CAST(2012 + k % 4 AS INTEGER) AS Year, CASE k % 3 WHEN 0 THEN 'veg_away' WHEN 1 THEN 'veg_home' ELSE 'bare' END AS label,
         'B' || k % 5 AS destBlockID, CASE k % 11 WHEN 0 THEN 'CalNA.NA' ELSE 'p' || k END AS destPlotID,
         CASE k // 2 % 3 WHEN 0 THEN 'Pea' WHEN 1 THEN 'Cal' ELSE 'Nes' END AS destSiteID,
         CASE k // 6 % 3 WHEN 0 THEN 'Pea' WHEN 1 THEN 'Cal' ELSE 'Nes' END AS originSiteID,
         CASE name WHEN 'Moss' THEN 'Cetraria islandica' ELSE name END AS SpeciesName,
         CASE WHEN q % 5 <> 0 THEN q / 4.0::DOUBLE END AS first_reading, CASE l_returnflag WHEN 'N' THEN q + 0.5::DOUBLE END AS second_reading
  FROM sheet
),
pooled AS (
  SELECT Year, label, destBlockID, destPlotID, destSiteID, originSiteID, SpeciesName,
         (coalesce(sum(first_reading), 0) + coalesce(sum(second_reading), 0)) / (count(first_reading) + count(second_reading)) AS Cover
  FROM calanda_sheet GROUP BY ALL HAVING count(first_reading) + count(second_reading) > 0
),
treated AS (
  SELECT *, CASE WHEN label = 'veg_away' AND destSiteID IN ('Cal', 'Nes') THEN 'Warm' WHEN label = 'veg_home' THEN 'LocalControl' END AS Treatment
  FROM pooled
),
calanda_community AS (
  SELECT Year, originSiteID, destSiteID, destBlockID, destPlotID, concat_ws('_', Year, originSiteID, destSiteID, destPlotID) AS UniqueID,
         Treatment, SpeciesName, Cover, greatest(100::DOUBLE, s) AS Total_Cover, Cover / greatest(100, s) AS Rel_Cover
  FROM (SELECT *, sum(Cover) OVER (PARTITION BY Year, originSiteID, destSiteID, destBlockID, destPlotID, Treatment) AS s
        FROM treated WHERE Treatment IS NOT NULL AND destPlotID <> 'CalNA.NA')
  WHERE SpeciesName NOT IN ('Other', 'Cetraria islandica') AND Cover > 0
)"""


def _calanda(spark, folder):
    """Readings of two observers as texts, with decimal commas and dashes; measures of plants as texts with units."""
    k, q, flag = F.col("k"), F.col("q"), F.col("l_returnflag")
    text = lambda c: c.cast("string")
    quarters = F.concat_ws(",", text(F.floor(q / 4)), F.lpad(text(q % 4 * 25), 2, "0"))
    community = _sheet(spark, folder).select(
        (k % 4 + 2012).cast("int").alias("year"), _pick(k % 3, "veg_away", "veg_home", "bare").alias("Treatment"),
        F.concat(F.lit("B"), text(k % 5)).alias("Block"),
        F.when(k % 11 == 0, "CalNA.NA").otherwise(F.concat(F.lit("p"), text(k))).alias("plot_id"),
        _pick(_half(2) % 3, "Pea", "Cal", "Nes").alias("Site"), _pick(_half(6) % 3, "Pea", "Cal", "Nes").alias("turf_type"),
        F.when(F.col("name") == "Moss", "Cetraria islandica").otherwise(F.col("name")).alias("Species_Name"),
        F.when(q % 5 == 0, "NF").otherwise(quarters).alias("Cov_Rel1"),
        F.when(flag == "A", "§").when(flag == "N", F.concat(text(q), F.lit("-5"))).alias("Cov_Rel2"),
    )
    part = table(spark, folder, "part").select("p_partkey", "p_name")
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("k"), "l_linenumber", "l_partkey", F.col("l_quantity").cast("int").alias("q"))
    trait = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_name").alias("species"), text(F.col("l_linenumber")).alias("individual"), _pick(k % 3, "PEAK", "CAL", "NES").alias("site"),
        F.when(q % 5 == 0, "0").otherwise(F.concat(text(q), F.lit(".5 cm"))).alias("leaf.area"),
        F.concat(text(q), F.lit(" mm")).alias("height.veg.stretch"), F.lit(None).cast("string").alias("height.rep.stretch"),
        text(q + 1).alias("leaf.fresh.weight"), text(q / 4).alias("leaf.dry.weight"),
    )
    return build_bundle(PROFILES["CH_Calanda"], {"community": community, "trait": trait})


@query("profile_calanda", "WITH" + SHEET_SQL + "," + CALANDA_SQL + " SELECT * FROM calanda_community")
def profile_calanda(spark, folder):
    """Two observers, whose readings are pooled per group and repeated on each of its rows."""
    return _calanda(spark, folder).community


MATSCH_SQL = """
matsch_sheet AS (
  SELECT k, CASE k // 4 % 2 WHEN 0 THEN 'Low' ELSE 'High' END AS destSiteID,
         CASE WHEN k // 4 % 2 = 0 THEN CASE k % 2 WHEN 0 THEN 'destControl' ELSE 'warmed' END
              ELSE CASE k % 3 WHEN 0 THEN 'extra' ELSE 'originControls' END END AS treat,
         sum(q) FILTER (l_returnflag = 'A') AS a, sum(q) FILTER (l_returnflag = 'N') AS n, sum(q) FILTER (l_returnflag = 'R') AS r
  FROM sheet GROUP BY k
),
matsch_tall AS (
  SELECT k, destSiteID, treat, unnest(['Poa alpina', 'Carex nigra', 'Other']) AS SpeciesName, unnest([a, n, r])::DOUBLE AS Cover FROM matsch_sheet
),
matsch AS (
  SELECT CAST(2010 + k % 8 AS INTEGER) AS Year, CASE treat WHEN 'destControl' THEN 'Low' ELSE 'High' END AS originSiteID, destSiteID,
         'P' || k || '_' || k % 9 AS destPlotID, CASE treat WHEN 'warmed' THEN 'Warm' WHEN 'extra' THEN NULL ELSE 'LocalControl' END AS Treatment,
         SpeciesName, Cover, sum(Cover) OVER (PARTITION BY k) AS s
  FROM matsch_tall WHERE Cover IS NOT NULL
)"""


def _matsch(spark, folder):
    """A wide sheet, a column per species; the plot name ends in the year."""
    k = F.col("k")
    cover = lambda flag: F.sum(F.when(F.col("l_returnflag") == flag, F.col("q"))).cast("double")
    wide = _sheet(spark, folder).groupBy("k").agg(cover("A").alias("Poa_alpina"), cover("N").alias("Carex_nigra"), cover("R").alias("Other"))
    low = _half(4) % 2 == 0
    sheet = wide.select(
        F.lit("g").alias("Gradient Name"), F.format_string("P%d_%d_%d", k, k % 9, k % 8 + 10).alias("internal ID"),
        F.when(low, _pick(k % 2, "destControl", "warmed")).otherwise(F.when(k % 3 == 0, "extra").otherwise("originControls")).alias("rec/Donor"),
        F.when(low, 1000).otherwise(1500).alias("elevation"), "Poa_alpina", "Carex_nigra", "Other",
    )
    return build_bundle(PROFILES["IT_MatschMazia1"], {"community": sheet})


@query("profile_matsch", "WITH" + SHEET_SQL + "," + MATSCH_SQL + """
SELECT Year, originSiteID, destSiteID, destPlotID, concat_ws('_', originSiteID, destSiteID, destPlotID) AS UniqueID, Treatment, SpeciesName,
       Cover, greatest(100::DOUBLE, s) AS Total_Cover, Cover / greatest(100, s) AS Rel_Cover
FROM matsch WHERE SpeciesName <> 'Other' AND Cover > 0
""")
def profile_matsch(spark, folder):
    """Wide sheets, one column per species."""
    return _matsch(spark, folder).community.drop("destBlockID")


LAUTARET_SQL = """
early AS (
  SELECT DISTINCT CAST(2017 + k % 2 AS INTEGER) AS Year, CASE k % 2 WHEN 0 THEN 'L' ELSE 'G' END AS destSiteID,
         CASE WHEN k // 2 % 2 = 0 THEN 'TP' ELSE 'CP' END AS label, lpad(CAST(k % 40 AS VARCHAR), 2, '0') AS plotID, name, q::DOUBLE AS Cover
  FROM sheet WHERE k // 4 % 3 < 2
),
late AS (
  SELECT DISTINCT 2022 AS Year, CASE k % 2 WHEN 0 THEN 'L' ELSE 'G' END AS destSiteID, CASE k // 4 % 3 WHEN 0 THEN 'B' ELSE 'CTRL' END AS label,
         lpad(CAST(k % 40 AS VARCHAR), 2, '0') AS plotID, name, q / 2.0::DOUBLE AS Cover
  FROM sheet WHERE k // 4 % 3 < 2
),
placed AS (
  SELECT *, CASE WHEN label IN ('TP', 'B') THEN CASE destSiteID WHEN 'L' THEN 'Warm' ELSE 'Cold' END ELSE 'LocalControl' END AS Treatment,
         CASE WHEN label NOT IN ('TP', 'B') THEN destSiteID WHEN destSiteID = 'L' THEN 'G' ELSE 'L' END AS originSiteID,
         CASE WHEN name IN ('litter', 'Moss') THEN name || ' sp.' ELSE name END AS SpeciesName
  FROM (SELECT * FROM early UNION ALL SELECT * FROM late)
),
lautaret AS (SELECT Year, originSiteID, destSiteID, plotID, Treatment, SpeciesName, sum(Cover) AS Cover FROM placed GROUP BY ALL)"""


def _lautaret(spark, folder):
    """Pins of two years and percent cover of a later one, in two sheets with names of their own."""
    k, q = F.col("k"), F.col("q")
    sheet, plot = _sheet(spark, folder), (F.col("k") % 40).cast("string")
    pins = sheet.select(
        (k % 2 + 2017).cast("int").alias("Year"), _pick(k % 4, "L_TP", "G_TP", "L_CP", "G_CP").alias("Site_Treatment"),
        _pick(_half(4) % 3, "0", "B", "A").alias("Subplot"), plot.alias("Replicate"), F.col("name").alias("Species"), q.alias("number_of_obs"))
    code = F.concat_ws("_", F.lit("TA"), _pick(k % 2, "Low", "High"), F.lpad(plot, 2, "0"), _pick(_half(4) % 3, "B", "CTRL", "C"))
    late = sheet.select(code.alias("code_plot"), F.col("name").alias("lb_nom"), (q / 2).alias("prct_recouvrement"))
    return build_bundle(PROFILES["FR_Lautaret"], {"community": pins, "community_2022": late})


@query("profile_lautaret", "WITH" + SHEET_SQL + "," + LAUTARET_SQL + """
SELECT Year, originSiteID, destSiteID, concat_ws('_', originSiteID, destSiteID, plotID) AS destPlotID,
       concat_ws('_', Year, originSiteID, destSiteID, plotID) AS UniqueID, Treatment, SpeciesName, Cover, Total_Cover, Cover / Total_Cover AS Rel_Cover
FROM (SELECT *, greatest(100, sum(Cover) OVER (PARTITION BY Year, originSiteID, destSiteID, plotID, Treatment)) AS Total_Cover FROM lautaret)
WHERE Cover > 0
""")
def profile_lautaret(spark, folder):
    """Two sheets of different years, each collapsed, then united."""
    return _lautaret(spark, folder).community.drop("destBlockID")


LAVEY_SITES_SQL = "['CRE_CRE', 'CRE_RIO', 'MAR_MAR', 'MAR_RIO', 'PRA_PRA', 'PRA_RIO', 'RIO_RIO', 'XXX_RIO']"
LAVEY_SQL = """
lavey_first AS (
  SELECT k, sum(CASE l_returnflag WHEN 'A' THEN q ELSE 0 END) + count(*) AS poa,
         CASE WHEN count(*) FILTER (l_returnflag = 'A') = 0 THEN sum(CASE l_returnflag WHEN 'N' THEN q ELSE 0 END) END AS carex,
         sum(CASE l_returnflag WHEN 'R' THEN q ELSE 0 END) AS bare, bool_or(l_linenumber = 1 AND k % 2 = 0) AS renamed
  FROM sheet GROUP BY k
),
lavey_letters AS (
  SELECT o_orderkey AS k, unnest(['Vegetation %', 'Poa alpina', 'Carex', 'Biscutella laevigata']) AS SpeciesName,
         unnest([87.5, CASE o_orderkey % 4 WHEN 0 THEN 10 WHEN 1 THEN 0.5 WHEN 3 THEN 20 END, CASE o_orderkey % 3 WHEN 0 THEN 62.5 END,
                 CASE o_orderkey % 5 WHEN 0 THEN 3.5 ELSE 37.5 END]) AS Cover
  FROM orders
),
lavey_records AS (
  SELECT 2017 AS Year, k, CASE WHEN renamed THEN 'Poa badensis' ELSE 'Poa alpina' END AS SpeciesName, poa::DOUBLE AS Cover FROM lavey_first
  UNION ALL SELECT 2017, k, 'Carex nigra', carex FROM lavey_first WHERE carex IS NOT NULL
  UNION ALL SELECT 2017, k, 'Bare ground', bare FROM lavey_first
  UNION ALL
  SELECT 2018, k, CASE WHEN l_linenumber = 1 AND k % 2 = 0 THEN 'Poa badensis' WHEN name = 'Moss' THEN 'Other' ELSE name END AS SpeciesName,
         sum(q + CASE l_returnflag WHEN 'A' THEN 0 ELSE 1 END)
  FROM sheet WHERE l_linenumber <> 2 OR l_returnflag <> 'R' GROUP BY k, 3
  UNION ALL SELECT 2019, k, SpeciesName, Cover FROM lavey_letters WHERE Cover IS NOT NULL
),
lavey AS (
  SELECT Year, split_part(site, '_', 2) AS originSiteID, split_part(site, '_', 1) AS destSiteID, 'T' || k AS plotID,
         CASE WHEN split_part(site, '_', 1) = split_part(site, '_', 2) THEN 'LocalControl' ELSE 'Warm' END AS Treatment, SpeciesName, Cover,
         sum(Cover) OVER (PARTITION BY Year, k) AS Total_Cover
  FROM (SELECT *, SITES[k % 8 + 1] AS site FROM lavey_records) WHERE site <> 'XXX_RIO'
)""".replace("SITES", LAVEY_SITES_SQL)


def _lavey(spark, folder):
    """Pins by species column, pins by row with names learned later, and letter classes of whole plots."""
    k, q, flag, line = F.col("k"), F.col("q").cast("double"), F.col("l_returnflag"), F.col("l_linenumber")
    site = _pick(k % 8, "CRE_CRE", "CRE_RIO", "MAR_MAR", "MAR_RIO", "PRA_PRA", "PRA_RIO", "RIO_RIO", "XXX_RIO")
    turf = F.concat(F.lit("T"), k.cast("string"))
    sheet = _stored_sheet(spark, folder).withColumns({"siteID": site, "turfID": turf})
    hits = lambda f: F.when(flag == f, q).otherwise(0.0)
    first = sheet.select(
        "siteID", "turfID", hits("A").alias("Poa alpina"), F.lit(1.0).alias("Poa alpina...7"),
        F.when(flag != "A", hits("N")).alias("Carex nigra"), F.lit(9.0).alias("Carex FOCAL"), hits("R").alias("Bare ground"))
    renamed = (line == 1) & (k % 2 == 0)
    name = F.when(renamed, "Poa badensis").when((line == 2) & (flag == "R"), "FOCAL x").when(F.col("name") == "Moss", "NA").otherwise(F.col("name"))
    second = sheet.select(
        "siteID", "turfID", F.when(renamed, "Poa alpina").alias("sp_2017"), name.alias("sp_2018"), q.alias("CRE1"),
        F.when(flag != "A", 1.0).alias("CRE2"))
    plots = table(spark, folder, "orders").select(F.col("o_orderkey").alias("k"))
    plot = F.when(site == "RIO_RIO", F.concat(F.lit("RIO_"), turf)).otherwise(F.concat(site, F.lit("turf_"), turf))
    third = plots.select(
        plot.alias("...1"), F.lit("5").alias("Vegetation %"), _pick(k % 4, "2a", "+", "bad", "2b").alias("Poa alpina"),
        F.when(k % 3 == 0, "4").alias("Carex...12"), F.lit("5").alias("Carex FOCAL"),
        F.when(k % 5 == 0, "1").otherwise("3").alias("Biscutella laevigata"))
    return build_bundle(PROFILES["CH_Lavey"], {"pins_2017": first, "pins_2018": second, "letters_2019": third}, stage=True)


@query("profile_lavey", "WITH" + SHEET_SQL + "," + LAVEY_SQL + """
SELECT Year, originSiteID, destSiteID, concat_ws('_', originSiteID, destSiteID, plotID) AS destPlotID,
       concat_ws('_', Year, originSiteID, destSiteID, plotID) AS UniqueID, Treatment, SpeciesName, Cover, Total_Cover, Cover / Total_Cover AS Rel_Cover
FROM lavey WHERE SpeciesName NOT IN ('Other', 'Bare ground', 'Vegetation %') AND Cover > 0
""")
def profile_lavey(spark, folder):
    """Pins and letter classes of three survey years."""
    return _lavey(spark, folder).community.drop("destBlockID")


@query("product_all_traits", "WITH" + SHEET_SQL + "," + CALANDA_SQL + """,
census AS (SELECT DISTINCT destSiteID, SpeciesName FROM calanda_community),
known AS (SELECT p_name AS matched_name, min(p_partkey) AS gni_uuid FROM part GROUP BY 1),
near AS (
  SELECT n.SpeciesName, matched_name, gni_uuid, levenshtein(n.SpeciesName, matched_name) AS distance
  FROM (SELECT DISTINCT SpeciesName FROM census) n, known WHERE levenshtein(n.SpeciesName, matched_name) <= 2
),
best AS (SELECT * FROM near QUALIFY row_number() OVER (PARTITION BY SpeciesName ORDER BY distance, matched_name) = 1),
list AS (
  SELECT gni_uuid AS row_no, matched_name AS accepted_name, split_part(matched_name, ' ', 1) AS genus
  FROM known WHERE matched_name NOT LIKE '%ring'
),
genera AS (SELECT genus, min(row_no) AS row_no FROM list GROUP BY 1),
plants AS (
  SELECT CASE l_orderkey % 3 WHEN 0 THEN 'Pea' WHEN 1 THEN 'Cal' ELSE 'Nes' END AS site, p_name, l_linenumber,
         avg(l_quantity / 10) AS height, avg(area) AS area, avg(area / (l_quantity / 4)) AS sla
  FROM (SELECT *, CASE WHEN l_quantity % 5 <> 0 THEN l_quantity + 0.5 END AS area FROM lineitem JOIN part ON p_partkey = l_partkey)
  GROUP BY 1, 2, 3
),
measured AS (SELECT site, p_name, avg(height) AS height, avg(area) AS area, avg(sla) AS sla FROM plants GROUP BY 1, 2),
asked AS (
  SELECT c.destSiteID, c.SpeciesName, b.matched_name, coalesce(l.row_no, g.row_no) AS row_no
  FROM census c LEFT JOIN best b ON b.SpeciesName = c.SpeciesName LEFT JOIN list l ON l.row_no = b.gni_uuid
  LEFT JOIN genera g ON g.genus = split_part(b.matched_name, ' ', 1)
)
SELECT 'CH_Calanda' AS Region, a.destSiteID, a.SpeciesName AS original_name, l.accepted_name AS try_name, l.genus,
       CASE l.row_no % 2 WHEN 0 THEN 'sedge' WHEN 1 THEN 'forb' END AS growth,
       round(coalesce(m.height, (l.row_no % 30)::DOUBLE), 6) AS Plant_Veg_Height_cm,
       round(coalesce(m.area, length(l.accepted_name)::DOUBLE), 6) AS Leaf_Area_cm2,
       round(coalesce(m.sla, 100.0::DOUBLE + l.row_no % 7), 6) AS SLA_cm2_g, 40.0::DOUBLE + l.row_no % 5 AS C_percent,
       CASE WHEN l.row_no IS NOT NULL THEN 2.0::DOUBLE END AS N_percent, CASE WHEN l.row_no IS NOT NULL THEN 0.25::DOUBLE END AS P_percent
FROM asked a LEFT JOIN list l ON l.row_no = a.row_no LEFT JOIN measured m ON m.site = a.destSiteID AND m.p_name = a.matched_name
""")
def product_all_traits(spark, folder):
    """Traits of every site and species: field means of a sheet, filled up from the matched rows of the trait list."""
    bundles = {"CH_Calanda": _calanda(spark, folder)}
    known = backbone(spark, folder)
    cleaned = P.cleaned_species(bundles, [], known)
    species, row = trait_list(spark, folder), F.col("species_row")
    fixed = {"leaf_N": 2.0, "leaf_P": 0.25, "seed_mass": 1.0, "stem_density": 0.5}
    numeric = species.select(
        "species_row", F.length("accepted_name").cast("double").alias("leaf_area"), (F.lit(40.0) + row % 5).alias("leaf_C"),
        (row % 30).cast("double").alias("plant_height"), (F.lit(100.0) + row % 7).alias("SLA"),
        *[F.lit(v).alias(c) for c, v in fixed.items()])
    categorical = species.select("species_row", F.when(row % 2 == 0, "sedge").otherwise("forb").alias("growth"))
    out = P.all_traits(bundles, cleaned, species, categorical, numeric)
    rounded = ["Plant_Veg_Height_cm", "Leaf_Area_cm2", "SLA_cm2_g"]
    return out.select(
        "Region", "destSiteID", "original_name", "try_name", "genus", "growth", *[F.round(c, 6).alias(c) for c in rounded],
        "C_percent", "N_percent", "P_percent")


# -- the normalised survey database -----------------------------------------

TURF_TABLES_SQL = """
turfs AS (
  SELECT o_orderkey, 'T' || o_orderkey AS turfID, CASE o_orderstatus WHEN 'P' THEN '' ELSE o_orderstatus END AS TTtreat,
         CAST(year(o_orderdate) AS INTEGER) AS year, CASE o_orderpriority WHEN '1-URGENT' THEN 'Siri' ELSE 'Ann' END AS recorder,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS "date", o_totalprice AS totalVascular,
         og.n_name AS siteID, 'B' || og.n_nationkey AS blockID, dn.n_name AS destSiteID, 'B' || dn.n_nationkey AS destBlockID
  FROM orders JOIN customer oc ON oc.c_custkey = o_custkey JOIN nation og ON og.n_nationkey = oc.c_nationkey
  JOIN customer dc ON dc.c_custkey = o_custkey % 100 + 1 JOIN nation dn ON dn.n_nationkey = dc.c_nationkey
)"""


def survey_database(spark, folder):
    """Sites, blocks, plots, turfs, their environment and community, from nations, customers, orders and line items."""
    nation, customer = table(spark, folder, "nation"), table(spark, folder, "customer")
    orders, lines = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    block = lambda c: F.concat(F.lit("B"), F.col(c).cast("string"))
    turf = lambda c: F.concat(F.lit("T"), F.col(c).cast("string")).alias("turfID")
    year = F.year("o_orderdate").alias("year")
    records = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
    return {
        "sites": nation.select(F.col("n_name").alias("siteID")),
        "blocks": nation.select(block("n_nationkey").alias("blockID"), F.col("n_name").alias("siteID")),
        "plots": customer.select(F.col("c_custkey").alias("plotID"), block("c_nationkey").alias("blockID")),
        "turfs": orders.select(
            turf("o_orderkey"), F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus")).alias("TTtreat"),
            F.col("o_custkey").alias("originPlotID"), (F.col("o_custkey") % 100 + 1).alias("destinationPlotID")),
        "turfEnvironment": orders.select(
            turf("o_orderkey"), year, F.when(F.col("o_orderpriority") == "1-URGENT", "Siri").otherwise("Ann").alias("recorder"),
            F.col("o_orderdate").cast("date").cast("string").alias("date"), F.col("o_totalprice").alias("totalVascular")),
        "turfCommunity": records.select(
            turf("l_orderkey"), year, F.col("l_partkey").cast("string").alias("species"), F.col("l_quantity").alias("cover")),
        "subTurfEnvironment": records.select(turf("l_orderkey"), year, F.when(F.col("l_returnflag") == "N", "").otherwise("x").alias("bad")),
    }


@query("turf_records", "WITH" + TURF_TABLES_SQL + """
SELECT siteID, blockID, TTtreat, turfID, destBlockID,
       (SELECT count(*) FROM lineitem n WHERE n.l_orderkey = o_orderkey AND n.l_returnflag = 'N') AS notbad,
       year, CAST(l_partkey AS VARCHAR) AS species, l_quantity AS cover, recorder, destSiteID
FROM turfs JOIN lineitem ON l_orderkey = o_orderkey WHERE TTtreat <> '' AND year <> 2010
""")
def turf_records(spark, folder):
    """The shipped statement over eight tables."""
    return run_sql(spark, TURF_RECORDS, survey_database(spark, folder))


@query("recorder_totals", "WITH" + TURF_TABLES_SQL + """
SELECT turfID, year, "date", totalVascular, TTtreat, sum(l_quantity) AS SumOfCover
FROM turfs JOIN lineitem ON l_orderkey = o_orderkey WHERE recorder = 'Siri' GROUP BY 1, 2, 3, 4, 5
""")
def recorder_totals_query(spark, folder):
    return recorder_totals(survey_database(spark, folder), "Siri")


@query("product_site_climate", "WITH" + DAMXUNG_SQL + """,
meta AS (
  SELECT 'CN_Damxung' AS Gradient, destSiteID, CASE destSiteID WHEN 'HIGH' THEN 91.05491 ELSE 91.0646299 END::DOUBLE AS Longitude,
         CASE destSiteID WHEN 'HIGH' THEN 30.53141 ELSE 30.4971 END::DOUBLE AS Latitude, CASE destSiteID WHEN 'HIGH' THEN 4800 ELSE 4313 END::DOUBLE AS Elevation
  FROM damxung_community GROUP BY destSiteID
),
grid AS (
  SELECT floor(((c_custkey * 7919 % 36000)::DOUBLE / 100 - 180 + 180) / 30) AS cx, floor((90 - ((c_custkey * 104729 % 17000)::DOUBLE / 100 - 85)) / 30) AS cy,
         c_custkey % 12 + 1 AS month, c_acctbal AS value, CASE c_custkey % 3 WHEN 0 THEN 'tavg' WHEN 1 THEN 'prec' ELSE 'elevation' END AS var
  FROM customer
),
st AS (
  SELECT m.*, avg(value) FILTER (var = 'tavg') AS T_ann, avg(value) FILTER (var = 'tavg' AND month BETWEEN 5 AND 9) AS T_sum,
         max(value) FILTER (var = 'elevation') AS Elevation_st, sum(value) FILTER (var = 'prec') AS P_ann,
         sum(value) FILTER (var = 'prec' AND month BETWEEN 4 AND 9) AS P_sum
  FROM meta m LEFT JOIN grid ON cx = floor((Longitude + 180) / 30) AND cy = floor((90 - Latitude) / 30) GROUP BY ALL
)
SELECT destSiteID, Elevation, Elevation_st, round(T_ann, 6) AS T_ann, round(T_sum, 6) AS T_sum, round(P_ann, 6) AS P_ann, round(P_sum, 6) AS P_sum,
       round(T_ann + LAPSE * (Elevation_st - Elevation), 6) AS T_ann_cor, round(T_sum + LAPSE * (Elevation_st - Elevation), 6) AS T_sum_cor FROM st
""".replace("LAPSE", f"{LAPSE_RATE}::DOUBLE"))
def product_site_climate(spark, folder):
    """Seasonal climate of the sites from a grid of 30 degrees, moved to their elevation."""
    k = F.col("c_custkey")
    grid = table(spark, folder, "customer").select(
        ((k * 7919 % 36000).cast("double") / 100 - 180).alias("lon"), ((k * 104729 % 17000).cast("double") / 100 - 85).alias("lat"),
        (k % 12 + 1).alias("month"), _pick(k % 3, "tavg", "prec", "elevation").alias("var"), F.col("c_acctbal").alias("value"))
    out = P.site_climate(_damxung(spark, folder).meta, grid, -180.0, 90.0, 30.0)
    rounded = ["T_ann", "T_sum", "P_ann", "P_sum", "T_ann_cor", "T_sum_cor"]
    return out.select("destSiteID", "Elevation", "Elevation_st", *[F.round(c, 6).alias(c) for c in rounded])
