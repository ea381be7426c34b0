"""SQL scans over a normalised survey database (sites, blocks, plots, turfs, ...).

The tables may come from Parquet, CSV or ``spark.read.jdbc``; they are handed
over as DataFrames and named inside the statement with braces.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Turf records with origin site, destination block and the number of usable sub-plots.
TURF_RECORDS = """
SELECT s.siteID, b.blockID, t.TTtreat, t.turfID, db.blockID AS destBlockID,
       (SELECT count(e.bad) FROM {subTurfEnvironment} e
         WHERE e.year = c.year AND e.turfID = c.turfID AND e.bad = '') AS notbad,
       c.year, c.species, CAST(c.cover AS DOUBLE) AS cover, env.recorder, db.siteID AS destSiteID
FROM {turfCommunity} c
JOIN {turfs} t ON t.turfID = c.turfID
JOIN {turfEnvironment} env ON env.turfID = c.turfID AND env.year = c.year
JOIN {plots} p ON p.plotID = t.originPlotID
JOIN {blocks} b ON b.blockID = p.blockID
JOIN {sites} s ON s.siteID = b.siteID
JOIN {plots} dp ON dp.plotID = t.destinationPlotID
JOIN {blocks} db ON db.blockID = dp.blockID
WHERE t.TTtreat <> '' AND c.year <> 2010
"""

# Turf records with full origin and destination and the species name.
TURF_RECORDS_NAMED = """
SELECT os.siteID AS originSiteID, ob.blockID AS originBlockID, op.plotID AS originPlotID, t.turfID,
       dp.plotID AS destPlotID, db.blockID AS destBlockID, ds.siteID AS destSiteID, t.TTtreat,
       c.year, c.species, CAST(c.cover AS DOUBLE) AS cover, c.flag, x.speciesName
FROM {turfCommunity} c
JOIN {turfs} t ON t.turfID = c.turfID
JOIN {taxon} x ON x.species = c.species
JOIN {plots} op ON op.plotID = t.originPlotID
JOIN {blocks} ob ON ob.blockID = op.blockID
JOIN {sites} os ON os.siteID = ob.siteID
JOIN {plots} dp ON dp.plotID = t.destinationPlotID
JOIN {blocks} db ON db.blockID = dp.blockID
JOIN {sites} ds ON ds.siteID = db.siteID
"""


def run_sql(spark: SparkSession, statement: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Run a statement whose tables are written as ``{name}``."""
    used = {k: v for k, v in tables.items() if "{" + k + "}" in statement}
    return spark.sql(statement, **used)


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """A table of a live database; give partitionColumn, lowerBound, upperBound and numPartitions for large ones."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def recorder_totals(tables: Mapping[str, DataFrame], recorder: str) -> DataFrame:
    """Summed raw cover of the samples of one recorder next to the estimated total of the turf."""
    t = tables
    return (
        t["sites"].join(t["blocks"], "siteID").join(t["plots"], "blockID")
        .join(t["turfs"], F.col("plotID") == F.col("destinationPlotID"))
        .join(t["turfEnvironment"].filter(F.col("recorder") == recorder), "turfID")
        .join(t["turfCommunity"].select("turfID", "year", "cover"), ["turfID", "year"])
        .groupBy("turfID", "year", "date", "totalVascular", "TTtreat")
        .agg(F.coalesce(F.sum("cover"), F.lit(0.0)).alias("SumOfCover"))
    )
