"""Queries for audits."""

from pyspark.sql import functions as F

from ..operators import declared as D
from ..operators import quality as Q
from ..session import stage_table
from .community_queries import merge_community
from .mapping import OBS_SQL, SITES_SQL, VISITS_SQL, obs, site_table, table, treated_visits
from .registry import query
from .taxonomy_queries import CLEANED_SQL, backbone, resolved_names, typed


@query("null_census", """
SELECT unnest(['l_orderkey', 'flag', 'l_tax']) AS "column",
       unnest([count(*) FILTER (l_orderkey IS NULL), count(*) FILTER (nullif(l_returnflag, 'N') IS NULL),
               count(*) FILTER (l_tax IS NULL)]) AS n_null FROM lineitem
""")
def null_census(spark, folder):
    df = table(spark, folder, "lineitem").select(
        "l_orderkey", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag"), "l_tax"
    )
    return Q.null_census(df)


@query("merge_audit", "WITH" + VISITS_SQL + "," + SITES_SQL + """,
dat AS (SELECT *, CASE WHEN Year = 1999 THEN NULL ELSE Treatment END AS T FROM visits
        WHERE Treatment NOT IN ('Cold', 'Control')),
meta AS (SELECT * FROM sites WHERE Elevation > 500)
SELECT 'sites_without_meta' AS audit, count(*) AS n FROM (SELECT DISTINCT Region, destSiteID FROM dat) d
  WHERE NOT EXISTS (SELECT 1 FROM meta m WHERE m.Region = d.Region AND m.destSiteID = d.destSiteID)
UNION ALL
SELECT 'meta_without_data', count(*) FROM meta m
  WHERE NOT EXISTS (SELECT 1 FROM dat d WHERE m.Region = d.Region AND m.destSiteID = d.destSiteID)
UNION ALL SELECT 'null_treatment', count(*) FROM dat WHERE T IS NULL
UNION ALL SELECT 'null_rel_cover', count(*) FROM dat WHERE o_totalprice < 1000
""")
def merge_audit(spark, folder):
    df = treated_visits(spark, folder).filter(~F.col("Treatment").isin("Cold", "Control"))
    df = df.withColumns({
        "Treatment": F.when(F.col("Year") != 1999, F.col("Treatment")),
        "Rel_Cover": F.when(F.col("o_totalprice") >= 1000, F.lit(1.0)),
    })
    meta = site_table(spark, folder).filter(F.col("Elevation") > 500)
    return Q.merge_audit(df, meta)


@query("rows_per_treatment", "WITH" + OBS_SQL + """
SELECT Region, destSiteID, Treatment, count(*) AS n FROM obs
WHERE Treatment NOT IN ('Cold', 'Control') AND Cover > 0 GROUP BY 1, 2, 3
""")
def rows_per_treatment(spark, folder):
    return Q.rows_per_treatment(merge_community(spark, folder))


@query("total_cover_audit", """
SELECT l_orderkey, sum(l_quantity) AS Total_Cover FROM lineitem GROUP BY 1 HAVING sum(l_quantity) < 100
""")
def total_cover_audit(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", F.col("l_quantity").alias("Cover"))
    return Q.total_cover_audit(lines, ["l_orderkey"])


@query("row_growth", "WITH" + CLEANED_SQL + """
SELECT 0 AS step, 'names' AS name, count(*) AS n FROM typed
UNION ALL SELECT 1, 'resolved', count(*) FROM cleaned
""")
def row_growth(spark, folder):
    """Counted where the rows pass: the names when they are staged, the resolved ones when they are written."""
    steps = [("names", lambda df: df), ("resolved", lambda df: resolved_names(df, backbone(spark, folder)))]
    return Q.growth_of(typed(spark, folder), steps, lambda df: stage_table(df, "names/cleaned"), staged=["names"])


@query("written_audits", """
SELECT unnest(['flag', 'l_tax', 'rows', 'returned']) AS audit,
       unnest([count(*) FILTER (nullif(l_returnflag, 'N') IS NULL), count(*) FILTER (l_tax IS NULL), count(*),
               count(*) FILTER (l_returnflag = 'R')]) AS n FROM lineitem
""")
def written_audits(spark, folder):
    """Missing values and rows of a product, counted by the action that writes it."""
    df = table(spark, folder, "lineitem").select(
        "l_orderkey", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("flag"), "l_tax"
    )
    audits = {**Q.null_audits(["flag", "l_tax"]), "rows": F.count(F.lit(1)), "returned": F.count_if(F.col("flag") == "R")}
    return Q.audited_write(df, lambda rows: stage_table(rows, "audited"), audits)


@query("duplicate_keys", """
SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def duplicate_keys(spark, folder):
    return Q.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_partkey"])


@query("plot_layout", "WITH" + OBS_SQL + """
SELECT destSiteID, destPlotID, Year, SpeciesName, sum(Cover) AS Cover,
       'Site ' || destSiteID || ': plot ' || destPlotID AS title FROM obs GROUP BY ALL
""")
def plot_layout(spark, folder):
    return Q.plot_layout(obs(spark, folder), rows=table(spark, folder, "lineitem").count())


@query("declared_join", """
SELECT o_orderpriority, l_returnflag, count(*) AS n, sum(l_quantity) AS quantity
FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2
""")
def declared_join(spark, folder):
    """Line items belong to one order each."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_returnflag", "l_quantity")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    joined = D.declared_join(lines, orders, {"l_orderkey": "o_orderkey"}, "many-to-one")
    return joined.groupBy("o_orderpriority", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


@query("fan_out", """
WITH a AS (SELECT l_partkey, count(*) AS n_left FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
b AS (SELECT l_partkey, count(*) AS n_right FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1)
SELECT l_partkey, n_left, n_right, n_left * n_right AS n_rows FROM a JOIN b USING (l_partkey) WHERE n_left > 1 AND n_right > 1
""")
def fan_out(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_partkey", "l_returnflag")
    return D.fan_out(lines.filter("l_returnflag = 'R'"), lines.filter("l_returnflag = 'A'"), ["l_partkey"])
