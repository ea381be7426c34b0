"""Queries for reshaping, row positions, counts, sets, text and dates."""

from pyspark.sql import functions as F

from ..functions import semantics as S
from ..functions import text as X
from ..operators import reshape as R
from .mapping import OBS_SQL, obs, table
from .registry import query


@query("topk_cover", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS Cover FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 10
""")
def topk_cover(spark, folder):
    df = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_extendedprice").alias("Cover")
    )
    return R.top_k(df, [F.desc("Cover"), "l_orderkey", "l_linenumber", "l_partkey"], 10)


@query("sort_plots", """
SELECT o_orderpriority AS destSiteID, o_orderkey AS destPlotID FROM orders ORDER BY 1, 2
""")
def sort_plots(spark, folder):
    df = table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("destSiteID"), F.col("o_orderkey").alias("destPlotID")
    )
    return df.orderBy("destSiteID", "destPlotID")


@query("count_rows", "SELECT l_linenumber AS notbad, count(*) AS n FROM lineitem GROUP BY 1")
def count_rows(spark, folder):
    return R.count_by(table(spark, folder, "lineitem").withColumnRenamed("l_linenumber", "notbad"), "notbad")


@query("global_max", "SELECT max(l_extendedprice) AS top FROM lineitem")
def global_max(spark, folder):
    return table(spark, folder, "lineitem").agg(F.max("l_extendedprice").alias("top"))


@query("crosstab2", """
SELECT l_linenumber, count(*) FILTER (l_returnflag = 'A') AS A, count(*) FILTER (l_returnflag = 'N') AS N,
       count(*) FILTER (l_returnflag = 'R') AS R FROM lineitem GROUP BY 1
""")
def crosstab2(spark, folder):
    return R.crosstab(table(spark, folder, "lineitem"), ["l_linenumber"], "l_returnflag", ["A", "N", "R"])


@query("crosstab3", """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_linestatus, count(*) FILTER (l_returnflag = 'A') AS A,
       count(*) FILTER (l_returnflag = 'N') AS N, count(*) FILTER (l_returnflag = 'R') AS R FROM lineitem GROUP BY 1, 2
""")
def crosstab3(spark, folder):
    df = table(spark, folder, "lineitem").withColumn("year", F.year("l_shipdate"))
    return R.crosstab(df, ["year", "l_linestatus"], "l_returnflag", ["A", "N", "R"])


@query("first_per_key", """
SELECT o_custkey, o_orderkey, o_totalprice, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1
""")
def first_per_key(spark, folder):
    df = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority")
    return R.first_per_key(df, ["o_custkey"], "o_orderkey")


@query("sequence_in_group", """
SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS k FROM orders
""")
def sequence_in_group(spark, folder):
    df = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return R.sequence_in_group(df, ["o_orderpriority"], "o_orderkey", "k")


@query("setdiff_species", """
SELECT DISTINCT p_name FROM part WHERE p_name NOT IN (SELECT p_name FROM part WHERE p_size > 25 AND p_type = 'PROMO')
""")
def setdiff_species(spark, folder):
    part = table(spark, folder, "part")
    return R.set_difference(part, part.filter((F.col("p_size") > 25) & (F.col("p_type") == "PROMO")), "p_name")


@query("concat_columns", """
SELECT n_nationkey, 'nation' || n_nationkey AS code, n_name AS taxa FROM nation JOIN customer ON c_nationkey = n_nationkey
UNION ALL SELECT n_nationkey, c_mktsegment, c_name FROM nation JOIN customer ON c_nationkey = n_nationkey
""")
def concat_columns(spark, folder):
    nation, customer = table(spark, folder, "nation"), table(spark, folder, "customer")
    df = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).withColumn(
        "code1", F.concat(F.lit("nation"), F.col("n_nationkey").cast("string"))
    )
    return R.concat_columns(
        df, [{"code": "code1", "taxa": "n_name"}, {"code": "c_mktsegment", "taxa": "c_name"}], ["n_nationkey"]
    )


@query("gather_wide", """
SELECT l_orderkey, l_linenumber, l_partkey, SpeciesName, Cover FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, unnest(['Poa', 'Carex', 'Salix']) AS SpeciesName,
         unnest([l_quantity, CASE WHEN l_tax > 0.02 THEN l_tax END, l_discount]) AS Cover FROM lineitem)
""")
def gather_wide(spark, folder):
    ids = ["l_orderkey", "l_linenumber", "l_partkey"]
    df = table(spark, folder, "lineitem").select(
        *ids, F.col("l_quantity").alias("Poa"), F.when(F.col("l_tax") > 0.02, F.col("l_tax")).alias("Carex"),
        F.col("l_discount").alias("Salix"),
    )
    return R.gather(df, ids, "SpeciesName", "Cover")


@query("gather_range", """
SELECT p_partkey, name, value FROM (
  SELECT p_partkey, unnest(['p_size', 'p_retailprice']) AS name, unnest([p_size::DOUBLE, p_retailprice]) AS value FROM part)
""")
def gather_range(spark, folder):
    df = table(spark, folder, "part")
    cols = R.column_range(df, "p_size", "p_retailprice")
    return R.gather(df, ["p_partkey"], "name", "value", cols, "double")


@query("separate_extract", """
SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS rank, nullif(split_part(o_orderpriority, '-', 2), '') AS label,
       CAST(NULL AS VARCHAR) AS extra,
       CASE WHEN regexp_matches(o_orderpriority, '^(.*)-([^ ]+)$') THEN regexp_extract(o_orderpriority, '^(.*)-([^ ]+)$', 2) END AS tail
FROM orders
""")
def separate_extract(spark, folder):
    df = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", F.col("o_orderpriority").alias("p2"))
    df = R.separate(df, "o_orderpriority", ["rank", "label", "extra"], "-")
    return R.extract_columns(df, "p2", ["head", "tail"], r"^(.*)-([^ ]+)$").drop("head")


@query("nest_rows", "WITH" + OBS_SQL + """,
agg AS (SELECT destSiteID, Year, SpeciesName, sum(Cover) AS Cover FROM obs GROUP BY ALL)
SELECT destSiteID, Year, count(*)::INTEGER AS n_species, round(sum(Cover), 6) AS total,
       string_agg(SpeciesName, ';' ORDER BY SpeciesName) AS species FROM agg GROUP BY 1, 2
""")
def nest_rows(spark, folder):
    """Species of one site and year as an array; at most as many as the species list has."""
    keys = ["destSiteID", "Year"]
    df = obs(spark, folder).groupBy(*keys, "SpeciesName").agg(F.sum("Cover").alias("Cover"))
    nested = R.nest_rows(df, keys, ["SpeciesName", "Cover"])
    return nested.select(
        *keys, F.size("data").alias("n_species"),
        F.round(F.aggregate("data.Cover", F.lit(0.0), lambda a, b: a + b), 6).alias("total"),
        F.array_join("data.SpeciesName", ";").alias("species"),
    )


@query("unnest_rows", "WITH" + OBS_SQL + """
SELECT destSiteID, Year, SpeciesName, sum(Cover) AS Cover FROM obs GROUP BY ALL
""")
def unnest_rows(spark, folder):
    keys = ["destSiteID", "Year"]
    df = obs(spark, folder).groupBy(*keys, "SpeciesName").agg(F.sum("Cover").alias("Cover"))
    return R.unnest_rows(R.nest_rows(df, keys, ["SpeciesName", "Cover"]), keys)


@query("row_sums", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity + coalesce(CASE WHEN l_tax > 0.02 THEN l_linenumber END, 0) AS total,
       (l_quantity + l_linenumber) / 2 AS mean2 FROM lineitem
""")
def row_sums(spark, folder):
    df = table(spark, folder, "lineitem").withColumn("maybe", F.when(F.col("l_tax") > 0.02, F.col("l_linenumber")))
    return df.select(
        "l_orderkey", "l_linenumber", "l_partkey", S.row_sum("l_quantity", "maybe").alias("total"),
        S.row_mean("l_quantity", "l_linenumber").alias("mean2"),
    )


@query("sum_if_numeric", """
SELECT p_brand, sum(p_partkey)::BIGINT AS p_partkey, sum(p_size)::BIGINT AS p_size,
       round(sum(CAST(p_retailprice AS DECIMAL(18,2)))::DOUBLE, 2) AS p_retailprice FROM part GROUP BY 1
""")
def sum_if_numeric(spark, folder):
    out = R.sum_numeric(table(spark, folder, "part"), ["p_brand"])
    return out.withColumn("p_retailprice", F.round("p_retailprice", 2))


@query("sum_strict", """
SELECT l_suppkey, CASE WHEN count(*) FILTER (l_quantity > 48) = 0 THEN sum(l_quantity) END AS strict,
       coalesce(sum(CASE WHEN l_quantity <= 48 THEN l_quantity END), 0) AS lenient FROM lineitem GROUP BY 1
""")
def sum_strict(spark, folder):
    df = table(spark, folder, "lineitem").withColumn("v", F.when(F.col("l_quantity") <= 48, F.col("l_quantity")))
    return df.groupBy("l_suppkey").agg(S.sum_strict("v").alias("strict"), S.sum_zero("v").alias("lenient"))


@query("slice_rows", """
SELECT c_custkey, c_name, CASE WHEN c_custkey < 500 THEN 'LOW' WHEN c_custkey < 1000 THEN 'MID' ELSE 'HIGH' END AS block
FROM customer
""")
def slice_rows(spark, folder):
    df = table(spark, folder, "customer").select("c_custkey", "c_name")
    return R.slice_rows(df, {"LOW": (0, 499), "MID": (500, 999), "HIGH": (1000, 2**62)}, "c_custkey")


@query("select_columns", "SELECT l_orderkey, l_partkey, l_suppkey, l_quantity AS q, l_returnflag, l_linestatus FROM lineitem")
def select_columns(spark, folder):
    """Range, prefix and type based selection with a rename."""
    df = table(spark, folder, "lineitem")
    keys = [c for c in R.column_range(df, "l_orderkey", "l_linenumber") if c in R.columns_where(df, types=["bigint"])]
    flags = R.columns_where(df, starts="l_", contains="flag") + R.columns_where(df, contains="status")
    return df.select(*keys, "l_quantity", *flags).withColumnsRenamed({"l_quantity": "q"})


@query("mutate_all", "SELECT p_partkey, upper(p_name) AS p_name, upper(p_brand) AS p_brand, upper(p_type) AS p_type FROM part")
def mutate_all(spark, folder):
    df = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return R.mutate_all(df, R.columns_where(df, types=["string"]), F.upper)


@query("positional_names", "SELECT r_regionkey AS id, r_name AS site, n_name AS plot FROM region JOIN nation ON n_regionkey = r_regionkey")
def positional_names(spark, folder):
    region, nation = table(spark, folder, "region"), table(spark, folder, "nation")
    joined = region.join(nation, region["r_regionkey"] == nation["n_regionkey"])
    return joined.select("r_regionkey", "r_name", "n_name").toDF("id", "site", "plot")


@query("filters", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_quantity > 10 AND l_returnflag IN ('A', 'R') AND (nullif(l_linestatus, 'F') IS NULL OR l_linestatus <> 'O')
  AND year(l_shipdate) <> 2000 AND l_tax IS NOT NULL
""")
def filters(spark, folder):
    """Comparison, membership, anti-membership that keeps missing values, and null tests."""
    df = table(spark, folder, "lineitem")
    df = df.filter(
        (F.col("l_quantity") > 10) & F.col("l_returnflag").isin("A", "R") & (F.year("l_shipdate") != 2000)
        & F.col("l_tax").isNotNull()
    ).withColumn("state", F.when(F.col("l_linestatus") != "F", F.col("l_linestatus")))
    return df.filter(S.not_in("state", ["O"])).select("l_orderkey", "l_linenumber", "l_partkey")


@query("regex_filter", "SELECT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^(old|new) .*(bolt|ring)$')")
def regex_filter(spark, folder):
    df = table(spark, folder, "part").select("p_partkey", "p_name")
    return df.filter(F.col("p_name").rlike("^(old|new) .*(bolt|ring)$"))


@query("text_numeric", """
SELECT o_orderkey, o_totalprice AS price, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END AS maybe,
       least(o_totalprice, 300000) AS capped, greatest(100000 - o_totalprice, 0) AS rest,
       CASE WHEN o_custkey % 100 = 0 THEN NULL ELSE o_totalprice / (o_custkey % 100) END AS per
FROM orders
""")
def text_numeric(spark, folder):
    price = F.concat(F.lit("~"), F.format_number(F.col("o_totalprice"), 2), F.lit(" kg"))
    comma = F.regexp_replace(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), r"\.", ",")
    df = table(spark, folder, "orders").select(
        "o_orderkey", "o_totalprice", "o_custkey", price.alias("price"),
        F.when(F.col("o_orderstatus") == "F", "NF").otherwise(comma).alias("maybe"),
    )
    return df.select(
        "o_orderkey", X.clean_number("price").alias("price"), X.decimal_comma("maybe").alias("maybe"),
        S.pmin("o_totalprice", 300000).alias("capped"), S.pmax(F.lit(100000) - F.col("o_totalprice"), 0).alias("rest"),
        S.ratio("o_totalprice", F.col("o_custkey") % 100).alias("per"),
    )


@query("string_ops", """
SELECT p_partkey, coalesce(CASE WHEN p_size > 25 THEN p_brand END, 'NA') || '_' || p_partkey AS pasted,
       upper(p_name) AS up, substring(p_brand, 7) AS tail, substring(p_brand, 1, 5) AS head, substring(p_name, length(p_name) - 2, 2) AS near_end,
       regexp_replace(p_name, 'l', 'L') AS first_l, regexp_replace(p_name, 'l', 'L', 'g') AS all_l,
       CASE WHEN p_size < 10 THEN '0' || p_size ELSE p_size::VARCHAR END AS padded,
       nullif(regexp_extract(p_name, 'bolt|ring'), '') AS found
FROM part
""")
def string_ops(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", S.paste(F.when(F.col("p_size") > 25, F.col("p_brand")), "p_partkey").alias("pasted"),
        F.upper("p_name").alias("up"), X.tail("p_brand", 7).alias("tail"), X.between("p_brand", 1, 5).alias("head"),
        X.from_end("p_name", 2, 2).alias("near_end"), X.replace_first("p_name", "l", "L").alias("first_l"),
        F.regexp_replace("p_name", "l", "L").alias("all_l"), X.zero_pad2("p_size").alias("padded"),
        X.extract("p_name", "bolt|ring").alias("found"),
    )


@query("binomial_words", """
SELECT p_partkey, split_part(p_name, ' ', 1) AS genus, nullif(split_part(p_name || ' ' || p_type, ' ', 3), '') AS third,
       p_name AS two, CASE WHEN p_size > 25 THEN split_part(p_name, ' ', 1) || ' sp.' ELSE p_name END AS named
FROM part
""")
def binomial_words(spark, folder):
    long_name = F.concat_ws(" ", "p_name", "p_type")
    short = F.when(F.col("p_size") > 25, X.genus("p_name")).otherwise(F.col("p_name"))
    return table(spark, folder, "part").select(
        "p_partkey", X.genus("p_name").alias("genus"), X.word(long_name, 3).alias("third"),
        X.two_words(long_name).alias("two"), X.sp_suffix(short).alias("named"),
    )


@query("parse_mixed_dates", """
SELECT event_id, CASE WHEN event_id % 5 = 4 THEN NULL ELSE CAST(ts AS DATE) END AS day,
       CASE WHEN event_id % 5 = 4 THEN NULL ELSE CAST(year(ts) AS INTEGER) END AS year FROM events
""")
def parse_mixed_dates(spark, folder):
    """Dates written as spreadsheet serials, m/d/yyyy, m/d/yy, ISO, or unreadable."""
    day, k = F.to_date("ts"), F.col("event_id") % 5
    serial = F.datediff(day, F.lit("1899-12-30")).cast("string")
    text = (
        F.when(k == 0, serial).when(k == 1, F.date_format(day, "M/d/yyyy")).when(k == 2, F.date_format(day, "M/d/yy"))
        .when(k == 3, F.date_format(day, "yyyy-MM-dd")).otherwise(F.lit("sometime"))
    )
    df = table(spark, folder, "events").select("event_id", X.mixed_date(text).alias("day"))
    return df.withColumn("year", F.year("day"))


@query("year_from_text", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(2000 + year(o_orderdate) % 100 AS INTEGER) AS short FROM orders
""")
def year_from_text(spark, folder):
    y = F.year("o_orderdate").cast("string")
    return table(spark, folder, "orders").select(
        "o_orderkey", X.leading_year(F.concat(y, F.lit(".1 peak"))).alias("year"),
        X.two_digit_year(F.concat(F.lit("plot_"), F.substring(y, 3, 2))).alias("short"),
    )


@query("recode_mapvalues", """
SELECT c_custkey, CASE c_mktsegment WHEN 'MACHINERY' THEN 'm' WHEN 'HOUSEHOLD' THEN 'h' ELSE c_mktsegment END AS kept,
       CASE c_mktsegment WHEN 'MACHINERY' THEN 1.0::DOUBLE WHEN 'HOUSEHOLD' THEN 2.0 END AS typed FROM customer
""")
def recode_mapvalues(spark, folder):
    return table(spark, folder, "customer").select(
        "c_custkey", S.recode("c_mktsegment", {"MACHINERY": "m", "HOUSEHOLD": "h"}).alias("kept"),
        S.recode_to("c_mktsegment", {"MACHINERY": 1.0, "HOUSEHOLD": 2.0}).alias("typed"),
    )


@query("ifelse_coalesce", """
SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 'plus' WHEN c_acctbal < -500 THEN 'deep' END AS label,
       coalesce(nullif(c_mktsegment, 'FURNITURE'), c_name) AS name FROM customer
""")
def ifelse_coalesce(spark, folder):
    bal = F.col("c_acctbal")
    return table(spark, folder, "customer").select(
        "c_custkey", F.when(bal > 0, "plus").when(bal < -500, "deep").alias("label"),
        F.coalesce(S.na_if("c_mktsegment", "FURNITURE"), F.col("c_name")).alias("name"),
    )


@query("optional_column", "SELECT o_orderkey, o_orderpriority AS a, CAST(NULL AS VARCHAR) AS b FROM orders")
def optional_column(spark, folder):
    df = table(spark, folder, "orders")
    return df.select(
        "o_orderkey", S.column_or_null(df, "o_orderpriority").alias("a"), S.column_or_null(df, "destBlockID").alias("b")
    )


@query("nest_chunks", """
WITH d AS (SELECT l_returnflag, l_linestatus, l_suppkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL),
per AS (SELECT l_returnflag, l_linestatus, count(*) AS n_distinct, sum(n)::BIGINT AS n_rows,
               sum(l_suppkey * n)::BIGINT AS suppkeys FROM d GROUP BY 1, 2)
SELECT *, CAST(ceil(n_distinct / 100.0) AS BIGINT) AS n_chunks, least(n_distinct, 100)::INTEGER AS longest FROM per
""")
def nest_chunks(spark, folder):
    """Few keys hold all rows; no array is longer than its bound."""
    keys = ["l_returnflag", "l_linestatus"]
    nested = R.nest_chunks(table(spark, folder, "lineitem"), keys, ["l_suppkey", "l_linenumber"], 100)
    total = lambda f: F.sum(F.aggregate("data", F.lit(0).cast("long"), lambda a, s: a + f(s)))
    return nested.groupBy(*keys).agg(
        F.sum(F.size("data")).alias("n_distinct"), total(lambda s: s["n"]).alias("n_rows"),
        total(lambda s: s["l_suppkey"] * s["n"]).alias("suppkeys"), F.count(F.lit(1)).alias("n_chunks"),
        F.max(F.size("data")).alias("longest"))


@query("unnest_chunks", "SELECT l_returnflag, l_linestatus, l_suppkey, l_linenumber FROM lineitem")
def unnest_chunks(spark, folder):
    keys = ["l_returnflag", "l_linestatus"]
    return R.unnest_chunks(R.nest_chunks(table(spark, folder, "lineitem"), keys, ["l_suppkey", "l_linenumber"], 100), keys)
