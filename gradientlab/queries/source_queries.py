"""Queries that write the tables in a source format and read them back."""

from pyspark.sql import functions as F

from ..operators.reshape import count_by, first_per_key
from ..session import scratch_path
from ..sources import readers as Rd
from ..sources import scans as Sc
from .mapping import table
from .registry import query

SUPPLIER = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"
ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"


def _orders(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )


@query("csv_roundtrip", """
SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'O') AS o_orderstatus, o_totalprice, o_orderpriority FROM orders
""")
def csv_roundtrip(spark, folder):
    """Missing values are written and read as NA."""
    df = _orders(spark, folder).withColumn("o_orderstatus", F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")))
    path = Rd.write_csv(df, scratch_path(spark, "csv_roundtrip"))
    return Rd.read_delimited(spark, path, ORDERS)


@query("semicolon_scan", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def semicolon_scan(spark, folder):
    path = Rd.write_csv(_orders(spark, folder), scratch_path(spark, "semicolon_scan"), sep=";")
    return Rd.read_delimited(spark, path, ORDERS, sep=";")


@query("folder_union", """
SELECT o_orderkey AS id, o_totalprice AS value, o_orderstatus AS flag, CAST(NULL AS VARCHAR) AS name FROM orders
UNION ALL SELECT p_partkey, p_retailprice, NULL, p_name FROM part
""")
def folder_union(spark, folder):
    """Files with different columns read as one table by column name."""
    a = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("value"), F.col("o_orderstatus").alias("flag")
    )
    b = table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("value"), F.col("p_name").alias("name")
    )
    pa = Rd.write_csv(a, scratch_path(spark, "folder_union/a"))
    pb = Rd.write_csv(b, scratch_path(spark, "folder_union/b"))
    return Rd.read_union(spark, [
        (pa, "id bigint, value double, flag string"), (pb, "id bigint, value double, name string"),
    ])


@query("file_tagging", """
SELECT l_linenumber AS turf, 'SITE_' || l_linestatus AS siteID, count(*) AS n FROM lineitem GROUP BY 1, 2
""")
def file_tagging(spark, folder):
    """One folder per site and turf; both are recovered from the path of each row's file."""
    path = scratch_path(spark, "file_tagging")
    df = table(spark, folder, "lineitem").select(
        "l_partkey", F.concat(F.lit("SITE_"), "l_linestatus").alias("site"), F.col("l_linenumber").alias("turf")
    )
    df.write.mode("overwrite").option("header", True).partitionBy("site", "turf").csv(path)
    back = Rd.read_delimited(spark, path, "l_partkey bigint")
    tagged = Rd.with_file_tags(back.select("l_partkey", "_metadata"), siteID="SITE_O|SITE_F", turf=(r"turf=(\d+)/", 1))
    return count_by(tagged.withColumn("turf", F.col("turf").cast("int")), "turf", "siteID")


@query("parquet_sink", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority AS Region FROM orders
""")
def parquet_sink(spark, folder):
    """Table partitioned by region, written and read back."""
    df = _orders(spark, folder).withColumnRenamed("o_orderpriority", "Region")
    path = Rd.write_table(df, scratch_path(spark, "parquet_sink"))
    return spark.read.parquet(path)


@query("sheet_scan", "SELECT 'T' || l_linenumber AS turfID, l_orderkey, l_quantity FROM lineitem")
def sheet_scan(spark, folder):
    """One file per numbered sheet, named by its number; the sheet of notes is left out."""
    path = scratch_path(spark, "sheets")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_quantity", "l_linenumber")
    names = {1: "1 plot", 2: "2.b", 3: "3", 4: "4 x", 5: "5", 6: "6 late", 7: "7"}  # orders have up to seven lines
    notes = table(spark, folder, "part").select(F.col("p_partkey").alias("l_orderkey"), F.col("p_retailprice").alias("l_quantity"))
    paths = [Rd.write_csv(notes, f"{path}/notes.csv")]
    for number, name in names.items():
        sheet = lines.filter(F.col("l_linenumber") == number).drop("l_linenumber")
        paths.append(Rd.write_csv(sheet, f"{path}/{name}.csv"))
    return Rd.read_sheets(spark, paths, "l_orderkey bigint, l_quantity double", sheet=r"/(\d+)[^/]*\.csv/[^/]*$").select(
        "turfID", "l_orderkey", "l_quantity")


@query("named_files", """
SELECT o_orderkey, o_totalprice, c_mktsegment FROM orders JOIN customer ON c_custkey = o_custkey
""")
def named_files(spark, folder):
    """Two files by logical name, joined."""
    path = scratch_path(spark, "named")
    files = {
        "orders": Rd.write_csv(table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), f"{path}/o"),
        "customer": Rd.write_csv(table(spark, folder, "customer").select("c_custkey", "c_mktsegment"), f"{path}/c"),
    }
    read = Rd.read_named(spark, files, {
        "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double", "customer": "c_custkey bigint, c_mktsegment string"})
    orders, customer = read["orders"], read["customer"]
    return orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).select("o_orderkey", "o_totalprice", "c_mktsegment")


@query("sheet_range", """
SELECT o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey // 1000 ORDER BY o_orderkey) AS row_no FROM orders)
WHERE row_no BETWEEN 50 AND 199
""")
def sheet_range(spark, folder):
    """The same range of rows of every exported sheet, by numbers made at the scan."""
    sheets = table(spark, folder, "orders").select(
        "o_orderkey", "o_totalprice", F.floor(F.col("o_orderkey") / 1000).alias("sheet"))
    path = scratch_path(spark, "sheet_range")
    (sheets.repartition("sheet").sortWithinPartitions("sheet", "o_orderkey")
     .write.option("header", True).partitionBy("sheet").csv(path))
    read = Rd.read_delimited(spark, path, "o_orderkey bigint, o_totalprice double").drop("sheet")
    return Rd.row_window(Sc.with_row_numbers(read), 50, 199).drop("row_no")


@query("first_line_per_key", """
SELECT sheet, l_returnflag, l_orderkey, l_linenumber, l_quantity FROM (
  SELECT *, l_orderkey // 10000 AS sheet,
         row_number() OVER (PARTITION BY l_orderkey // 10000, l_returnflag ORDER BY l_orderkey, l_linenumber) AS nth FROM lineitem)
WHERE nth = 1
""")
def first_line_per_key(spark, folder):
    """The first line of each key of every sheet, by the numbers made at the scan."""
    path = scratch_path(spark, "first_line")
    lines = table(spark, folder, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_quantity")
    sheet = F.floor(F.col("l_orderkey") / 10000)
    (lines.withColumn("of", sheet).repartition("of").sortWithinPartitions("of", "l_orderkey", "l_linenumber")
     .write.option("header", True).partitionBy("of").csv(path))
    read = Rd.read_delimited(spark, path, "l_returnflag string, l_orderkey bigint, l_linenumber int, l_quantity double").drop("of")
    return first_per_key(
        Sc.with_row_numbers(read).withColumn("sheet", sheet), ["sheet", "l_returnflag"], "row_no").drop("row_no")


def _damaged(spark, folder, name):
    """Orders as text lines: some prices have a letter, some keys are none, some lines lack their last cell."""
    k = F.col("o_orderkey")
    price = F.when(k % 50 == 1, F.concat(F.col("o_totalprice").cast("string"), F.lit("x"))).otherwise(F.col("o_totalprice").cast("string"))
    key = F.when(k % 70 == 2, F.concat(F.lit("no"), k.cast("string"))).otherwise(k.cast("string"))
    line = F.when(k % 90 == 3, F.concat_ws(";", key, price)).otherwise(F.concat_ws(";", key, price, F.col("o_orderstatus")))
    path = scratch_path(spark, name)
    table(spark, folder, "orders").select(line.alias("value")).write.text(path)
    return Sc.read_checked(spark, path, "o_orderkey bigint, o_totalprice double, o_orderstatus string", sep=";", header=False)


@query("checked_rows", """
SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderkey % 50 <> 1 AND o_orderkey % 70 <> 2 AND o_orderkey % 90 <> 3
""")
def checked_rows(spark, folder):
    """The lines of a damaged file that have the types of the schema."""
    return _damaged(spark, folder, "checked_rows")[0]


@query("checked_rejects", """
SELECT 'o_orderkey' AS column, 'no' || o_orderkey AS key, count(*) AS n FROM orders WHERE o_orderkey % 70 = 2 AND o_orderkey % 90 <> 3 GROUP BY 2
UNION ALL
SELECT 'o_totalprice', NULL, count(*) FROM orders WHERE o_orderkey % 50 = 1 AND o_orderkey % 90 <> 3
UNION ALL
SELECT NULL, CASE WHEN o_orderkey % 70 = 2 THEN 'no' ELSE '' END || o_orderkey, count(*) FROM orders WHERE o_orderkey % 90 = 3 GROUP BY 2
""")
def checked_rejects(spark, folder):
    """What a typed scan of a damaged file couldn't read: cells by their column, lines by their first cell."""
    rejects = _damaged(spark, folder, "checked_rejects")[1]
    key = F.when(F.col("column").isNull(), F.substring_index("raw", ";", 1)).when(F.col("column") == "o_orderkey", F.col("raw"))
    return rejects.groupBy("column", key.alias("key")).agg(F.count(F.lit(1)).alias("n"))


@query("changed_regions", """
SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       o_orderpriority AS Region FROM orders
""")
def changed_regions(spark, folder):
    """A table saved twice: the second time only the region whose content differs is written."""
    df = _orders(spark, folder).select("o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("Region"))
    path = scratch_path(spark, "changed_regions")
    Rd.save_changed(df, path)
    Rd.save_changed(df.withColumn(
        "o_totalprice", F.when(F.col("Region") == "1-URGENT", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))), path)
    return spark.read.parquet(path)
