"""Scans of delimited files, folders, exported sheets and Parquet; sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import extract
from ..session import stage_table


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str,
    sep: str = ",",
    null: str = "NA",
) -> DataFrame:
    """Delimited text with a header and a declared schema; ``null`` is the missing-value token."""
    return (
        spark.read.schema(schema)
        .option("header", True).option("sep", sep).option("nullValue", null)
        .option("mode", "PERMISSIVE")
        .csv(path if isinstance(path, str) else list(path))
    )


def read_named(spark: SparkSession, files: Mapping[str, str], schemas: Mapping[str, str], **kw) -> dict[str, DataFrame]:
    """One delimited file per logical table."""
    return {name: read_delimited(spark, path, schemas[name], **kw) for name, path in files.items()}


def read_union(
    spark: SparkSession, sources: Sequence[tuple[str | Sequence[str], StructType | str]], **kw
) -> DataFrame:
    """Union by name of files with different columns; absent columns are NULL."""
    frames = [read_delimited(spark, path, schema, **kw) for path, schema in sources]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_file_tags(df: DataFrame, **patterns: str | tuple[str, int]) -> DataFrame:
    """Columns taken from the path of the file a row was read from.

    Each keyword is a column name with a regex, whose whole match is the value, or
    with (regex, group number); NULL when it does not match.
    """
    # file_path is percent-encoded; a literal plus sign must survive the decoding
    path = F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B"))
    cols = {}
    for name, pattern in patterns.items():
        pattern, group = (pattern, 0) if isinstance(pattern, str) else pattern
        cols[name] = extract(path, pattern, group)
    return df.withColumns(cols)


def read_sheets(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType | str,
    tag: str = "turfID",
    prefix: str = "T",
    sheet: str = r"/(\d+)[^/]*\.csv$",
    **kw,
) -> DataFrame:
    """Sheets exported to one file each; the number a sheet name starts with becomes the tag.

    Sheets without such a number (notes, species lists) are left out.
    """
    df = with_file_tags(read_delimited(spark, path, schema, **kw), __sheet=(sheet, 1))
    df = df.filter(F.col("__sheet").isNotNull())
    return df.withColumn(tag, F.concat(F.lit(prefix), F.col("__sheet"))).drop("__sheet")


def row_window(df: DataFrame, first: int, last: int, row_no: str = "row_no") -> DataFrame:
    """Rows of a sheet range, by the row number that was stored at export or made at the scan."""
    return df.filter(F.col(row_no).between(first, last))


def read_tables(spark: SparkSession, folder: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """Parquet tables of a folder by name."""
    return {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in names}


def write_csv(df: DataFrame, path: str, sep: str = ",", null: str = "NA") -> str:
    df.write.mode("overwrite").option("header", True).option("sep", sep).option("nullValue", null).csv(path)
    return path


def write_table(df: DataFrame, path: str, partition: Sequence[str] = ("Region",)) -> str:
    """Parquet partitioned by region.

    The rebalance hint gathers the rows of a region into few files and lets AQE
    split regions that are too large for one task.  Only the regions in ``df``
    are replaced; others that the table holds stay as they are.
    """
    cols = list(partition)
    out = df.hint("rebalance", *cols) if cols else df
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path)
    return path


def fingerprints(df: DataFrame, key: str) -> DataFrame:
    """(key, rows, total, mixed): what the content of each value of ``key`` adds up to, in any order of its rows and columns."""
    columns = [F.col(f"`{c}`") for c in sorted(df.columns)]
    hashed = df.select(F.col(f"`{key}`").cast("string").alias(key), F.xxhash64(*columns).alias("__a"), F.xxhash64(F.lit(1), *columns).alias("__b"))
    return hashed.groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("__a").cast("decimal(20,0)")).alias("total"), F.bit_xor("__b").alias("mixed"))


def save_changed(df: DataFrame, path: str, key: str = "Region") -> DataFrame:
    """Write the regions of ``df`` whose content differs from what was saved last; returns the fingerprints of those written.

    The fingerprints of all saved regions lie beside the table, in a folder that readers of the table skip.  They are
    written after the rows, so a run that breaks off writes its regions again.  Regions that aren't in ``df`` stay.
    """
    spark = df.sparkSession
    aside = f"{path}/_fingerprints"
    now = stage_table(fingerprints(df, key), "fingerprints/now")
    known = _saved(spark, aside, now)
    same = ["rows", "total", "mixed"]
    old = known.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__{c}") for c in same])
    equal = F.col(key).eqNullSafe(F.col("__key"))
    for c in same:
        equal = equal & (F.col(c) == F.col(f"__{c}"))
    changed = stage_table(now.join(old, equal, "left_anti"), "fingerprints/changed")
    if changed.isEmpty():
        return changed
    wanted = changed.select(F.col(key).alias("__key"))
    write_table(df.join(wanted, F.col(f"`{key}`").cast("string").eqNullSafe(F.col("__key")), "left_semi"), path, [key])
    kept = known.join(wanted, F.col(key).eqNullSafe(F.col("__key")), "left_anti")
    stage_table(kept.unionByName(changed), "fingerprints/all").write.mode("overwrite").parquet(aside)
    return changed


def _saved(spark: SparkSession, aside: str, like: DataFrame) -> DataFrame:
    """The fingerprints written last; none where nothing was saved."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{aside}/_SUCCESS")
    there = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
    return stage_table(spark.read.schema(like.schema).parquet(aside), "fingerprints/saved") if there else like.limit(0)
