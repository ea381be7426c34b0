"""Scans that number their rows, and typed scans that report what they can't read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import stage_table

_CORRUPT = "__corrupt"


def with_row_numbers(df: DataFrame, out: str = "row_no", file: str | None = None) -> DataFrame:
    """Number the rows of every file from 1, in the order of its lines; ``file`` names a column for its path.

    ``df`` comes straight from a file reader.  A large file is read in several splits: rows are counted per split, the
    counts of the splits before it are added up within the file, and a row's place in its split is counted
    by the scan itself, so no rows are shuffled or sorted.  File and split alone decide the number, so a task
    that is run again gives the same.  The counts (one row a split) are written, so that their size is known.
    """
    path, start, at = F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    rows = df.select(*df.columns, path.alias("__file"), start.alias("__start"), at.alias("__at"))
    splits = rows.groupBy("__file", "__start").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))
    before = Window.partitionBy("__file").orderBy("__start").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first") + 1
    shifts = stage_table(splits.select("__file", "__start", shift.alias("__shift")), "row_numbers")
    extra = [F.url_decode(F.regexp_replace("__file", r"\+", "%2B")).alias(file)] if file else []
    return rows.join(shifts, ["__file", "__start"]).select(
        *df.columns, *extra, (F.col("__at") + F.col("__shift")).cast("bigint").alias(out))


def read_checked(
    spark: SparkSession, path: str | Sequence[str], schema: StructType | str, sep: str = ",", null: str = "NA", header: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of delimited text, from one read: every line is in exactly one of them.

    ``rows`` has the columns of ``schema`` and holds the lines whose cells all have their type; a cell is NULL only where
    the file has the missing-value token or nothing.  ``rejects`` has file, line, column and raw: one row for
    each cell that isn't of its column's type, and one with a NULL column and the whole line where the number of
    cells is wrong.  Lines count from 1, with the header; blank lines are no lines, as for the reader.
    """
    fields = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    texts = StructType([StructField(f.name, StringType()) for f in fields] + [StructField(_CORRUPT, StringType())])
    lines = (
        spark.read.schema(texts).option("header", header).option("sep", sep).option("nullValue", null)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT)
        .csv(path if isinstance(path, str) else list(path))
    )
    lines = with_row_numbers(lines, "__line", "__path")
    cell = lambda column, raw: F.struct(column.cast("string").alias("column"), raw.alias("raw"))
    typed = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in fields}
    wrong = [F.when(F.col(f"`{n}`").isNotNull() & value.isNull(), cell(F.lit(n), F.col(f"`{n}`"))) for n, value in typed.items()]
    bad = F.when(F.col(_CORRUPT).isNotNull(), F.array(cell(F.lit(None), F.col(_CORRUPT)))).otherwise(F.array_compact(F.array(*wrong)))
    checked = stage_table(lines.select(
        F.col("__path"), (F.col("__line") + int(header)).alias("__line"), bad.alias("__bad"),
        *[value.alias(n) for n, value in typed.items()]), "checked")
    rows = checked.filter(F.size("__bad") == 0).select(*[F.col(f"`{f.name}`") for f in fields])
    rejects = checked.filter(F.size("__bad") > 0).select(
        F.col("__path").alias("file"), F.col("__line").alias("line"), F.inline("__bad"))
    return rows, rejects
