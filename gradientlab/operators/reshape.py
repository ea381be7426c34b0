"""Column selection, wide/long conversion, row positions, counts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.semantics import null_safe_join, recode
from ..functions.text import extract, part


# -- columns ----------------------------------------------------------------

def column_range(df: DataFrame, first: str, last: str) -> list[str]:
    """Names from ``first`` to ``last`` in frame order."""
    names = df.columns
    return names[names.index(first): names.index(last) + 1]


def columns_where(
    df: DataFrame, starts: str | None = None, contains: str | None = None, types: Sequence[str] | None = None
) -> list[str]:
    """Names by prefix, content or type."""
    return [
        c for c, t in df.dtypes
        if (starts is None or c.startswith(starts))
        and (contains is None or contains in c)
        and (types is None or t in types)
    ]


def mutate_all(df: DataFrame, columns: Sequence[str], f: Callable[[Column], Column]) -> DataFrame:
    """Apply one expression to several columns in a single projection."""
    chosen = set(columns)
    return df.select(*[f(F.col(f"`{c}`")).alias(c) if c in chosen else F.col(f"`{c}`") for c in df.columns])


def sum_numeric(df: DataFrame, keys: Sequence[str], agg: Callable[[str], Column] = F.sum) -> DataFrame:
    """Sum of every numeric column per key."""
    kinds = ("tinyint", "smallint", "int", "bigint", "float", "double")
    cols = [c for c, t in df.dtypes if t in kinds and c not in keys]
    return df.groupBy(*keys).agg(*[agg(c).alias(c) for c in cols])


# -- wide and long ----------------------------------------------------------

def gather(
    df: DataFrame, ids: Sequence[str], name: str, value: str, columns: Sequence[str] | None = None,
    dtype: str | None = None,
) -> DataFrame:
    """Wide to long; NULL values are kept.  Columns default to all but ``ids``."""
    columns = list(columns) if columns is not None else [c for c in df.columns if c not in ids]
    if dtype:
        cast = [F.col(f"`{c}`").try_cast(dtype).alias(c) for c in columns]
        df = df.select(*[F.col(f"`{c}`") for c in ids], *cast)
    return df.unpivot([F.col(f"`{c}`") for c in ids], [F.col(f"`{c}`") for c in columns], name, value)


def spread(df: DataFrame, ids: Sequence[str], key: str, value: str, names: Sequence[str]) -> DataFrame:
    """Long to wide with the new column names given, so no extra job looks for them.

    More than one row for a cell is an error.
    """
    single = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit(f"several rows for one cell of {key}"))).otherwise(F.first(value))
    cells = df.groupBy(*ids, key).agg(single.alias(value))
    return cells.groupBy(*ids).pivot(key, list(names)).agg(F.first(value))


def separate(df: DataFrame, col: str, into: Sequence[str], sep: str) -> DataFrame:
    """Split a column at a regex; extra pieces are dropped, missing ones are NULL."""
    rest = [F.col(f"`{c}`") for c in df.columns if c != col]
    return df.select(*rest, *[part(f"`{col}`", sep, i + 1).alias(n) for i, n in enumerate(into)])


def extract_columns(df: DataFrame, col: str, into: Sequence[str], pattern: str) -> DataFrame:
    """Regex groups into columns, NULL where the pattern does not match."""
    rest = [F.col(f"`{c}`") for c in df.columns if c != col]
    return df.select(*rest, *[extract(f"`{col}`", pattern, i + 1).alias(n) for i, n in enumerate(into)])


def concat_columns(df: DataFrame, groups: Sequence[Mapping[str, str]], keep: Sequence[str] = ()) -> DataFrame:
    """Stack several groups of columns below each other.

    Each mapping gives output name -> input name; all have the same outputs.
    """
    rows = F.array(*[
        F.struct(*[F.col(f"`{src}`").alias(out) for out, src in g.items()]) for g in groups
    ])
    return df.select(*keep, F.inline(rows))


def nest_rows(df: DataFrame, keys: Sequence[str], fields: Sequence[str], out: str = "data") -> DataFrame:
    """One sorted array of structs per key.

    Meant for keys whose number of rows has a known bound (for example species
    of one plot and year, after duplicates were added up).
    """
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(out))


def unnest_rows(df: DataFrame, keys: Sequence[str], col: str = "data") -> DataFrame:
    return df.select(*keys, F.inline(col))


def nest_chunks(
    df: DataFrame, keys: Sequence[str], fields: Sequence[str], size: int = 10_000, out: str = "data", bucket_rows: int = 100_000
) -> DataFrame:
    """Rows per key as arrays of at most ``size`` structs, in chunks numbered from 0; for keys with any number of rows.

    Equal rows are one struct with their number ``n``, so no value can fill a chunk.  The distinct ones are numbered by
    hash buckets (see ``sequence_by_hash``), whose windows stay bounded, and a chunk is a run of these numbers.  Within a
    chunk the structs are sorted; which chunk a row is in is fixed but arbitrary.  ``unnest_chunks`` is the inverse.  An empty
    table has no chunks; NULL is a key and a value like any other; other columns are left out.  No field is called ``n``.
    """
    chosen = [F.col(f"`{c}`") for c in [*keys, *fields]]
    counted = df.groupBy(*chosen).agg(F.count(F.lit(1)).alias("n"))
    numbered = sequence_by_hash(counted, keys, fields, "__k", bucket_rows)
    chunk = F.floor((F.col("__k") - 1) / F.lit(size)).cast("long")
    return numbered.groupBy(*[F.col(f"`{k}`") for k in keys], chunk.alias("chunk")).agg(
        F.array_sort(F.collect_list(F.struct(*[F.col(f"`{c}`") for c in fields], "n"))).alias(out))


def unnest_chunks(df: DataFrame, keys: Sequence[str], col: str = "data") -> DataFrame:
    """The rows that ``nest_chunks`` put into arrays, repeated ones as often as they were."""
    step = 65_536  # a row repeated very often is unrolled in two steps, without a long array
    rows = df.select(*[F.col(f"`{k}`") for k in keys], F.inline(F.col(f"`{col}`")))
    runs = rows.withColumn("__run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / F.lit(step)))))
    left = F.least(F.col("n") - F.col("__run") * F.lit(step), F.lit(step)).cast("int")
    return runs.withColumn("__i", F.explode(F.array_repeat(F.lit(True), left))).drop("__run", "__i", "n")


# -- row positions ----------------------------------------------------------

def slice_rows(df: DataFrame, ranges: Mapping[str, tuple[int, int]], row_no: str = "row_no", tag: str = "block") -> DataFrame:
    """Rows of given ordinal ranges, each tagged with the name of its range."""
    chain = None
    for name, (a, b) in ranges.items():
        cond = F.col(row_no).between(a, b)
        chain = F.when(cond, F.lit(name)) if chain is None else chain.when(cond, F.lit(name))
    return df.withColumn(tag, chain).filter(F.col(tag).isNotNull())


def first_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The row of each key with the smallest ``order`` value.

    An aggregate with map-side combination, so a key may have any number of rows.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(order)).alias("__row"))
    return picked.select(*keys, *[F.col(f"__row.`{c}`").alias(c) for c in rest])


def _sequence(
    df: DataFrame, group: Sequence[str], bucket: Column, order: Sequence[str], out: str, span: int = 10_000
) -> DataFrame:
    """Offsets are summed in two levels, buckets and runs of ``span`` buckets: no window has more rows than that."""
    marked = df.withColumn("__bucket", bucket)
    counts = marked.groupBy(*group, "__bucket").agg(F.count(F.lit(1)).alias("__n")).withColumn(
        "__run", F.floor(F.col("__bucket") / F.lit(span)))
    before = lambda by, order_by: F.coalesce(F.sum("__n").over(
        Window.partitionBy(*by).orderBy(order_by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = counts.groupBy(*group, "__run").agg(F.sum("__n").alias("__n")).withColumn("__before", before(group, "__run")).drop("__n")
    local = counts.withColumn("__within", before([*group, "__run"], "__bucket")).drop("__n")
    offsets = null_safe_join(local, runs, [*group, "__run"]).select(
        *group, "__bucket", (F.col("__before") + F.col("__within")).alias("__offset"))
    inside = Window.partitionBy(*group, "__bucket").orderBy(*order)
    numbered = marked.withColumn("__pos", F.row_number().over(inside))
    joined = null_safe_join(numbered, offsets, [*group, "__bucket"])
    return joined.select(*df.columns, (F.col("__pos") + F.col("__offset")).cast("long").alias(out))


def sequence_in_group(
    df: DataFrame, group: Sequence[str], row_no: str, out: str, bucket_rows: int = 1_000_000
) -> DataFrame:
    """Number the rows of each group 1..n in ``row_no`` order.

    ``row_no`` is a unique whole number.  Rows are numbered inside buckets of
    consecutive ``row_no`` values, and the counts of earlier buckets are added
    on top; no window ever holds more than ``bucket_rows`` rows of a group.
    """
    return _sequence(df, group, F.floor(F.col(row_no) / F.lit(bucket_rows)), [row_no], out)


def sequence_by_hash(
    df: DataFrame, group: Sequence[str], order: Sequence[str], out: str, bucket_rows: int = 100_000
) -> DataFrame:
    """Number the rows of each group 1..n in a fixed but arbitrary order.

    For distinct rows without a row number: rows are spread evenly over hash
    buckets of ``order`` and numbered bucket by bucket.  The rows are counted
    first, for buckets of about ``bucket_rows`` rows of the largest group.
    """
    buckets = max(1, -(-df.count() // bucket_rows))
    return _sequence(df, group, F.pmod(F.xxhash64(*order), F.lit(buckets)), list(order), out)


# -- counts and tables ------------------------------------------------------

def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def crosstab(df: DataFrame, rows: Sequence[str], column: str, levels: Sequence[str]) -> DataFrame:
    """Contingency table with the given column levels; absent combinations count 0.

    A value outside the levels is an error; missing values are not counted.
    """
    level = F.col(f"`{column}`")
    known = F.when(level.isNull() | level.isin(list(levels)), level).otherwise(
        F.raise_error(F.concat(F.lit(f"level of {column} not listed: "), level.cast("string"))))
    table = df.withColumn(column, known).groupBy(*rows).pivot(column, list(levels)).agg(F.count(F.lit(1)))
    return table.na.fill(0, [str(v) for v in levels])


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


# -- sets -------------------------------------------------------------------

def set_difference(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
    """Distinct values of ``a`` that do not occur in ``b``; NULL is a value."""
    return a.select(name).subtract(b.select(name))


def relabel(df: DataFrame, col: str, mapping: Mapping) -> DataFrame:
    return df.withColumn(col, recode(col, mapping))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
