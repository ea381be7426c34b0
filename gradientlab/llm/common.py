"""Shared parts: session settings, folds, bounded samples, Arrow helpers."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import configure, stage_table

#: Rows in one Arrow batch.  Texts may be long, so batches are kept small.
BATCH_ROWS = 512


#: Folder that holds the package.
HOME = str(Path(__file__).resolve().parents[2])


def prepare(spark: SparkSession) -> SparkSession:
    """Settings of this subpackage; Python workers look for the package where the driver found it, too."""
    configure(spark)
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    # glibc: arrays of 1 MB and more go back to the system when they are freed
    environment.update({"MALLOC_MMAP_THRESHOLD_": "1048576", "MALLOC_TRIM_THRESHOLD_": "1048576"})
    if HOME not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join([HOME, known]) if known else HOME
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def crc32_of_id(column: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def held_out(column: str = "doc_id") -> Column:
    """Fold of a document: true where crc32 of its id as text leaves no rest mod 5 (a missing id counts as '')."""
    return crc32_of_id(column) % 5 == 0


def fresh(df: DataFrame, *stems: str) -> list[str]:
    """For each stem a column name that ``df`` doesn't have (whatever the case of its letters)."""
    taken, out = {c.lower() for c in df.columns}, []
    for stem in stems:
        name = stem
        while name.lower() in taken:
            name = f"{stem}_{uuid4().hex[:8]}"
        taken.add(name.lower())
        out.append(name)
    return out


def replace_columns(df: DataFrame, schema: str) -> tuple[DataFrame, T.StructType]:
    """``df`` without the columns named in ``schema``, and the schema with those added behind.

    An operator that adds result columns replaces older columns of the same name.
    """
    added = T.StructType.fromDDL(schema)
    names = {f.name.lower() for f in added}
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in names])
    return kept, T.StructType([*kept.schema.fields, *added.fields])


def add_columns(df: DataFrame, source: str, schema: str, fn: Callable[[pa.Array], list[pa.Array]]) -> DataFrame:
    """Add the columns of ``schema``, computed batch by batch from column ``source`` alone.

    All other columns pass through unchanged; a column of ``df`` that is named
    like an added one is replaced, unless it is the source.
    """
    replaced = {f.name.lower() for f in T.StructType.fromDDL(schema)}
    src = source
    if source.lower() in replaced:  # it is still needed as the source
        (src,) = fresh(df, "__source")
        df = df.withColumn(src, F.col(f"`{source}`"))
    work, out = replace_columns(df, schema)
    index = [c.lower() for c in work.columns].index(src.lower())
    fields = [f for f in out.fields if src == source or f.name != src]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [c for i, c in enumerate(batch.columns) if src == source or i != index]
            yield pa.RecordBatch.from_arrays([*kept, *fn(batch.column(index))], names=names)

    return work.mapInArrow(run, T.StructType(fields))


def keep_rows(df: DataFrame, source: str, fn: Callable[[pa.Array], pa.Array]) -> DataFrame:
    """The rows for which ``fn`` of column ``source`` is true, with all columns as they are."""
    (flag,) = fresh(df, "__keep")
    return add_columns(df, source, f"`{flag}` boolean", lambda column: [fn(column)]).filter(F.col(flag)).drop(flag)


def bounded_sample(df: DataFrame, key: Column, rows: int) -> DataFrame:
    """At most ``rows`` rows, picked by a hash of ``key``.

    A first pass counts; rows are then thinned by their hash before the limit is
    applied, so that the sort behind it gets about ``rows`` rows at any input size.
    """
    total = df.count()
    draw = F.pmod(F.xxhash64(key, F.lit(17)), F.lit(1 << 40))
    if total > rows:
        df = df.filter(draw < int(min(1.0, 1.1 * rows / total) * (1 << 40)))
    return df.orderBy(draw, key).limit(rows)


def sample_by_group(df: DataFrame, group: str, key: Column, rows: int) -> DataFrame:
    """At most ``rows`` rows, as many of each value of ``group`` where it has them, picked by a hash of ``key``.

    Groups are counted first and thinned by the hash, so that what is numbered within a group is about twice what is
    taken, at any input size.  With more groups than rows, the rows with the smallest hashes stay.
    """
    (size,) = fresh(df, "__size")
    sizes = stage_table(df.groupBy(F.col(group).alias("__group")).agg(F.count(F.lit(1)).alias(size)), "sample/sizes")
    quota = max(1, rows // max(1, sizes.count()))
    draw = F.pmod(F.xxhash64(key, F.lit(17)), F.lit(1 << 40))
    share = F.least(F.lit(1.0), F.lit(2.0 * quota + 20) / F.col(size))
    thinned = df.join(sizes, F.col(group) == F.col("__group")).filter(draw < share * F.lit(float(1 << 40))).drop("__group", size)
    (rank,) = fresh(df, "__rank")
    first = F.row_number().over(Window.partitionBy(group).orderBy(draw, key))
    return thinned.withColumn(rank, first).filter(F.col(rank) <= quota).drop(rank).orderBy(draw, key).limit(rows)


def chunks(values: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    for a, b in zip(offsets[:-1], offsets[1:]):
        yield values[a:b]


def gather(ids: np.ndarray, starts: np.ndarray, lengths: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate the slices ``data[starts[i] : starts[i] + lengths[i]]`` for all ids; also the offset before each."""
    size = lengths[ids]
    ends = np.zeros(len(ids) + 1, dtype=np.int64)
    np.cumsum(size, out=ends[1:])
    index = np.arange(ends[-1], dtype=np.int64)
    index += np.repeat(starts[ids] - ends[:-1], size)
    return data[index], ends
