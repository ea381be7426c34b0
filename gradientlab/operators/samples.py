"""Survey records stored by sample, so that totals and joins per sample need no shuffle.

A store is two bucketed tables: ordinary samples, bucketed by sample, and hot
ones (more than ``hot_rows`` rows), bucketed by sample and salt, so that no
bucket file holds more of one sample than its share.  Rows are shuffled once,
when they are stored; every later total, relative cover or join by sample reads
the buckets as they lie.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.semantics import ratio
from ..session import scratch_path, stage_table
from .community import sample_totals

SAMPLE, SALT = "sample_id", "sample_salt"


def sample_id(*keys: str) -> Column:
    """The key columns as one text that is never NULL; missing parts are told apart from any text."""
    parts = [F.col(f"`{k}`").cast("string").alias(f"k{i}") for i, k in enumerate(keys)]
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})


@dataclass(frozen=True)
class SampleStore:
    """Where the records of a survey lie: a table of ordinary samples, a table of hot ones."""

    name: str
    columns: tuple[str, ...]
    buckets: int
    salts: int

    def ordinary(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name)

    def hot(self, spark: SparkSession) -> DataFrame:
        return spark.table(f"{self.name}_hot")

    def records(self, spark: SparkSession) -> DataFrame:
        """The rows that were stored, without what the store added."""
        columns = [F.col(f"`{c}`") for c in self.columns]
        return self.ordinary(spark).select(*columns).unionAll(self.hot(spark).select(*columns))

    def drop(self, spark: SparkSession) -> None:
        """Forget the tables; their files go with the folder that they lie in."""
        for name in (self.name, f"{self.name}_hot"):
            spark.sql(f"DROP TABLE IF EXISTS `{name}`")


def store_samples(
    df: DataFrame,
    name: str,
    keys: Sequence[str],
    path: str | None = None,
    buckets: int | None = None,
    hot_rows: int = 1_000_000,
    salts: int | None = None,
) -> SampleStore:
    """Write ``df`` as tables ``name`` and ``name_hot``, bucketed and sorted by sample; an existing store is replaced.

    The files go below ``path`` (else the scratch folder).  There are as many buckets, one file each, as the session
    has shuffle partitions, and as many salts, unless given.  A row's salt is its place in a written table, so repeated
    rows are spread too and a task that runs again gives the same ones.  Rows with missing keys are samples of their own.
    """
    spark = df.sparkSession
    clash = {SAMPLE, SALT, "__hot"} & set(df.columns)
    if clash:
        raise ValueError(f"columns reserved for the store: {sorted(clash)}")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    salts = salts or buckets
    path = path or scratch_path(spark, f"samples/{name}")
    marked = df.withColumn(SAMPLE, sample_id(*keys))
    sizes = marked.groupBy(SAMPLE).agg(F.count(F.lit(1)).alias("n"))
    hot = stage_table(sizes.filter(F.col("n") > hot_rows).select(F.col(SAMPLE).alias("__hot")), "samples/hot")
    staged = stage_table(marked.join(hot, F.col(SAMPLE) == F.col("__hot"), "left"), "samples/marked")
    store = SampleStore(name, tuple(df.columns), buckets, salts)
    store.drop(spark)
    _write(staged.filter(F.col("__hot").isNull()).drop("__hot"), name, f"{path}/ordinary", buckets, [SAMPLE])
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
    apart = staged.withColumn(SALT, salt).filter(F.col("__hot").isNotNull()).drop("__hot")
    _write(apart, f"{name}_hot", f"{path}/hot", buckets, [SAMPLE, SALT])
    return store


def _write(df: DataFrame, name: str, path: str, buckets: int, by: list[str]) -> None:
    rows = df.repartition(buckets, *by)  # the partitions are the buckets: one file each
    rows.write.mode("overwrite").bucketBy(buckets, *by).sortBy(*by).option("path", path).format("parquet").saveAsTable(name)


def stored_totals(store: SampleStore, spark: SparkSession, value: str = "Cover", residual: bool = True) -> tuple[DataFrame, DataFrame]:
    """Totals by sample of ordinary and of hot samples, as ``community.sample_totals`` has them.

    The first come without any exchange; the second move one row per salt.
    """
    ordinary = sample_totals(store.ordinary(spark), [SAMPLE], value, residual)
    parts = store.hot(spark).groupBy(SAMPLE, SALT).agg(F.sum(value).alias(value))
    return ordinary, sample_totals(parts, [SAMPLE], value, residual)


def stored_relative_cover(store: SampleStore, spark: SparkSession, value: str = "Cover", residual: bool = True) -> DataFrame:
    """``community.relative_cover`` of a stored survey; no record is shuffled."""
    ordinary, hot = stored_totals(store, spark, value, residual)
    totals = lambda df: df.select(SAMPLE, "Total_Cover")
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(store.salts - 1))).alias(SALT)
    out = [F.col(f"`{c}`") for c in store.columns] + [F.col("Total_Cover"), ratio(value, "Total_Cover").alias("Rel_Cover")]
    plain = store.ordinary(spark).join(totals(ordinary), SAMPLE).select(*out)
    salted = store.hot(spark).join(totals(hot).select("*", every_salt), [SAMPLE, SALT]).select(*out)
    return plain.unionAll(salted)
