"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job relies on.  Skewed join sides are split by AQE
# even where that costs one more exchange: a single site, plot or species may
# hold a large share of all rows.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(
    cores: int | str = "*", partitions: int = 8, app: str = "gradientlab", checkpoint_dir: str = "/tmp/gradientlab-scratch"
) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        # file sizes are compressed sizes; on one machine a shuffled join beats building a table of many MB
        .config("spark.sql.autoBroadcastJoinThreshold", "2MB")
        .config("spark.checkpoint.dir", checkpoint_dir)
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def scratch_root(spark: SparkSession) -> str:
    """Folder shared by driver and executors: ``spark.checkpoint.dir``.

    Where that setting is absent, the warehouse folder serves, which driver and
    executors of a session share too.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"


def run_folder(spark: SparkSession) -> str:
    """Where everything that this application stages lies."""
    return f"{scratch_root(spark)}/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other call gets."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back (cuts lineage).

    Every call has a path of its own, so frames staged earlier, also under the
    same name, stay readable until ``clear_run``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_run(spark: SparkSession) -> bool:
    """Remove all that this application staged; frames read from there end with it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    return bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))
