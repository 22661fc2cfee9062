"""Spark session helpers.

Everything in the library takes a ``SparkSession`` from the caller; this module
only builds one for tests, the bench and command-line use, and resolves the
shared folder used to cut lineage or stage files.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on.  AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed ones.
SESSION_DEFAULTS: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app: str = "constella",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local session for tests and the bench (a cluster passes its own session)."""
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is.  Only when it is unset (local runs, tests) is a fresh local folder
    created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="constella-ckpt-", dir=os.environ.get("CONSTELLA_SCRATCH", "/tmp"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder (for staged tables)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
    jvm = spark.sparkContext._jvm
    staged = jvm.org.apache.hadoop.fs.Path(path)
    # staged copies go when the session's JVM ends
    staged.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(staged)
    return path


def staged(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back; ``options`` are the writer's.

    Cuts the lineage (a lost executor reruns nothing upstream) and gives AQE real file sizes.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**{"compression": "zstd", **(options or {})}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
