"""Session settings and the shared work folder.

Intermediate results that are read more than once, and every round of an
iterative operator, are written to the folder that all executors share
(``spark.checkpoint.dir``). They survive the loss of an executor and cut the
lineage; ``localCheckpoint`` is never used.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings that every session of the library wants; a cluster adds its own.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.ui.enabled": "false",
}


def local_session(cores: int = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-JVM session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("archivolt")
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.driver.memory", memory)
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def work_folder(spark: SparkSession) -> str:
    """The shared folder: the session's ``spark.checkpoint.dir``; a local session without one gets a temporary folder.

    On a cluster the setting must be there, as no folder of one machine outlives it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="archivolt-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def _remove(spark: SparkSession, path: str) -> None:
    try:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may be gone at exit
        pass


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The copy is removed when the process ends, or earlier with :func:`discard`.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark)}/archivolt-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    back = spark.read.schema(df.schema).parquet(path)
    back._archivolt_path = path
    return back


def discard(df: DataFrame) -> None:
    """Drop a copy written by :func:`materialize` that no later plan reads."""
    path = getattr(df, "_archivolt_path", None)
    if path:
        _remove(df.sparkSession, path)


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer pieces than there are cores, dealt out to all of them; larger scans stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
