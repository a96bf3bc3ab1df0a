"""Session settings and the scratch folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on; all can be changed in a running session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # "v" is a column, as in the SQL users bring along, not a string literal
    "spark.sql.ansi.doubleQuotedIdentifiers": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the operators need; cluster sizing stays as it is."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and measurements."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("graticule")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local folder would be lost with its executor.
    """
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="graticule-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch folder."""
    return os.path.join(scratch_dir(spark), f"{label}-{uuid.uuid4().hex}")


def _remove_at_end(spark: SparkSession, path: str) -> None:
    """Have a written folder removed when the application ends."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: small iteration state survives executor loss."""
    scratch_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the scratch folder and read it back (columnar, prunable)."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    _remove_at_end(df.sparkSession, path)
    return df.sparkSession.read.parquet(path)


def discard(*frames: DataFrame) -> None:
    """Remove the files of materialized frames once nothing reads them any more, also through frames made of them."""
    for df in frames:
        spark = df.sparkSession
        for folder in {os.path.dirname(f) for f in df.inputFiles()}:
            place = spark._jvm.org.apache.hadoop.fs.Path(folder)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def release(spark: SparkSession) -> None:
    """Free shuffle files and broadcasts that no frame refers to any more, here and on the executors.

    Spark's cleaner removes them once the driver's garbage collector has seen that they are
    unused, which a driver that holds little can put off until the disks are full.
    """
    spark._jvm.System.gc()
