"""Session helpers: checkpoint directory lookup and a local session for tests/bench.

Library code never sets cluster configuration.  The checkpoint directory is
the one the cluster names in ``spark.checkpoint.dir``; ``local_session`` (tests
and bench only) sets one under a fresh scratch folder when it is unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The reliable checkpoint directory, applying ``spark.checkpoint.dir`` if set."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir()
    return None


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote, on the file system its path names."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, on the file system its path names."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  scratch: str | None = None, app: str = "tallycast") -> SparkSession:
    """A local[N] session with the UI off, AQE on and a scratch checkpoint dir."""
    scratch = scratch or tempfile.mkdtemp(prefix="tallycast-")
    b = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # PySpark 4 records the Python call site of every Column function for
        # error messages, ~10 JVM round trips per call; off for batch jobs.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TALLYCAST_DRIVER_MEMORY", "8g"))
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .config("spark.driver.extraJavaOptions", f"-Dderby.system.home={scratch}")
    )
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if checkpoint_dir(spark) is None:
        spark.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    return spark
