"""Session settings and the folder all executors share."""

from __future__ import annotations

import atexit
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app_name: str = "ledgerloom", **settings: str) -> SparkSession:
    """Session in UTC.

    The number of shuffle partitions is left to adaptive execution and to the cluster's own settings.
    Partitioned tables are only ever appended to or written as a new version, so no overwrite mode is set.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        # call sites of every expression are only needed while debugging
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables, which all executors share: ``spark.checkpoint.dir``."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    return folder.rstrip("/")


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below the shared one, removed when this process ends."""
    folder = f"{shared_folder(spark)}/ledgerloom-{uuid.uuid4().hex}"
    atexit.register(remove_folder, spark, folder)
    return folder


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a scratch folder; a session whose JVM is gone leaves it to the owner of the shared folder."""
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    except (Py4JError, OSError, AttributeError):
        pass
