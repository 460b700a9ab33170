"""Session settings and the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SHARED_FOLDER = "spark.checkpoint.dir"


def build_session(app_name: str = "keepsake", **settings: str) -> SparkSession:
    """A session with this library's defaults. The master and its sizes come from spark-submit."""
    builder = SparkSession.builder.appName(app_name).config("spark.sql.session.timeZone", "UTC")
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, as named by ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder. A cluster session without it
    is refused: a folder on one machine is not visible to the other executors.
    """
    context = spark.sparkContext
    folder = spark.conf.get(SHARED_FOLDER, None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {SHARED_FOLDER} to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="keepsake-"))
    return context.getCheckpointDir()


def new_shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table, below the shared folder.

    It lasts as long as the driver, which deletes it when it ends: results that are still to be
    computed may read it until then.
    """
    path = f"{shared_folder(spark)}/keepsake/{name}-{uuid.uuid4().hex}"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path
