"""Materialised intermediate tables on shared storage.

A staged table is written once as parquet into the folder named by
``spark.checkpoint.dir`` and read back. It cuts the lineage and survives the
loss of executors. Only a local session without that setting gets a temporary
folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from panelkit.errors import PanelError


def shared_folder(spark: SparkSession) -> str:
    """Shared folder of this session; fails on a cluster that names none."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    if folder:
        return folder.rstrip("/")
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise PanelError(
            "set spark.checkpoint.dir to a folder every executor can reach; "
            "staged tables need shared storage"
        )
    folder = tempfile.mkdtemp(prefix="panelkit-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir().rstrip("/")


def application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/panelkit-{spark.sparkContext.applicationId}"


def file_system(spark: SparkSession, location: str):
    """(Hadoop file system, path) of a location."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, location: str) -> bool:
    system, path = file_system(spark, location)
    return system.exists(path)


def staged_path(df: DataFrame, name: str = "table") -> str:
    """Write ``df`` into the shared folder and return its path."""
    path = f"{application_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return path


def stage(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once and return a scan of what was written."""
    return df.sparkSession.read.schema(df.schema).parquet(staged_path(df, name))


def release(spark: SparkSession) -> None:
    """Delete every table this application staged."""
    system, path = file_system(spark, application_folder(spark))
    system.delete(path, True)
