"""Folders for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def scratch_folder(spark: SparkSession, parent: str | None = None) -> str:
    """A new, unused path under ``parent``, else under the folder of ``spark.checkpoint.dir``.

    Either must be a folder that all executors can reach; tables written there
    survive the loss of executors.
    """
    parent = parent or spark.conf.get("spark.checkpoint.dir", None)
    if not parent:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    return f"{parent.rstrip('/')}/postlens-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of the store that its path names; nothing happens if there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
