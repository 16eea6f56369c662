"""Scratch folders on storage that every executor can reach."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, label: str = "run") -> str:
    """A fresh path below the cluster's ``spark.checkpoint.dir``.

    A local folder is used only where the session names none and runs on one machine;
    on a cluster, executors would not see each other's files there. Nothing below the
    path is deleted here: what is written lives as long as its reader may need it, and
    the folder's owner clears it like other checkpoints.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="barloom-")
