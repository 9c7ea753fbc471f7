"""Folders for checkpoints, staged files and tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder path for one run, below the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/rivermart/{purpose}-{uuid.uuid4().hex}"


def _located(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def remove_folder(spark: SparkSession, folder: str) -> None:
    files, path = _located(spark, folder)
    files.delete(path, True)


def finished_batches(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the folders batch=<number> that Spark has written to the end, in order."""
    files, path = _located(spark, f"{folder}/batch=*/_SUCCESS")
    return sorted(int(mark.getPath().getParent().getName().split("=")[1]) for mark in files.globStatus(path) or ())
