"""Tables that are the state of a running stream, read with Spark's state data source.

They show the state after the last committed batch; what they read are the
checkpoint's state files, so the stream goes on meanwhile.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def _operator(spark: SparkSession, checkpoint: str, name: str) -> int:
    """The number of the checkpoint's only operator of a kind."""
    every = spark.read.format("state-metadata").load(checkpoint)
    (found,) = every.where(F.col("operatorName") == name).select("operatorId").distinct().collect()
    return found[0]


def _read(spark: SparkSession, checkpoint: str, name: str) -> DataFrame:
    return spark.read.format("statestore").option("operatorId", _operator(spark, checkpoint, name)).load(checkpoint)


def dimension_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The newest row per key of a dimension job."""
    rows = _read(spark, checkpoint, "stateStoreSave")
    # Of an aggregate's buffers the first is the newest row, the second its place.
    newest = rows.schema["value"].dataType.fieldNames()[0]
    return rows.select("key.*", f"value.{newest}.*")


def user_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(user_id, if_consumed) of the users of whom the order job has seen an order."""
    return _read(spark, checkpoint, "dedupe").select(
        F.col("key.user_id").cast("string").alias("user_id"), F.lit("1").alias("if_consumed"))

