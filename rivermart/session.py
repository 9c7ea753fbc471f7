"""Session settings for the pipeline."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
# On a cluster, streaming state lives in RocksDB so that it may outgrow the heap.
CLUSTER_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  **settings: str) -> SparkSession:
    """A session with the pipeline's settings; ``settings`` override them."""
    builder = SparkSession.builder.appName("rivermart")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    local = bool(master) and master.startswith("local")
    for name, value in {**SETTINGS, **({} if local else CLUSTER_SETTINGS), **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
