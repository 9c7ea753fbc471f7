"""Dimension tables that stay where they are when facts look them up."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def save_bucketed(rows: DataFrame, table: str, key: str, key_type: str, buckets: int,
                  path: str | None = None) -> DataFrame:
    """Save a keyed table in ``buckets`` by a hash of its key, sorted, and return it as a table.

    The key is stored in the facts' type (a key that is none is left out), so a lookup
    compares it as it is: then only the facts are shuffled, to the table's buckets.
    Choose buckets of some 100 MB; with ``path`` the files lie there.
    """
    typed = rows.withColumn(key, F.col(key).try_cast(key_type)).where(F.col(key).isNotNull())
    writer = (typed.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key))
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return rows.sparkSession.table(table)
