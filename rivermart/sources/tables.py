"""Table reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, path: str, kind: str = "parquet",
               schema: str | None = None, **options: str) -> DataFrame:
    """A whole table; columns and filters used later are pushed into the scan.

    ``kind`` may be "jdbc" with its usual options (``path`` is then the table).
    """
    reader = spark.read.format(kind).options(**options)
    if schema:
        reader = reader.schema(schema)
    if kind == "jdbc":
        return reader.option("dbtable", path).load()
    return reader.load(path)
