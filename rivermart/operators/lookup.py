"""Left lookups of facts in keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rivermart.operators.skew import (
    CHUNK, DEFAULT, Skew, Spread, apply_spread, find_hot, fits_broadcast)

_DIM_KEY = "_dim_key"


def lookup_side(dim: DataFrame, key: str, columns: dict[str, str | Column],
                key_type: str | None = None) -> DataFrame:
    """The lookup table cut down to its key and the wanted columns (new name -> column)."""
    key_column = F.col(key) if key_type is None else F.col(key).try_cast(key_type)
    return dim.select(key_column.alias(_DIM_KEY), *(
        (F.col(column) if isinstance(column, str) else column).alias(name)
        for name, column in columns.items()))


def lookup(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
           columns: dict[str, str | Column], skew: Skew = DEFAULT,
           counted: DataFrame | None = None) -> DataFrame:
    """Add columns of ``dim`` to the facts by key; facts without a match get NULLs.

    ``dim`` holds one row per key, as the keyed tables do. It is broadcast if
    its estimated size allows; otherwise the facts are shuffled, with hot keys
    spread over several tasks. The table's key takes the facts' key type.
    ``counted`` is the table behind the facts, if those are derived: hot keys
    are then looked for there.
    """
    side = lookup_side(dim, dim_key, columns, facts.schema[fact_key].dataType.simpleString())
    hot = None if fits_broadcast(side, skew) else find_hot(
        facts if counted is None else counted, fact_key, skew)
    # Any chunk is right here, so copies of one fact are parted by their task.
    cut = apply_spread(facts, fact_key, hot, lambda chunks: F.pmod(
        F.xxhash64(*facts.columns) + F.spark_partition_id(), chunks), skew)
    return lookup_spread(cut, side).result()


def lookup_spread(facts: Spread, side: DataFrame) -> Spread:
    """Lookup on the facts' own spread key; ``side`` comes from ``lookup_side``."""
    match = F.col(facts.key) == F.col(_DIM_KEY)
    if fits_broadcast(side, facts.skew):
        return facts.on(facts.rows.join(F.broadcast(side), match, "left").drop(_DIM_KEY))
    other = facts.replicate(side, _DIM_KEY)
    if facts.hot is not None:
        other = other.withColumnRenamed(CHUNK, "_dim_chunk")
        match = match & (F.col(CHUNK) == F.col("_dim_chunk"))
    return facts.on(facts.rows.join(other, match, "left").drop(_DIM_KEY, "_dim_chunk"))


def first_per_key(rows: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """One row per key, the first in the given order.

    Spark keeps the first row per key on the map side before the shuffle, so
    a key with many rows costs one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def keyed_scan(dim: DataFrame, dim_key: str, facts: DataFrame, fact_key: str,
               skew: Skew = DEFAULT) -> DataFrame:
    """The rows of ``dim`` whose key occurs in the facts."""
    kind = dim.schema[dim_key].dataType.simpleString()
    keys = facts.select(F.col(fact_key).cast(kind).alias(_DIM_KEY)).distinct()
    if fits_broadcast(keys, skew):
        keys = F.broadcast(keys)
    return dim.join(keys, F.col(dim_key) == F.col(_DIM_KEY), "left_semi")
