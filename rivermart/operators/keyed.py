"""Keyed tables: the newest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rivermart.operators.lookup import first_per_key


def upsert_latest(current: DataFrame | None, changes: DataFrame, keys: list[str],
                  order: list[str]) -> DataFrame:
    """The table after the changes: per key the row that is last by ``order``."""
    rows = changes if current is None else current.unionByName(changes, allowMissingColumns=True)
    return first_per_key(rows, keys, *(F.desc_nulls_last(name) for name in order))


def newest_per_key(changes: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Per key the columns of the row that is last by ``order``, as an aggregate: on a stream, the
    newest row of every key is its state, and each batch gives the keys it has changed."""
    columns = [name for name in changes.columns if name not in (*keys, *order)]
    newest = F.max_by(F.struct(*columns), F.struct(*order)).alias("_newest")
    return changes.groupBy(*keys).agg(newest).select(*keys, "_newest.*")
