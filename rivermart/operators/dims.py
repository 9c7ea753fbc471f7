"""Dimension tables: projections of change records and the flattening joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rivermart import schemas
from rivermart.functions import parse_records
from rivermart.operators.lookup import lookup
from rivermart.operators.skew import DEFAULT, Skew


def category1(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return parse_records(records, schemas.CATEGORY1, keep=keep)


def category2(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return parse_records(records, schemas.CATEGORY2, keep=keep)


def category3(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return parse_records(records, schemas.CATEGORY3, keep=keep)


def spu(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return parse_records(records, schemas.SPU, keep=keep)


def user(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return parse_records(records, schemas.USER, keep=keep)


def province(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return parse_records(records, schemas.PROVINCE_INPUT, keep=keep)


def sku(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return parse_records(records, schemas.SKU_INPUT, keep=keep)


def with_region(provinces: DataFrame, regions: DataFrame, skew: Skew = DEFAULT) -> DataFrame:
    """Provinces with their region's name."""
    return lookup(provinces, regions, "region_id", "id", {"region_name": "region_name"}, skew)


def flatten_sku(skus: DataFrame, trademarks: DataFrame, categories3: DataFrame,
                categories2: DataFrame, categories1: DataFrame, spus: DataFrame,
                skew: Skew = DEFAULT) -> DataFrame:
    """SKUs with the names of their trademark, SPU and three category levels.

    The categories are a chain: without a level, the levels above it are NULL.
    """
    # The levels are joined to each other first: the SKUs are then looked up in one table.
    levels = lookup(categories3.select("id", F.col("name").alias("category3_name"), "category2_id"), categories2,
                    "category2_id", "id", {"category2_name": "name", "category1_id": "category1_id"}, skew)
    levels = lookup(levels, categories1, "category1_id", "id", {"category1_name": "name"}, skew, categories2)
    names = ("category3_name", "category2_id", "category2_name", "category1_id", "category1_name")
    flat = lookup(skus, trademarks, "tm_id", "tm_id", {"tm_name": "tm_name"}, skew)
    flat = lookup(flat, levels, "category3_id", "id", {name: name for name in names}, skew, skus)
    flat = lookup(flat, spus, "spu_id", "id", {"spu_name": "spu_name"}, skew, skus)
    carried = [name for name in skus.columns if name not in schemas.SKU]
    return flat.select(*schemas.SKU, *carried)
