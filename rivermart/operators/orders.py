"""Order facts: typing, first-order flag, province, user and SKU attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rivermart import schemas
from rivermart.functions import age_group, age_years, date_part, hour_part, parse_records
from rivermart.operators.lookup import first_per_key, lookup, lookup_side, lookup_spread
from rivermart.operators.skew import (
    CHUNK, DEFAULT, Skew, Spread, spread)

_FIRST = "_first_key"


def order_info(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return with_time_parts(parse_order_records(records, *keep))


def parse_order_records(records: DataFrame, *keep: str, written: bool = False) -> DataFrame:
    """Enriched orders back from their records, derived columns included."""
    return parse_records(records, schemas.ORDER_INFO, keep=keep, written=written)


def order_detail(records: DataFrame, keep: tuple[str, ...] = (), written: bool = False) -> DataFrame:
    return parse_records(records, schemas.ORDER_DETAIL, keep=keep, written=written)


def with_time_parts(orders: DataFrame) -> DataFrame:
    return orders.withColumns({"create_date": date_part(F.col("create_time")),
                               "create_hour": hour_part(F.col("create_time"))})


def with_order_columns(orders: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """All order columns in order, those not there yet as NULL, and the ``keep`` columns."""
    return orders.select(*(
        F.col(name) if name in orders.columns else F.lit(None).cast(kind).alias(name)
        for name, kind in schemas.ORDER_INFO.items()), *keep)


def unique_orders(orders: DataFrame) -> DataFrame:
    """One row per order id: repeats of an order, if any, go before it is flagged."""
    return first_per_key(orders, ["id"], "create_time", "operate_time", "order_status")


def spread_by_user(orders: DataFrame, skew: Skew = DEFAULT,
                   counted: DataFrame | None = None) -> Spread:
    """Orders cut for the steps that work per user.

    Of a hot user, the earliest order is in chunk 0 and the others may be
    anywhere, so copies of one order are parted by their task.
    """
    def chunk(chunks: Column) -> Column:
        anywhere = F.pmod(F.xxhash64("id") + F.spark_partition_id(), chunks)
        earliest = F.struct("create_time", "id").eqNullSafe(F.col(_FIRST))
        return F.when(chunks.isNull() | earliest, F.lit(0)).otherwise(anywhere)
    return spread(orders, "user_id", chunk, skew, counted,
                  **{_FIRST: F.min(F.struct("create_time", "id"))})


def with_new_users(orders: DataFrame) -> DataFrame:
    """A stream's orders, and a row with ``_new`` for each user when the first order comes.

    Users stay known for good: that one has ordered is what the stream remembers.
    """
    first = orders.select("user_id").dropDuplicates(["user_id"])
    marks = first.select(*(F.col("user_id") if field.name == "user_id" else F.lit(None).cast(field.dataType).alias(field.name)
                           for field in orders.schema), F.lit(True).alias("_new"))
    return orders.withColumn("_new", F.lit(False)).unionByName(marks)


def parted_by_mark(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The orders of a batch of ``with_new_users``, and the users (user_id) who are new in it."""
    return rows.where("NOT _new").drop("_new"), rows.where("_new").select("user_id")


def flag_first(orders: Spread, state: DataFrame | None = None, fresh: DataFrame | None = None) -> Spread:
    """if_first_order: '1' for a user's earliest order if no earlier batch had one, else '0'.

    ``state`` is (user_id, if_consumed); no row or '0' means no order so far. Or
    ``fresh`` (user_id) are the users of whom no earlier batch had an order.
    """
    place = Window.partitionBy(*orders.keys).orderBy("create_time", "id")
    rows = orders.rows.withColumn("_place", F.row_number().over(place))
    earliest = F.col("_place") == 1
    if orders.hot is not None:
        earliest = earliest & (F.col(CHUNK) == 0)
    ranked = orders.on(rows)
    if state is not None:
        side = lookup_side(state, "user_id", {"_consumed": "if_consumed"},
                           rows.schema["user_id"].dataType.simpleString())
        ranked = lookup_spread(ranked, side)
        earliest = earliest & (F.col("_consumed").isNull() | (F.col("_consumed") == "0"))
    if fresh is not None:
        side = lookup_side(fresh, "user_id", {"_fresh": F.lit(True)})
        ranked = lookup_spread(ranked, side)
        earliest = earliest & F.col("_fresh").isNotNull()
    flag = F.when(earliest, F.lit("1")).otherwise(F.lit("0"))
    return orders.on(ranked.rows.withColumn("if_first_order", flag)
                     .drop("_place", "_consumed", "_fresh"))


def first_order_flag(orders: DataFrame, state: DataFrame | None = None,
                     skew: Skew = DEFAULT) -> DataFrame:
    return flag_first(spread_by_user(orders, skew), state).result()


def consumed_users(flagged: DataFrame) -> DataFrame:
    """State rows of the users who made their first order here."""
    return flagged.filter(F.col("if_first_order") == "1").select(
        F.col("user_id").cast("string").alias("user_id"), F.lit("1").alias("if_consumed"))


def with_province(orders: DataFrame, provinces: DataFrame, skew: Skew = DEFAULT,
                  counted: DataFrame | None = None) -> DataFrame:
    return lookup(orders.drop("province_name", "province_area_code"), provinces,
                  "province_id", "id",
                  {"province_name": "name", "province_area_code": "area_code"}, skew, counted)


def _user_columns(as_of: Column) -> dict[str, Column]:
    return {"user_gender": F.col("gender"),
            "user_age_group": age_group(age_years(F.col("birthday"), as_of))}


def with_user(orders: DataFrame, users: DataFrame, as_of: Column | None = None,
              skew: Skew = DEFAULT) -> DataFrame:
    """Gender and age group of the ordering user on the day ``as_of`` (default today)."""
    columns = _user_columns(F.current_date() if as_of is None else as_of)
    return lookup(orders.drop(*columns), users, "user_id", "id", columns, skew)


def enrich_orders(orders: DataFrame, provinces: DataFrame, users: DataFrame,
                  state: DataFrame | None = None, as_of: Column | None = None,
                  keep: tuple[str, ...] = (), skew: Skew = DEFAULT,
                  counted: DataFrame | None = None, fresh: DataFrame | None = None) -> DataFrame:
    """First-order flag, user and province in one go; ``keep`` columns are passed on.

    The flag's ranking, the state lookup and the user lookup share one shuffle
    by user. ``counted`` is the table behind ``orders``, if those are derived.
    """
    columns = _user_columns(F.current_date() if as_of is None else as_of)
    derived = ("if_first_order", "province_name", "province_area_code", *columns)
    per_user = flag_first(spread_by_user(orders.drop(*derived), skew, counted), state, fresh)
    side = lookup_side(users, "id", columns, orders.schema["user_id"].dataType.simpleString())
    per_user = lookup_spread(per_user, side)
    counted = orders if counted is None else counted
    return with_order_columns(with_province(per_user.result(), provinces, skew, counted), keep)


def with_sku(details: DataFrame, skus: DataFrame, skew: Skew = DEFAULT,
             counted: DataFrame | None = None) -> DataFrame:
    """Price, ids and names of the SKU; details of an unknown SKU keep what they came with.

    ``counted`` is the table behind ``details``, if those are derived.
    """
    found = {"_known": F.lit(True), "_price": F.col("price"),
             "_spu": F.col("spu_id").try_cast("bigint"),
             "_tm": F.col("tm_id").try_cast("bigint"),
             "_category3": F.col("category3_id").try_cast("bigint"),
             "_spu_name": F.col("spu_name"), "_tm_name": F.col("tm_name"),
             "_category3_name": F.col("category3_name")}
    joined = lookup(details, skus, "sku_id", "id", found, skew, counted)

    def number(new: str, old: str) -> Column:
        return F.coalesce(F.when(F.col("_known"), F.col(new)), F.col(old))

    def text(new: str, old: str) -> Column:
        return F.when(F.col("_known"), F.col(new)).otherwise(F.col(old))

    return joined.withColumns({
        "sku_price": number("_price", "sku_price"),
        "spu_id": number("_spu", "spu_id"), "tm_id": number("_tm", "tm_id"),
        "category3_id": number("_category3", "category3_id"),
        "spu_name": text("_spu_name", "spu_name"), "tm_name": text("_tm_name", "tm_name"),
        "category3_name": text("_category3_name", "category3_name")}).drop(*found)
