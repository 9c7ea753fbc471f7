"""One query per operator, on the derived inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rivermart import schemas
from rivermart.functions import age_years, json_fields
from rivermart.operators import cdc, dims, logs, orders, wide
from rivermart.operators.keyed import upsert_latest
from rivermart.operators.lookup import keyed_scan
from rivermart.operators.skew import Skew
from rivermart.plans import testbed
from rivermart.plans.stream_queries import STREAM_QUERIES
from rivermart.plans.testbed import Testbed, as_json
from rivermart.sources.bucketed import save_bucketed
from rivermart.sources.sinks import to_records
from rivermart.sources.storage import work_folder

Query = Callable[[SparkSession, str], DataFrame]


def as_of():
    """The fixed day on which the queries count ages."""
    return F.lit("2024-01-01").cast("date")


# ---------------------------------------------------------------- change capture

def cdc_maxwell_filter(bed: Testbed) -> DataFrame:
    events = cdc.drop_snapshot_marks(cdc.parse_maxwell(bed.maxwell()))
    return events.select(cdc.field_text(F.col("data"), "id").alias("id"), "table", "type")


def _routed_fields(records: DataFrame, **fields: str) -> DataFrame:
    """The records' fields, and whether the id is a number in the payload's JSON."""
    found = json_fields(F.col("value"))
    numeric = F.regexp_like("value", F.lit(r'"id":-?\d')).alias("id_is_number")
    rows = records.select("topic", "key", found.alias("_fields"), numeric)
    return rows.select("topic", "key", "id_is_number", *(
        F.col("_fields")[name].cast(kind).alias(name) for name, kind in fields.items()))


def cdc_maxwell_route(bed: Testbed) -> DataFrame:
    return _routed_fields(cdc.maxwell_records(bed.maxwell()), id="bigint", user_id="string",
                          name="string", final_total_amount="double")


def cdc_canal_route(bed: Testbed) -> DataFrame:
    return _routed_fields(cdc.canal_records(bed.canal()), id="bigint", order_id="bigint",
                          sku_id="bigint", sku_num="bigint")


def cdc_select_table(bed: Testbed) -> DataFrame:
    records = cdc.select_topic(cdc.maxwell_records(bed.maxwell()), "ODS_T_USER_INFO")
    return _routed_fields(records, id="bigint", name="string")


# ---------------------------------------------------------------- start logs

def log_valid_filter(bed: Testbed) -> DataFrame:
    return logs.valid_logs(bed.logs()).select("event_id")


def log_project_defaults(bed: Testbed) -> DataFrame:
    return logs.start_logs(bed.logs())


def dau_first_visit(bed: Testbed) -> DataFrame:
    typed = logs.start_logs(bed.logs(), keep=("event_id",))
    return logs.first_visits(typed, order=("ts", "event_id")).drop("event_id")


def dau_first_visit_incremental(bed: Testbed) -> DataFrame:
    """Two batches, morning and afternoon; the second knows the visits of the first."""
    typed = logs.start_logs(bed.logs(), keep=("event_id",))
    order = ("ts", "event_id")
    morning = logs.first_visits(typed.filter(F.col("hr") < "12"), order=order)
    later = logs.first_visits(typed.filter(F.col("hr") >= "12"), morning, order)
    both = morning.withColumn("batch", F.lit(1)).unionByName(later.withColumn("batch", F.lit(2)))
    return both.drop("event_id")


# ---------------------------------------------------------------- dimensions

def _category(level: int, project: Callable[..., DataFrame]) -> Callable[[Testbed], DataFrame]:
    def query(bed: Testbed) -> DataFrame:
        changes = project(bed.category_feed(level), keep=("offset",))
        return upsert_latest(None, changes, ["id"], ["offset"]).drop("offset")
    return query


def dim_spu(bed: Testbed) -> DataFrame:
    changes = dims.spu(bed.spu_feed(), keep=("offset",))
    return upsert_latest(None, changes, ["id"], ["offset"]).drop("offset")


def dim_user(bed: Testbed) -> DataFrame:
    return dims.user(as_json(bed.all_users()))


def dim_upsert_latest(bed: Testbed) -> DataFrame:
    current = bed.all_users().select("id", "user_level")
    return (upsert_latest(current, bed.level_changes(), ["id"], ["changed", "offset"])
            .select("id", "user_level", F.col("offset").cast("string").alias("version")))


def keyed_dim_scan(bed: Testbed) -> DataFrame:
    return keyed_scan(bed.users().select("id", "name"), "id", bed.table("orders"), "o_custkey")


def dim_province_region(bed: Testbed) -> DataFrame:
    return dims.with_region(dims.province(as_json(bed.provinces())), bed.regions()).select(
        *schemas.PROVINCE)


def dim_sku_flatten(bed: Testbed) -> DataFrame:
    return dims.flatten_sku(dims.sku(as_json(bed.skus())), bed.trademarks(), bed.categories(3),
                            bed.categories(2), bed.categories(1), bed.spus())


# ---------------------------------------------------------------- orders

def order_info_parse(bed: Testbed) -> DataFrame:
    return orders.order_info(bed.order_records())


def order_detail_parse(bed: Testbed) -> DataFrame:
    return orders.order_detail(bed.detail_records())


def order_time_parts(bed: Testbed) -> DataFrame:
    return orders.with_time_parts(bed.order_times()).select("id", "create_date", "create_hour")


def _plain_orders(bed: Testbed) -> DataFrame:
    return bed.order_info(totals=False)


def order_first_flag(bed: Testbed) -> DataFrame:
    return orders.first_order_flag(_plain_orders(bed)).select("id", "user_id", "if_first_order")


def _two_order_batches(bed: Testbed) -> tuple[DataFrame, DataFrame]:
    every = _plain_orders(bed).select("id", "user_id", "create_time")
    early = F.col("create_time") < testbed.FIRST_BATCH_UNTIL
    first = orders.first_order_flag(every.filter(early))
    second = orders.first_order_flag(every.filter(~early), orders.consumed_users(first))
    return first, second


def order_first_flag_incremental(bed: Testbed) -> DataFrame:
    first, second = _two_order_batches(bed)
    both = first.withColumn("batch", F.lit(1)).unionByName(second.withColumn("batch", F.lit(2)))
    return both.select("batch", "id", "user_id", "if_first_order")


def user_state_upsert(bed: Testbed) -> DataFrame:
    first, second = (orders.consumed_users(rows) for rows in _two_order_batches(bed))
    return upsert_latest(first.withColumn("batch", F.lit(1)), second.withColumn("batch", F.lit(2)),
                         ["user_id"], ["batch"])


def order_province_enrich(bed: Testbed) -> DataFrame:
    return orders.with_province(_plain_orders(bed), bed.provinces()).select(
        "id", "province_name", "province_area_code")


def user_age(bed: Testbed) -> DataFrame:
    return bed.all_users().select("id", age_years(F.col("birthday"), as_of()).alias("age"))


def order_user_enrich(bed: Testbed) -> DataFrame:
    return orders.with_user(_plain_orders(bed), bed.users(), as_of()).select(
        "id", "user_gender", "user_age_group")


def _bucketed_users(bed: Testbed) -> DataFrame:
    folder = work_folder(bed.spark, "users")
    buckets = bed.spark.sparkContext.defaultParallelism
    return save_bucketed(bed.users().select("id", "gender", "birthday"), f"users_{folder[-32:]}", "id", "bigint", buckets, folder)


def order_user_bucketed(bed: Testbed) -> DataFrame:
    """Users as if they were too many to broadcast: bucketed once, then only orders are shuffled."""
    return orders.with_user(_plain_orders(bed), _bucketed_users(bed), as_of(), Skew(broadcast_limit=-1)).select(
        "id", "user_gender", "user_age_group")


def detail_sku_enrich(bed: Testbed) -> DataFrame:
    return orders.with_sku(bed.order_detail(), bed.flat_skus(complete=False))


# ---------------------------------------------------------------- wide rows

def _arrivals(bed: Testbed) -> tuple[DataFrame, DataFrame]:
    info = orders.with_time_parts(bed.order_info())
    detail = bed.priced_detail("l_linenumber")
    return (bed.at(info, "id", "order_ts"),
            bed.at(detail, "order_id", "detail_ts", "l_linenumber").drop("l_linenumber"))


def wide_window_join_raw(bed: Testbed) -> DataFrame:
    return wide.window_pairs(*_arrivals(bed)).select(
        "order_id", "order_detail_id", F.col("window.start").cast("string").alias("window_start"))


def wide_join(bed: Testbed) -> DataFrame:
    return wide.emit_once(wide.window_pairs(*_arrivals(bed))).select(*schemas.WIDE)


def wide_dedup(bed: Testbed) -> DataFrame:
    """Details under ids that repeat, as after a redelivery."""
    detail = bed.priced_detail("l_linenumber")
    detail = detail.withColumn("id", F.col("order_id") * 10 + F.col("l_linenumber"))
    info = orders.with_time_parts(bed.order_info())
    return wide.emit_once(wide.wide_join(info, detail.drop("l_linenumber")))


SPLIT = ("order_id", "order_detail_id", "sku_num", "sku_price", "final_detail_amount")
# Ids may repeat in the raw lines, so the order needs a second column.
LINE_ORDER = ("order_detail_id", "sku_num")


def _positions(detail: DataFrame) -> DataFrame:
    return detail.select("order_id", F.col("id").alias("order_detail_id"))


def amount_split(bed: Testbed) -> DataFrame:
    raw = bed.order_detail()
    lines = wide.wide_join(bed.order_info(), bed.priced_detail(), counted=raw)
    return wide.split_amounts(lines, order_by=LINE_ORDER, counted=_positions(raw)).select(*SPLIT)


def amount_split_incremental(bed: Testbed) -> DataFrame:
    """Two batches by line number; the second starts from the sums of the first."""
    info = orders.with_time_parts(bed.order_info())
    detail = bed.priced_detail("l_linenumber")
    early = F.col("l_linenumber") <= testbed.FIRST_BATCH_LINES

    def split(part: Column, prior: DataFrame | None) -> DataFrame:
        raw = bed.order_detail("l_linenumber").filter(part)
        lines = wide.wide_join(info, detail.filter(part), counted=raw)
        return wide.split_amounts(lines, prior, LINE_ORDER, counted=_positions(raw))
    first = split(early, None)
    second = split(~early, wide.amount_state(first))
    both = first.withColumn("batch", F.lit(1)).unionByName(second.withColumn("batch", F.lit(2)))
    return both.select("batch", *SPLIT)


def sink_json_records(bed: Testbed) -> DataFrame:
    """Enriched orders as records, and their fields read back."""
    done = orders.with_province(orders.with_time_parts(bed.order_info()), bed.provinces())
    records = to_records(orders.with_order_columns(done), "DWD_ORDER_INFO", "id")
    return orders.parse_order_records(records, "topic", "key")


def dws_order_wide(bed: Testbed) -> DataFrame:
    """The chain from typed orders and details to wide rows with their share of the payment."""
    source = bed.order_info()
    once = orders.with_time_parts(orders.unique_orders(source))
    info = orders.enrich_orders(once, bed.provinces(), bed.users(), as_of=as_of(),
                                counted=_plain_orders(bed))
    return wide.order_wide(info, bed.order_detail(), bed.flat_skus(), amounts=source)


BATCH_QUERIES: dict[str, Callable[[Testbed], DataFrame]] = {
    "cdc_maxwell_filter": cdc_maxwell_filter,
    "cdc_maxwell_route": cdc_maxwell_route,
    "cdc_canal_route": cdc_canal_route,
    "cdc_select_table": cdc_select_table,
    "log_valid_filter": log_valid_filter,
    "log_project_defaults": log_project_defaults,
    "dau_first_visit": dau_first_visit,
    "dau_first_visit_incremental": dau_first_visit_incremental,
    "dim_category1": _category(1, dims.category1),
    "dim_category2": _category(2, dims.category2),
    "dim_category3": _category(3, dims.category3),
    "dim_spu": dim_spu,
    "dim_user": dim_user,
    "dim_upsert_latest": dim_upsert_latest,
    "keyed_dim_scan": keyed_dim_scan,
    "dim_province_region": dim_province_region,
    "dim_sku_flatten": dim_sku_flatten,
    "order_info_parse": order_info_parse,
    "order_detail_parse": order_detail_parse,
    "order_time_parts": order_time_parts,
    "order_first_flag": order_first_flag,
    "order_first_flag_incremental": order_first_flag_incremental,
    "user_state_upsert": user_state_upsert,
    "order_province_enrich": order_province_enrich,
    "user_age": user_age,
    "order_user_enrich": order_user_enrich,
    "order_user_bucketed": order_user_bucketed,
    "detail_sku_enrich": detail_sku_enrich,
    "wide_window_join_raw": wide_window_join_raw,
    "wide_join": wide_join,
    "wide_dedup": wide_dedup,
    "amount_split": amount_split,
    "amount_split_incremental": amount_split_incremental,
    "sink_json_records": sink_json_records,
    "dws_order_wide": dws_order_wide,
}


def queries() -> dict[str, Query]:
    def bound(query: Callable[[Testbed], DataFrame]) -> Query:
        return lambda spark, sf_dir: query(Testbed(spark, sf_dir))
    return {name: bound(query) for name, query in {**BATCH_QUERIES, **STREAM_QUERIES}.items()}
