"""Column lists of the record types.

Dimension ids are text, fact ids are bigint, money is double at the edge and
whole cents (bigint) wherever sums are compared.
"""

from __future__ import annotations

# name -> type, in the order of the published record.
CATEGORY1 = {"id": "string", "name": "string"}
CATEGORY2 = {"id": "string", "name": "string", "category1_id": "string"}
CATEGORY3 = {"id": "string", "name": "string", "category2_id": "string"}
SPU = {"id": "string", "spu_name": "string", "description": "string",
       "category3_id": "string", "tm_id": "string"}
SKU_INPUT = {"id": "string", "spu_id": "string", "price": "double", "sku_name": "string",
             "sku_desc": "string", "weight": "double", "tm_id": "string",
             "category3_id": "string", "create_time": "string"}
SKU = {"id": "string", "spu_id": "string", "price": "double", "sku_name": "string",
       "sku_desc": "string", "weight": "double", "tm_id": "string", "tm_name": "string",
       "category3_id": "string", "category2_id": "string", "category1_id": "string",
       "category3_name": "string", "category2_name": "string", "category1_name": "string",
       "spu_name": "string", "create_time": "string"}
PROVINCE_INPUT = {"id": "string", "iso_code": "string", "name": "string",
                  "area_code": "string", "region_id": "string"}
PROVINCE = {**PROVINCE_INPUT, "region_name": "string"}
USER = {name: "string" for name in (
    "id", "login_name", "nick_name", "passwd", "name", "phone_num", "email", "head_img",
    "user_level", "birthday", "gender", "create_time", "operate_time")}
ORDER_INFO = {
    "id": "bigint", "province_id": "bigint", "order_status": "string", "user_id": "bigint",
    "final_total_amount": "double", "benefit_reduce_amount": "double",
    "original_total_amount": "double", "feight_fee": "double", "expire_time": "string",
    "create_time": "string", "operate_time": "string", "create_date": "string",
    "create_hour": "string", "if_first_order": "string", "province_name": "string",
    "province_area_code": "string", "user_age_group": "string", "user_gender": "string"}
ORDER_DETAIL = {
    "id": "bigint", "order_id": "bigint", "sku_id": "bigint", "sku_price": "double",
    "sku_num": "bigint", "sku_name": "string", "spu_id": "bigint", "tm_id": "bigint",
    "category3_id": "bigint", "spu_name": "string", "tm_name": "string",
    "category3_name": "string"}
START_LOG = {"mid": "string", "uid": "string", "ar": "string", "ch": "string",
             "vc": "string", "dt": "string", "hr": "string", "mi": "string", "ts": "bigint"}
USER_STATE = {"user_id": "string", "if_consumed": "string"}
AMOUNT_STATE = {"order_id": "bigint", "origin_sum": "bigint", "fact_sum": "bigint"}

# Wide row: output column -> (side, input column).
WIDE = {
    "order_detail_id": ("detail", "id"), "order_id": ("info", "id"),
    "order_status": ("info", "order_status"), "create_time": ("info", "create_time"),
    "user_id": ("info", "user_id"), "sku_id": ("detail", "sku_id"),
    "sku_price": ("detail", "sku_price"), "sku_num": ("detail", "sku_num"),
    "sku_name": ("detail", "sku_name"),
    "benefit_reduce_amount": ("info", "benefit_reduce_amount"),
    "original_total_amount": ("info", "original_total_amount"),
    "feight_fee": ("info", "feight_fee"),
    "final_total_amount": ("info", "final_total_amount"),
    "final_detail_amount": None,
    "if_first_order": ("info", "if_first_order"), "province_name": ("info", "province_name"),
    "province_area_code": ("info", "province_area_code"),
    "user_age_group": ("info", "user_age_group"), "user_gender": ("info", "user_gender"),
    "dt": ("info", "create_date"), "spu_id": ("detail", "spu_id"),
    "tm_id": ("detail", "tm_id"), "category3_id": ("detail", "category3_id"),
    "spu_name": ("detail", "spu_name"), "tm_name": ("detail", "tm_name"),
    "category3_name": ("detail", "category3_name")}

# A record on a topic.
RECORD = "topic string, key string, value string"


def ddl(columns: dict[str, str]) -> str:
    """The columns as a Spark schema string."""
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())
