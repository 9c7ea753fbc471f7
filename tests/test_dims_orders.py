import pytest
from pyspark.sql import functions as F

from rivermart import schemas
from rivermart.operators import dims, orders
from rivermart.operators.keyed import upsert_latest
from rivermart.operators.lookup import keyed_scan, lookup
from rivermart.operators.skew import Skew

EVERY_PATH = [Skew(), Skew(broadcast_limit=-1), Skew(hot_rows=1, small_input=0, broadcast_limit=-1)]


@pytest.fixture(params=EVERY_PATH, ids=["broadcast", "shuffle", "hot"])
def skew(request):
    return request.param


def test_sku_category_chain(spark, skew):
    sku = spark.createDataFrame([(
        '{"id":3001,"sku_name":"oak desk","price":119.5,"weight":31.25,"spu_id":88,"tm_id":21,"colour":"brown",'
        '"create_time":"2023-11-05 06:07:08","category3_id":%s}' % c3,) for c3 in (901, 902, 903, 904)], "value string")
    trademarks = spark.createDataFrame([("21", "woodworks")], "tm_id string, tm_name string")
    c3 = spark.createDataFrame([("901", "desks", "40"), ("902", "lamps", "41"), ("903", "shelves", "42")],
                               schemas.ddl(schemas.CATEGORY3))
    c2 = spark.createDataFrame([("40", "office", "5"), ("42", "storage", "8")], schemas.ddl(schemas.CATEGORY2))
    c1 = spark.createDataFrame([("5", "furniture")], schemas.ddl(schemas.CATEGORY1))
    spus = spark.createDataFrame([("99", "other")], "id string, spu_name string")
    flat = dims.flatten_sku(dims.sku(sku), trademarks, c3, c2, c1, spus, skew)
    assert flat.columns == list(schemas.SKU)
    found = {row.category3_id: row for row in flat.collect()}
    names = {key: (r.category3_name, r.category2_id, r.category2_name, r.category1_id, r.category1_name)
             for key, r in found.items()}
    assert names == {"901": ("desks", "40", "office", "5", "furniture"), "902": ("lamps", "41", None, None, None),
                     "903": ("shelves", "42", "storage", "8", None), "904": (None, None, None, None, None)}
    row = found["901"]
    assert (row.id, row.price, row.weight, row.tm_name, row.spu_name) == ("3001", 119.5, 31.25, "woodworks", None)


def test_category_samples(spark):
    records = spark.createDataFrame([('{"id":7,"name":"x","category1_id":2}',)], "value string")
    assert tuple(dims.category2(records).first()) == ("7", "x", "2")


def test_region_lookup_keeps_every_province(spark, rows, skew):
    provinces = spark.createDataFrame([("1", "i", "p", "10", "1"), ("2", "i", "q", "11", "9")],
                                      schemas.ddl(schemas.PROVINCE_INPUT))
    regions = spark.createDataFrame([("1", "north")], "id string, region_name string")
    assert rows(dims.with_region(provinces, regions, skew), "id", "region_name") == [
        ("1", "north"), ("2", None)]


def test_lookup_null_and_hot_keys(spark, rows, skew):
    facts = spark.createDataFrame([(i, None if i % 3 == 0 else 1 if i % 3 == 1 else i) for i in range(60)],
                                  "n bigint, k bigint")
    dim = spark.createDataFrame([(str(i), f"v{i}") for i in range(50)], "id string, v string")
    expected = sorted((n, None if n % 3 == 0 else "v1" if n % 3 == 1 else f"v{n}" if n < 50 else None)
                      for n in range(60))
    got = sorted(tuple(r) for r in lookup(facts, dim, "k", "id", {"v": "v"}, skew).select("n", "v").collect())
    assert got == expected


def test_duplicate_dimension_keys_are_reduced_by_upsert(spark, rows):
    dim = spark.createDataFrame([("1", "old", 1), ("1", "new", 2)], "id string, v string, at int")
    facts = spark.createDataFrame([(1,), (1,)], "k bigint")
    unique = upsert_latest(None, dim, ["id"], ["at"])
    assert rows(lookup(facts, unique, "k", "id", {"v": "v"})) == [(1, "new"), (1, "new")]


def test_upsert_latest(spark, rows):
    current = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, v string")
    changes = spark.createDataFrame([("2", "c", 1), ("2", "d", 2), ("3", "e", 1)], "id string, v string, at int")
    assert rows(upsert_latest(current, changes, ["id"], ["at"]), "id", "v") == [
        ("1", "a"), ("2", "d"), ("3", "e")]


def test_keyed_scan(spark, rows, skew):
    dim = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, v string")
    facts = spark.createDataFrame([(2,), (2,), (5,)], "k bigint")
    assert rows(keyed_scan(dim, "id", facts, "k", skew)) == [("2", "b")]


ORDERS = [(1, 10, "2020-01-02 00:00:00"), (2, 10, "2020-01-01 00:00:00"), (3, 10, "2020-01-01 00:00:00"),
          (4, 11, "2020-01-05 00:00:00"), (5, 12, "2020-01-06 00:00:00"), (6, None, "2020-01-06 00:00:00"),
          (4, 11, "2020-01-05 00:00:00")]


def test_first_order_is_one_per_user(spark, rows, skew):
    frame = spark.createDataFrame(ORDERS, "id bigint, user_id bigint, create_time string")
    flagged = orders.first_order_flag(frame, skew=skew)
    assert rows(flagged.filter("if_first_order = '1'"), "id", "user_id") == [
        (2, 10), (4, 11), (5, 12), (6, None)]
    assert flagged.count() == len(ORDERS)


def test_first_order_with_state(spark, rows, skew):
    frame = spark.createDataFrame(ORDERS, "id bigint, user_id bigint, create_time string")
    state = spark.createDataFrame([("10", "1"), ("11", "0")], "user_id string, if_consumed string")
    flagged = orders.first_order_flag(frame, state, skew)
    assert rows(flagged.filter("if_first_order = '1'"), "id") == [(4,), (5,), (6,)]
    assert rows(orders.consumed_users(flagged.filter("user_id is not null"))) == [("11", "1"), ("12", "1")]


def test_late_older_order_is_not_first(spark, rows):
    late = spark.createDataFrame([(9, 10, "2019-01-01 00:00:00")], "id bigint, user_id bigint, create_time string")
    state = spark.createDataFrame([("10", "1")], "user_id string, if_consumed string")
    assert rows(orders.first_order_flag(late, state), "if_first_order") == [("0",)]


def test_user_attributes(spark, rows, skew):
    frame = spark.createDataFrame([(1, 10), (2, 11), (3, 12)], "id bigint, user_id bigint")
    users = spark.createDataFrame([("10", "F", "1990-01-01"), ("11", "M", None)],
                                  "id string, gender string, birthday string")
    as_of = F.lit("2024-01-01").cast("date")
    assert rows(orders.with_user(frame, users, as_of, skew), "id", "user_gender", "user_age_group") == [
        (1, "F", "28-45"), (2, "M", None), (3, None, None)]


def test_sku_overrides_only_when_found(spark, rows, skew):
    details = spark.createDataFrame(
        [(1, 1, 5, 9.0, 1, "n", 0, 0, 0, None, None, None), (2, 1, 6, 9.0, 1, "n", 3, 0, 0, "kept", None, None)],
        schemas.ddl(schemas.ORDER_DETAIL))
    skus = spark.createDataFrame([("5", "50", 1.5, "7", "61", "s", "t", "c")],
                                 "id string, spu_id string, price double, tm_id string, "
                                 "category3_id string, spu_name string, tm_name string, category3_name string")
    assert rows(orders.with_sku(details, skus, skew)) == [
        (1, 1, 5, 1.5, 1, "n", 50, 7, 61, "s", "t", "c"), (2, 1, 6, 9.0, 1, "n", 3, 0, 0, "kept", None, None)]
