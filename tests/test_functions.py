import datetime
import re

import pytest
from pyspark.sql import functions as F

from rivermart import schemas
from rivermart.functions import (
    age_group, age_years, cents, date_part, hour_part, parse_records)
from rivermart.functions.money import proportion


def one(spark, column, **values):
    frame = spark.range(1).select(*(F.lit(value).alias(name) for name, value in values.items()))
    return frame.select(column).first()[0]


@pytest.mark.parametrize("text, day, hour", [
    ("2020-11-07 03:41:31", "2020-11-07", "03"), ("2020-11-07", None, None), (None, None, None),
    ("2020-11-07 ", "2020-11-07", "")])
def test_time_parts(spark, text, day, hour):
    frame = spark.createDataFrame([(text,)], "t string")
    assert tuple(frame.select(date_part(F.col("t")), hour_part(F.col("t"))).first()) == (day, hour)


@pytest.mark.parametrize("birthday, age", [
    ("2006-01-06", 17), ("2006-01-05", 18), ("1994-01-01", 30), ("not a date", None), (None, None)])
def test_age_counts_years_of_365_days(spark, birthday, age):
    as_of = F.lit("2024-01-01").cast("date")
    frame = spark.createDataFrame([(birthday,)], "b string")
    assert frame.select(age_years(F.col("b"), as_of)).first()[0] == age
    born = datetime.date(2024, 1, 1)
    if age is not None:
        assert (born - datetime.date.fromisoformat(birthday)).days // 365 == age


@pytest.mark.parametrize("age, label", [
    (17, "小于18"), (18, "18-28"), (27, "18-28"), (28, "28-45"), (45, "45-60"), (59, "45-60"),
    (60, "60以上"), (None, None)])
def test_age_groups_include_their_lower_bound(spark, age, label):
    frame = spark.createDataFrame([(age,)], "a bigint")
    assert frame.select(age_group(F.col("a"))).first()[0] == label


def test_cents_round(spark):
    assert one(spark, cents(F.col("x")), x=900.1) == 90010
    assert one(spark, cents(F.col("x")), x=0.29) == 29


@pytest.mark.parametrize("part, whole, of, share", [
    (100, 300, 200, 66), (5, 0, 7, None), (10 ** 15, 3 * 10 ** 15, 10 ** 16, 10 ** 16 // 3),
    (-100, 300, 200, -66)])
def test_proportion_is_exact_at_any_size(spark, part, whole, of, share):
    frame = spark.createDataFrame([(part, whole, of)], "p bigint, w bigint, o bigint")
    assert frame.select(proportion(F.col("p"), F.col("w"), F.col("o"))).first()[0] == share


def test_lenient_binding(spark):
    records = spark.createDataFrame([
        ('{"sku_num":"4","create_time":"2023-02-14 06:30:00","note":["gift"],"sku_id":61,'
         '"sku_name":"lamp","list_price":20.25,"id":510,"order_id":88}',),
        ("bad",), ("",), ("null",), ("[1]",), ("123",), (None,)], "value string")
    found = parse_records(records, schemas.ORDER_DETAIL).collect()
    assert [tuple(row) for row in found] == [
        (510, 88, 61, 0.0, 4, "lamp", 0, 0, 0, None, None, None)]


def test_number_reads_as_text_and_bad_number_is_null(spark):
    records = spark.createDataFrame(
        [('{"id":7,"name":"north","area_code":"10","iso_code":"CN-11","region_id":1}',)], "value string")
    assert tuple(parse_records(records, schemas.PROVINCE_INPUT).first()) == (
        "7", "CN-11", "north", "10", "1")
    broken = spark.createDataFrame([('{"id":"x","price":"y"}',)], "value string")
    row = parse_records(broken, {"id": "bigint", "price": "double"}).first()
    assert tuple(row) == (None, None)


def test_parsers_of_records_generate_short_methods(spark, capsys):
    """Lookups of fields in the map are not generated code, of which there were up to 6445 bytes."""
    from rivermart.operators import wide

    values = [('{"order_id":"7","sku_name":5,"x":1}',), ("[1]",), ("{",), (None,), ("{}",)]
    records = spark.createDataFrame(values, "value string")
    parsed = wide.parse_wide_records(records)
    assert [(r.order_id, r.sku_name, r.user_id) for r in parsed.collect()] == [(7, "5", 0), (0, None, 0)]
    for frame in (parsed, parse_records(records, schemas.ORDER_INFO)):
        frame.explain("codegen")
        sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
        assert sizes and max(sizes) < 3000


def test_records_as_written_read_as_others_do(spark, monkeypatch):
    """Texts that to_records writes are read by their types; any other text is bound leniently."""
    from rivermart.functions import records

    columns = {"id": "bigint", "price": "double", "name": "string"}
    values = ['{"id":7,"price":0.30000000000000004,"name":"a \\"b\\""}', '{"price":"NaN","x":{"id":1}}', "{}", '{"id":null}',
              '{"id":"7","price":"1e2","name":5}', '{"id":1.0}', '{"id":"","price":true}', '{"name":{"a":[1]}}', '{"_unreadable":"q"}',
              '{"id":9223372036854775808,"name":"n"}', "[1]", '[{"id":1}]', ' {"id":3}', '{"id":1,', "", "null", "7", None]
    frame = spark.createDataFrame(list(enumerate(values)), "at int, value string")
    lenient, written = ([str(r) for r in parse_records(frame, columns, keep=("at",), written=w).orderBy("at").collect()]
                        for w in (False, True))
    assert written == lenient and len(lenient) == 11
    monkeypatch.setattr(records, "json_fields", lambda text: F.lit(None).cast("map<string,string>"))
    by_type = [r.at for r in parse_records(frame, columns, keep=("at",), written=True).orderBy("at").collect()]
    assert by_type == [0, 1, 2, 3, 7, 8]
