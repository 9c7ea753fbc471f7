"""All jobs together on folder topics."""

import json

from pyspark.sql import functions as F

from rivermart.operators import wide
from rivermart.streaming import jobs
from rivermart.streaming.pipeline import JOBS, MAXWELL_TOPIC, PACE, START_LOG_TOPIC, CANAL_TOPIC, VISITS, Site, start_job

NOW = {"availableNow": True}


def change(table, **data):
    return json.dumps({"database": "shop", "table": table, "type": "insert", "ts": 1, "data": data})


def test_every_job_has_a_pace():
    assert len(JOBS) == 15 and set(JOBS) == set(PACE)


def test_rates_are_capped_only_if_asked_for(spark, monkeypatch):
    from rivermart.streaming import pipeline
    seen = []
    monkeypatch.setattr(pipeline, "read_stream", lambda *a, **b: seen.append(b.get("max_per_trigger", a[4] if len(a) > 4 else None)))
    for site in (Site(spark, "/x", kafka="h:1"), Site(spark, "/x", kafka="h:1", partitions=100), Site(spark, "/x"),
                 Site(spark, "/x", files=7)):
        site.records(START_LOG_TOPIC, "dau", "value string")
    assert seen == [None, 100 * 3 * PACE["dau"][1], None, 7]


def test_from_change_events_to_wide_rows(spark, rows, tmp_path):
    site = Site(spark, str(tmp_path / "site"), bound="1 hour", delay="1 hour",
                as_of=F.lit("2024-01-01").cast("date"))
    sent = [0]

    def send(topic, *values):
        numbered = [(value, sent[0] + i, 1704067200 + sent[0] + i) for i, value in enumerate(values)]
        sent[0] += len(values)
        frame = spark.createDataFrame(numbered, "value string, offset bigint, s bigint")
        (frame.select("value", "offset", F.timestamp_seconds("s").alias("timestamp"))
         .coalesce(1).write.mode("append").parquet(site.topic_folder(topic)))

    def run(*names):
        for name in names:
            start_job(site, name, NOW).awaitTermination()

    site.dimension("region").put(spark.createDataFrame([("1", "north")], "id string, region_name string"), 0)
    site.dimension("trademark").put(spark.createDataFrame([("7", "brand")], "tm_id string, tm_name string"), 0)
    send(MAXWELL_TOPIC,
         change("base_category1", id=1, name="c1"), change("base_category2", id=2, name="c2", category1_id=1),
         change("base_category3", id=3, name="old", category2_id=2),
         change("base_category3", id=3, name="c3", category2_id=2),
         change("spu_info", id=4, spu_name="spu", description="d", category3_id=3, tm_id=7),
         change("user_info", id=5, name="ada", birthday="1990-01-01", gender="F"),
         change("base_province", id=6, iso_code="CN-6", name="province", area_code="106", region_id=1),
         change("sku_info", id=8, spu_id=4, price=2.5, sku_name="sku", weight=0.1, tm_id=7, category3_id=3),
         change("order_info", id=100, user_id=5, province_id=6, order_status="1", final_total_amount=9.0,
                original_total_amount=10.0, create_time="2024-01-01 10:00:00"),
         change("order_info", id=101, user_id=5, province_id=6, order_status="1", final_total_amount=1.0,
                original_total_amount=2.5, create_time="2024-01-01 11:00:00"),
         change("order_detail", id=1000, order_id=100, sku_id="8", sku_num="3", sku_name="sku"),
         '{"type":"bootstrap-start","table":"order_info","data":{}}', "broken")
    send(CANAL_TOPIC, json.dumps({"table": "t", "data": [{"id": "1"}, {"id": "2"}]}))
    send(START_LOG_TOPIC, '{"mid":"m","ts":1704067200000}', '{"mid":"m","ts":1704067300000}', '{"mid":"m"}')
    dimensions = ("category1", "category2", "category3", "spu", "user", "province", "sku")
    flow = ("maxwell_router", "order_info", "order_detail", "order_pair", "order_wide")
    run("maxwell_router", "canal_router", *dimensions, "order_info", "order_detail", "order_pair", "order_wide", "dau")

    assert rows(site.dimension("sku").read(), "id", "category1_name", "category3_name", "tm_name", "spu_name") == [
        ("8", "c1", "c3", "brand", "spu")]
    assert rows(site.dimension("province").read(), "id", "region_name") == [("6", "north")]
    canal = spark.read.parquet(site.topic_folder("canal"))
    assert rows(canal, "topic", "key") == [("ODS_T", "T1"), ("ODS_T", "T2")]
    assert rows(spark.read.parquet(f"{site.root}/tables/{VISITS}"), "dt", "mid") == [("20240101", "m")]

    def result():
        return wide.parse_wide_records(spark.read.parquet(site.topic_folder(jobs.WIDE_TOPIC)))
    columns = ("order_id", "order_detail_id", "if_first_order", "province_name", "user_age_group",
               "tm_name", "final_detail_amount")
    first = (100, 1000, "1", "province", "28-45", "brand", 6.75)
    assert rows(result(), *columns) == [first]

    # The order's last line, a repeat, and the second order's only line come later.
    send(MAXWELL_TOPIC, change("order_detail", id=1001, order_id=100, sku_id=8, sku_num=1, sku_name="sku"),
         change("order_detail", id=1000, order_id=100, sku_id=8, sku_num=3, sku_name="sku"),
         change("order_detail", id=1002, order_id=101, sku_id=8, sku_num=1, sku_name="sku"))
    run(*flow)
    assert rows(result(), *columns) == [
        first, (100, 1001, "1", "province", "28-45", "brand", 2.25),
        (101, 1002, "0", "province", "28-45", "brand", 1.0)]
