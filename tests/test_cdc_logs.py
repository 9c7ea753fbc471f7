import json

from pyspark.sql import functions as F

from rivermart.operators import cdc, logs

MAXWELL = ('{"database":"depot","table":"crate","type":"%s","ts":1700000007,"commit":true,"data":{"id":905,'
           '"label":"oak box","sealed":true,"gross":12.50,"limit":123456789012345.678,"stack":{"row":2,"note":null},'
           '"lost":null}}')
CANAL = ('{"data":[{"id":"71","label":"tin","gross":"3.10"},{"id":"72","label":"zinc","slots":[1,2]}],'
         '"database":"depot","id":9,"isDdl":false,"table":"crate","ts":1700000008123,"type":"UPDATE"}')


def texts(spark, *values):
    return spark.createDataFrame([(value,) for value in values], "value string")


def test_maxwell_sample(spark):
    record = cdc.maxwell_records(texts(spark, MAXWELL % "insert")).first()
    assert (record.topic, record.key) == ("ODS_T_CRATE", "905")
    assert json.loads(record.value) == {
        "id": 905, "label": "oak box", "sealed": True, "gross": 12.5, "limit": 123456789012345.678,
        "stack": {"row": 2, "note": None}}
    assert '"limit":123456789012345.678' in record.value  # all eighteen digits


def test_payloads_that_are_no_objects_give_no_record(spark):
    raw = texts(spark, '{"table":"t","data":[1]}', '{"table":"t","data":3}', '{"table":"t","data":null}', '{"table":"t"}',
                '{"data":{"id":1}}', "broken", None)
    assert cdc.maxwell_records(raw).count() == 0
    assert cdc.canal_records(texts(spark, '{"table":"t","data":[3,null]}', '{"table":"t","data":{}}')).count() == 0


def test_each_text_is_parsed_once(spark):
    for records in (cdc.maxwell_records(texts(spark, MAXWELL % "insert")), cdc.canal_records(texts(spark, CANAL)),
                    logs.valid_logs(texts(spark, "{}"))):
        assert records._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_maxwell_drops_only_snapshot_marks(spark):
    kinds = ["insert", "update", "delete", "bootstrap-start", "bootstrap-insert", "bootstrap-complete"]
    raw = texts(spark, *(MAXWELL % kind for kind in kinds),
                (MAXWELL % "insert").replace('"type":"insert",', ""))
    kept = cdc.drop_snapshot_marks(cdc.parse_maxwell(raw)).select("type").collect()
    assert {row[0] for row in kept} == {"insert", "update", "delete", "bootstrap-insert", None}
    assert cdc.maxwell_records(raw).count() == 5


def test_canal_sample(spark):
    records = cdc.canal_records(texts(spark, CANAL)).orderBy("key").collect()
    assert [(r.topic, r.key) for r in records] == [
        ("ODS_CRATE", "CRATE71"), ("ODS_CRATE", "CRATE72")]
    assert json.loads(records[0].value) == {"id": "71", "label": "tin", "gross": "3.10"}
    assert json.loads(records[1].value)["slots"] == [1, 2]


def test_canal_schema_change_gives_no_rows(spark):
    raw = texts(spark, '{"data":null,"isDdl":true,"table":"t","type":"ALTER"}', "broken")
    assert cdc.canal_records(raw).count() == 0


def test_prefix_and_topic_selection(spark):
    records = cdc.maxwell_records(texts(spark, MAXWELL % "insert"), prefix="P_")
    assert cdc.select_topic(records, "P_CRATE").count() == 1
    assert cdc.select_topic(records, "P_OTHER").count() == 0


def test_log_validity(spark):
    good = ['{"mid":"m","ts":"1"}', '{"mid":null,"ts":null}']
    bad = ["x", "", "null", "[1]", "123", '{"mid":"m"}', '{"ts":1}', '{"mid":"m","ts":', None]
    assert logs.valid_logs(texts(spark, *good)).count() == 2
    assert logs.valid_logs(texts(spark, *bad)).count() == 0


def test_log_defaults(spark):
    raw = texts(spark, '{"mid":"pad-3","uid":"guest","ar":"coast","ch":"store","vc":"7.0","ts":"11"}',
                '{"mid":"m","uid":null,"ts":3660000}')
    found = logs.start_logs(raw).orderBy("ts").collect()
    assert tuple(found[0]) == ("pad-3", "guest", "coast", "store", "7.0", "19700101", "00", "00", 11)
    assert tuple(found[1]) == ("m", "", "", "", "", "19700101", "01", "01", 3660000)


def test_first_visits(spark, rows):
    typed = spark.createDataFrame(
        [("a", "d1", 5), ("a", "d1", 3), ("a", "d2", 9), ("b", "d1", 1), (None, "d1", 2), (None, "d1", 4)],
        "mid string, dt string, ts bigint")
    first = logs.first_visits(typed)
    assert rows(first, "dt", "mid", "ts") == [
        ("d1", "a", 3), ("d1", "b", 1), ("d1", None, 2), ("d2", "a", 9)]
    seen = spark.createDataFrame([("d1", "a"), ("d1", None)], "dt string, mid string")
    assert rows(logs.first_visits(typed, seen), "dt", "mid") == [("d1", "b"), ("d2", "a")]


def test_processing_day(spark):
    typed = spark.createDataFrame([("a", "d1", 5), ("a", "d2", 3)], "mid string, dt string, ts bigint")
    found = logs.first_visits(typed, day_from="processing")
    today = spark.range(1).select(F.date_format(F.current_date(), "yyyyMMdd")).first()[0]
    assert [(r.mid, r.dt, r.ts) for r in found.collect()] == [("a", today, 3)]


def test_first_visit_is_reduced_before_the_shuffle(spark):
    typed = spark.createDataFrame([("a", "d1", 5)], "mid string, dt string, ts bigint")
    plan = logs.first_visits(typed)._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in before
