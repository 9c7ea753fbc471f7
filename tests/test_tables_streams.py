import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rivermart import schemas
from rivermart.operators import cdc, dims, orders, wide
from rivermart.sources.published import PublishedTable, pick_keys
from rivermart.sources.sinks import to_folder, to_records, write_batch
from rivermart.sources.storage import work_folder
from rivermart.sources.streams import read_stream
from rivermart.sources.tables import read_table
from rivermart.streaming import jobs, state

NOW = {"availableNow": True}


def table(spark, tmp_path, **options):
    return PublishedTable(spark, str(tmp_path / "table"), "id string, v string", **options)


def rows_in(spark, *values):
    return spark.createDataFrame(values, "id string, v string")


def folders(tmp_path, kind):
    return sorted(int(f.name.split("=")[1]) for f in (tmp_path / "table" / kind).glob("batch=*"))


def test_a_published_table_reads_the_last_row(spark, rows, tmp_path):
    users = table(spark, tmp_path)
    assert users.read().count() == 0 and users.read_keys(rows_in(spark, ("1", "a")), "id").count() == 0
    users.put(rows_in(spark, ("1", "a"), ("2", "b")), 0)
    for _ in range(2):  # the second time is a replay
        users.put(rows_in(spark, ("2", "c")), 1)
    assert rows(users.read()) == [("1", "a"), ("2", "c")]
    assert rows(users.read(before=1)) == [("1", "a"), ("2", "b")]


def test_an_unfinished_batch_does_not_count(spark, rows, tmp_path):
    users = table(spark, tmp_path)
    users.put(rows_in(spark, ("1", "a")), 0)
    users.put(rows_in(spark, ("1", "b")), 1)
    (tmp_path / "table" / "changes" / "batch=1" / "_SUCCESS").unlink()
    assert rows(users.read()) == [("1", "a")]


def test_whole_copies_keep_the_table_and_what_running_reads_need(spark, rows, tmp_path):
    users = table(spark, tmp_path, every=2)
    for batch in range(7):
        users.gather(batch)
        users.put(rows_in(spark, (str(batch % 3), f"v{batch}"), ("x", str(batch))), batch)
        newest = {str(i % 3): f"v{i}" for i in range(batch + 1)}
        assert rows(users.read()) == sorted([*newest.items(), ("x", str(batch))])
    assert folders(tmp_path, "whole") == [3, 5] and folders(tmp_path, "changes") == [4, 5, 6]
    users.gather(6)  # a repeated batch finds nothing new to gather
    assert folders(tmp_path, "whole") == [3, 5]


def scanned_rows(frame):
    """Rows that the file scans of a plan have given, once it has run."""
    leaves = frame._jdf.queryExecution().executedPlan().collectLeaves()
    metrics = [leaves.apply(i).metrics() for i in range(leaves.size())]
    return sum(m.apply("numOutputRows").value() for m in metrics if m.contains("numOutputRows"))


def test_a_read_of_few_keys_reads_few_rows(spark, rows, tmp_path):
    users = table(spark, tmp_path, every=1)
    users.put(spark.range(60_000).selectExpr("CAST(id * 7 % 60000 AS STRING) AS id", "'v' || id AS v"), 0)
    users.gather(1)
    users.put(rows_in(spark, ("5", "new")), 1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        wanted = spark.createDataFrame([(5,), (44_444,), (5,), (99_999,), (None,)], "k bigint")
        found = users.read_keys(wanted, "k")
        assert [row[0] for row in rows(found)] == ["44444", "5"] and dict(rows(found))["5"] == "new"
        picked = pick_keys(spark.read.parquet(str(tmp_path / "table" / "whole" / "batch=0")), "id", wanted, "k")
        assert len(picked.collect()) == 2 and 2 <= scanned_rows(picked) <= 4_000
        missing = pick_keys(spark.read.parquet(str(tmp_path / "table" / "whole" / "batch=0")), "id",
                            spark.createDataFrame([(f"{i}x",) for i in range(20)], "k string"), "k")
        assert missing.collect() == [] and scanned_rows(missing) == 0  # the Bloom filters know none of them
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_many_keys_are_joined(spark, rows, tmp_path):
    users = table(spark, tmp_path)
    users.put(rows_in(spark, *((str(i), "a") for i in range(50))), 0)
    facts = spark.range(10, 70).toDF("k")
    few = pick_keys(users.read(), "id", facts, "k", listed=5)
    assert "LeftSemi" in few._jdf.queryExecution().optimizedPlan().toString()
    assert few.count() == users.read_keys(facts, "k").count() == 40


def test_records_omit_nulls_and_keep_names(spark):
    frame = spark.createDataFrame([(7, None, 1.5)], "id bigint, name string, feight_fee double")
    record = to_records(frame, "T", "id").first()
    assert (record.topic, record.key, json.loads(record.value)) == ("T", "7", {"id": 7, "feight_fee": 1.5})


def test_write_batch_is_idempotent(spark, tmp_path):
    for _ in range(2):
        write_batch(spark.range(3).toDF("x"), str(tmp_path / "out"), 4)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3


def test_work_folder_is_below_the_checkpoint_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = work_folder(spark, "x"), work_folder(spark, "x")
    assert first.startswith(base) and first != second


def test_read_table_with_schema(spark, tmp_path):
    spark.range(2).write.json(str(tmp_path / "t"))
    assert read_table(spark, str(tmp_path / "t"), "json", "id bigint").count() == 2


def test_kafka_source_needs_the_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_stream(spark, "kafka", "topic", max_per_trigger=500, **{"kafka.bootstrap.servers": "x:1"})


def feed(spark, folder, values, columns):
    spark.createDataFrame(values, columns).coalesce(1).write.mode("append").parquet(folder)


def test_order_stream_flags_once_over_restarts(spark, rows, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    provinces = spark.createDataFrame([("1", "north", "10")], "id string, name string, area_code string")
    users = spark.createDataFrame([("5", "F", "1990-01-01")], "id string, gender string, birthday string")

    def run():
        job = jobs.order_info_job(read_stream(spark, "parquet", source), lambda: provinces, lambda facts, key: users,
                                  to_folder(out), str(tmp_path / "checkpoint"), F.lit("2024-01-01").cast("date"))
        jobs.start(job, NOW).awaitTermination()

    def order(key, user, time):
        return ("ODS_T_ORDER_INFO", str(key), json.dumps(
            {"id": key, "user_id": str(user), "province_id": 1, "create_time": time}))
    feed(spark, source, [order(1, 5, "2020-01-02 10:00:00"), order(2, 5, "2020-01-01 09:00:00")], schemas.RECORD)
    run()
    assert rows(state.user_state(spark, str(tmp_path / "checkpoint"))) == [("5", "1")]
    # A late older order is not the first: the user has state by now.
    feed(spark, source, [order(3, 5, "2019-01-01 00:00:00"), order(4, 6, "2020-02-01 00:00:00")], schemas.RECORD)
    run()
    run()
    found = orders.parse_order_records(spark.read.parquet(out))
    assert rows(found, "id", "if_first_order", "province_name", "user_gender", "user_age_group") == [
        (1, "0", "north", "F", "28-45"), (2, "1", "north", "F", "28-45"),
        (3, "0", "north", "F", "28-45"), (4, "1", "north", None, None)]
    assert rows(state.user_state(spark, str(tmp_path / "checkpoint"))) == [("5", "1"), ("6", "1")]


def test_dimension_stream(spark, rows, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    users = PublishedTable(spark, str(tmp_path / "users"), schemas.ddl(schemas.CATEGORY1))
    columns = f"{schemas.RECORD}, offset bigint"

    def run():
        stream = read_stream(spark, "parquet", source, columns)
        jobs.start(jobs.maintain_dimension(stream, lambda batch: dims.category1(batch, keep=("offset",)), users,
                                           ["offset"], checkpoint), NOW).awaitTermination()
        assert rows(state.dimension_state(spark, checkpoint).select("id", "name")) == rows(users.read())
    feed(spark, source, [("t", "1", '{"id":1,"name":"a"}', 1), ("t", "1", '{"id":1,"name":"b"}', 2)], columns)
    run()
    feed(spark, source, [("t", "2", '{"id":2,"name":"c"}', 3), ("t", "1", '{"id":"1","name":"d"}', 5)], columns)
    run()
    # A change that was overtaken is none.
    feed(spark, source, [("t", "1", '{"id":1,"name":"old"}', 4), ("t", "3", '{"id":3}', 6)], columns)
    run()
    assert rows(users.read()) == [("1", "d"), ("2", "c"), ("3", None)]


def test_a_dimension_stream_keeps_its_state_in_rocksdb(spark, rows, tmp_path):
    name = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        test_dimension_stream(spark, rows, tmp_path)
    finally:
        spark.conf.unset(name)


def wide_row(detail, order, num=1, price=2.5, original=10.0, final=9.0, created="2024-01-01 10:00:00"):
    known = {"order_detail_id": detail, "order_id": order, "sku_num": num, "sku_price": price, "original_total_amount": original,
             "final_total_amount": final, "create_time": created, "dt": created[:10]}
    return (json.dumps(known),)


def wide_stream(spark, tmp_path, **options):
    """Feeds batches of pairs to the wide job; gives what each has emitted, as (order, line, share)."""
    source, out = str(tmp_path / "pairs"), str(tmp_path / "out")
    seen = set()

    def run(*values):
        feed(spark, source, list(values), "value string")
        stream = wide.parse_pairs(read_stream(spark, "parquet", source, "value string"))
        jobs.start(jobs.order_wide_job(stream, to_folder(out), str(tmp_path / "checkpoint"), **options), NOW).awaitTermination()
        found = wide.parse_wide_records(spark.read.parquet(out)).collect()
        every = [(r.order_id, r.order_detail_id, r.final_detail_amount) for r in found]
        assert len(every) == len(set(row[:2] for row in every))
        new = sorted(row for row in every if row[:2] not in seen)
        seen.update(row[:2] for row in every)
        return new
    return run


def test_lines_go_out_once_and_share_the_payment_over_batches(spark, tmp_path):
    run = wide_stream(spark, tmp_path)
    assert run(wide_row(2, 1), wide_row(1, 1), wide_row(1, 1)) == [(1, 1, 2.25), (1, 2, 2.25)]
    assert run(wide_row(9, 2, num=4)) == [(2, 9, 9.0)]
    # Two batches after it went out the first line comes again; the last line gets what is left.
    assert run(wide_row(1, 1), wide_row(3, 1, num=2, final=9.0)) == [(1, 3, 4.5)]
    assert run(wide_row(4, 1), wide_row(9, 2, num=4)) == [(1, 4, 2.25)]


def test_shares_over_batches_are_those_of_one_split(spark, tmp_path):
    run = wide_stream(spark, tmp_path)
    prices = [3.33, 1.11, 2.22, 0.01, 5.0, 0.0, 4.44]
    total = round(sum(prices), 2)
    lines = [wide_row(i, 1, price=price, original=total, final=10.01) for i, price in enumerate(prices)]
    got = [row for batch in (lines[:2], lines[2:3], lines[3:]) for row in run(*batch)]
    plain = spark.createDataFrame([(1, i, 1, price, total, 10.01) for i, price in enumerate(prices)],
                                  "order_id bigint, order_detail_id bigint, sku_num bigint, sku_price double, "
                                  "original_total_amount double, final_total_amount double")
    split = wide.split_amounts(plain).select("order_id", "order_detail_id", "final_detail_amount")
    assert got == sorted(tuple(row) for row in split.collect())
    assert round(sum(row[2] for row in got), 2) == 10.01


def test_the_lines_of_an_old_order_are_forgotten(spark, tmp_path):
    run = wide_stream(spark, tmp_path, keep="1 day")
    assert run(wide_row(1, 1)) == [(1, 1, 2.25)]
    assert run(wide_row(5, 2, created="2024-01-03 10:00:00")) == [(2, 5, 2.25)]
    assert run(wide_row(6, 3, created="2024-01-03 11:00:00")) == [(3, 6, 2.25)]
    assert run(wide_row(2, 1), wide_row(1, 1)) == []  # too late: the sums have gone


def test_lines_whose_order_never_comes_are_reported(spark, rows, tmp_path):
    folders_ = {name: str(tmp_path / name) for name in ("info", "detail", "out")}

    def send(name, *values):
        frame = spark.createDataFrame(values, "id bigint, order_id bigint, s bigint")
        frame = frame.withColumn("at", F.timestamp_seconds("s")).drop("s")
        (frame.drop("order_id") if name == "info" else frame).coalesce(1).write.mode("append").parquet(folders_[name])

    def run():
        info = read_stream(spark, "parquet", folders_["info"], "id bigint, at timestamp").withColumnRenamed("at", "order_ts")
        detail = read_stream(spark, "parquet", folders_["detail"], "id bigint, order_id bigint, at timestamp")
        lines = jobs.unmatched_lines(info, detail.withColumnRenamed("at", "detail_ts"), "10 seconds", "6 seconds")
        writer = (lines.writeStream.format("parquet").option("path", folders_["out"])
                  .option("checkpointLocation", str(tmp_path / "checkpoint")))
        jobs.start(writer, NOW).awaitTermination()
        return rows(spark.read.schema("id bigint, order_id bigint").parquet(folders_["out"]))
    send("info", (1, None, 100), (2, None, 100))
    send("detail", (11, 1, 104), (12, 1, 107), (21, 2, 90), (31, 3, 100))
    assert run() == []  # an order may still come
    send("info", (9, None, 200))
    send("detail", (99, 9, 200))
    assert run() == [(12, 1), (21, 2), (31, 3)]


def test_router_writes_one_folder_per_topic(spark, rows, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    event = '{"table":"%s","type":"insert","data":{"id":%d}}'
    feed(spark, source, [(event % ("a", 1),), (event % ("b", 2),), (event % ("a", 3),)], "value string")
    stream = read_stream(spark, "parquet", source, "value string", max_per_trigger=1)
    jobs.start(jobs.route_changes(stream, out, str(tmp_path / "checkpoint")), NOW).awaitTermination()
    assert (tmp_path / "out" / "topic=ODS_T_A").is_dir()
    assert rows(cdc.select_topic(spark.read.parquet(out), "ODS_T_A"), "key") == [("1",), ("3",)]


def test_visits_stream_passes_a_hot_device_once(spark, rows, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")

    def log(mid, hour):
        at = 1704067200 + hour * 3600
        return (json.dumps({"mid": mid, "uid": f"u{hour}", "ts": str(at * 1000)}), at)

    def send(*values):
        frame = spark.createDataFrame(values, "value string, s bigint")
        frame.select("value", F.timestamp_seconds("s").alias("at")).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = read_stream(spark, "parquet", source, "value string, at timestamp")
        writer = (jobs.first_visits(stream, salts=4).writeStream.format("parquet")
                  .option("path", out).option("checkpointLocation", str(tmp_path / "checkpoint")))
        jobs.start(writer, NOW).awaitTermination()
    send(*(log("hot", hour) for hour in range(10)), log("b", 3))
    run()
    send(log("hot", 20), log("b", 21), log("hot", 30), ("broken", 1704067200))
    run()
    assert rows(spark.read.parquet(out), "dt", "mid") == [
        ("20240101", "b"), ("20240101", "hot"), ("20240102", "hot")]


def visits(spark, tmp_path, name, logs, **options):
    """The visit stream over (mid, log time, arrival) texts, a batch for each."""
    source, out = str(tmp_path / name / "in"), str(tmp_path / name / "out")
    for mid, made, at in logs:
        frame = spark.createDataFrame([(mid, made, at)], "mid string, made string, at string").select(
            F.to_json(F.struct("mid", F.unix_millis(F.to_timestamp("made")).alias("ts"))).alias("value"),
            F.to_timestamp("at").alias("at"))
        frame.write.mode("append").parquet(source)
        stream = read_stream(spark, "parquet", source, "value string, at timestamp")
        writer = (jobs.first_visits(stream, **options).writeStream.format("parquet").option("path", out)
                  .option("checkpointLocation", str(tmp_path / name / "checkpoint")))
        jobs.start(writer, NOW).awaitTermination()
    return spark.read.parquet(out)


LATE = [("m", "2024-03-01 09:00:00", "2024-03-01 09:00:05"), ("m", "2024-03-01 23:59:50", "2024-03-02 00:00:10"),
        ("m", "2024-03-02 08:00:00", "2024-03-02 08:00:01")]


def test_a_visit_counts_on_the_day_of_its_log(spark, rows, tmp_path):
    assert rows(visits(spark, tmp_path, "event", LATE), "dt", "mid") == [("20240301", "m"), ("20240302", "m")]


def test_a_visit_can_count_on_the_day_of_its_arrival(spark, rows, tmp_path):
    late = [LATE[1], LATE[0], ("m", "2024-03-02 23:59:59", "2024-03-03 00:00:01")]
    found = visits(spark, tmp_path, "processing", late, day_from="processing")
    assert rows(found, "dt") == [("20240301",), ("20240302",), ("20240303",)]
    with pytest.raises(ValueError):
        jobs.first_visits(found, day_from="other")


def test_streams_keep_state_in_rocksdb_too(spark, rows, tmp_path):
    name = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        assert rows(visits(spark, tmp_path, "rocks", LATE), "dt", "mid") == [("20240301", "m"), ("20240302", "m")]
    finally:
        spark.conf.unset(name)


def test_broadcast_limit_is_read_as_spark_reads_it(spark):
    from rivermart.operators.skew import fits_broadcast
    side = spark.range(3_000_000)  # 24 MB
    for text, fits in (("104857600", True), ("100MB", True), ("1g", True), ("20m", False), ("10485760b", False), ("-1", False)):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", text)
        try:
            assert fits_broadcast(side) == fits, text
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_stream_joins_windows_with_each_row_once_in_its_state(spark, rows, tmp_path):
    times = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11]
    info = spark.createDataFrame([(i, 20 + 4 * i) for i in range(3)], "id bigint, s bigint")
    detail = spark.createDataFrame([(100 * i + t, i, 20 + 4 * i + t - 6) for i in range(3) for t in times],
                                   "id bigint, order_id bigint, s bigint")
    info, detail = (orders_.withColumn(name, F.timestamp_seconds("s")).drop("s")
                    for orders_, name in ((info, "order_ts"), (detail, "detail_ts")))
    kinds = {"info": schemas.ORDER_INFO, "detail": schemas.ORDER_DETAIL}

    def filled(frame, kind):
        return frame.select(*frame.columns, *(F.lit(None).cast(type_).alias(name)
                                              for name, type_ in kinds[kind].items() if name not in frame.columns))
    info, detail = filled(info, "info"), filled(detail, "detail")
    for name, frame in (("info", info), ("detail", detail)):
        frame.coalesce(1).write.parquet(str(tmp_path / name))
    streams = [spark.readStream.schema(frame.schema).parquet(str(tmp_path / name)).withWatermark(time, "30 seconds")
               for name, frame, time in (("info", info, "order_ts"), ("detail", detail, "detail_ts"))]
    pairs = wide.window_pairs(*streams, salts=1).select("order_id", "order_detail_id", F.col("window.start").alias("start"))
    query = (pairs.writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start())
    query.awaitTermination()
    expected = wide.window_pairs(info, detail).select("order_id", "order_detail_id", F.col("window.start").alias("start"))
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(expected) != []
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert max(held) <= info.count() + detail.count()


def test_larger_inputs_are_handed_out_in_more_slices(spark, rows, sf_dir, monkeypatch):
    from rivermart.plans import queries, stream_queries

    whole = {name: rows(queries.queries()[name](spark, sf_dir)) for name in ("stream_wide_join", "stream_late_lines")}
    monkeypatch.setattr(stream_queries, "SLICE_ROWS", 1_500)
    monkeypatch.setattr(stream_queries, "STAGED_ROWS", 600)
    made = []
    run = stream_queries.Feed.run

    def watched(self, *starts):
        made.append((self.slices, self.spark.conf.get("spark.sql.shuffle.partitions")))
        run(self, *starts)
        assert self.spark.conf.get("spark.sql.shuffle.partitions") == str(self.spark.sparkContext.defaultParallelism)
    monkeypatch.setattr(stream_queries.Feed, "run", watched)
    for name, expected in whole.items():
        assert rows(queries.queries()[name](spark, sf_dir)) == expected
    assert made == [(4, "10")] * 2


def test_the_state_of_large_inputs_is_on_disk(spark, rows, sf_dir, monkeypatch):
    from rivermart.plans import queries, stream_queries

    whole = rows(queries.queries()["stream_order_wide"](spark, sf_dir))
    used, run = [], stream_queries.Feed.run

    def watched(self, *starts):
        run(self, *starts)
        provider = self.spark.conf.get("spark.sql.streaming.stateStore.providerClass")
        used.append((provider.rsplit(".", 1)[1], any(Path(self.folder).glob("checkpoint/pairs/state/**/*.zip"))))
    monkeypatch.setattr(stream_queries.Feed, "run", watched)
    monkeypatch.setattr(stream_queries, "SLICE_ROWS", 2_500)
    assert rows(queries.queries()["stream_order_wide"](spark, sf_dir)) == whole
    assert used == [("RocksDBStateStoreProvider", True)]
