"""Streaming forms of the queries: the same rows, fed slice by slice.

Every slice is written as new files and the jobs are started again on their
checkpoints, so each query also stops and resumes between slices.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rivermart import schemas
from rivermart.functions import json_fields
from rivermart.operators import dims, orders, wide
from rivermart.operators.lookup import keyed_scan
from rivermart.plans.testbed import Testbed, as_json
from rivermart.sources.published import PublishedTable
from rivermart.sources.sinks import to_folder
from rivermart.sources.storage import work_folder
from rivermart.sources.streams import read_stream
from rivermart.streaming import jobs, state

# At least so many slices, and more if a slice would have more rows: what a batch brings is state at first.
SLICES = 2
SLICE_ROWS = 3_000_000
# Rows of the largest input per task while inputs are staged, where rows are sorted.
STAGED_ROWS = 500_000
AVAILABLE = {"availableNow": True}
# A job is started again for each slice and reads its state then. In the default store, on the heap, every start
# leaves behind what it has read, and reads all changes so far; with large inputs RocksDB has the state on disk.
_ROCKS = "spark.sql.streaming.stateStore.rocksdb"
LARGE_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_ROCKS}.trackTotalNumberOfRows": "false", f"{_ROCKS}.boundedMemoryUsage": "true", f"{_ROCKS}.maxMemoryUsageMB": "400"}


class Feed:
    """One run: its folder, and inputs that are handed out slice by slice.

    ``idle`` lets batches without input run, which give what only time brings about.
    """

    def __init__(self, bed: Testbed, name: str, idle: bool = False):
        self.spark = bed.spark.newSession()
        self._partition(self.spark.sparkContext.defaultParallelism)
        self.spark.conf.set("spark.sql.session.timeZone", bed.spark.conf.get("spark.sql.session.timeZone"))
        self.spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", str(idle).lower())
        self.bed = Testbed(self.spark, bed.sf_dir)
        self.folder = work_folder(bed.spark, name)
        self.staged: dict[str, DataFrame] = {}
        self.slices = SLICES

    def _partition(self, number: int) -> None:
        self.spark.conf.set("spark.sql.shuffle.partitions", str(number))

    def cut(self, rows: int) -> None:
        """Enough slices for the rows of the largest input, a state to match, and enough tasks to stage them."""
        self.slices = max(SLICES, -(-rows // SLICE_ROWS))
        if rows > SLICE_ROWS:
            for name, value in LARGE_STATE.items():
                self.spark.conf.set(name, value)
        self._partition(max(self.spark.sparkContext.defaultParallelism, -(-rows // STAGED_ROWS)))

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def stage(self, name: str, rows: DataFrame, slice_: Column) -> None:
        """Prepare an input; ``slice_`` numbers the slices of its rows from 0."""
        rows.withColumn("_slice", slice_).write.partitionBy("_slice").parquet(self.path(f"staged/{name}"))
        self.staged[name] = self.spark.read.parquet(self.path(f"staged/{name}"))

    def stream(self, name: str, **options) -> DataFrame:
        columns = self.staged[name].drop("_slice").schema.simpleString()[7:-1].replace(":", " ")
        return read_stream(self.spark, "parquet", self.path(name), columns, **options)

    def hand_out(self, number: int) -> None:
        for name, rows in self.staged.items():
            (rows.filter(F.col("_slice") == number).drop("_slice")
             .write.mode("append").parquet(self.path(name)))

    def run(self, *starts: Callable[[], object]) -> None:
        """Per slice: hand it out, then run each job on what is there."""
        # State is kept per shuffle partition, so their number is fixed at the first start.
        self._partition(self.spark.sparkContext.defaultParallelism)
        for number in range(self.slices):
            self.hand_out(number)
            for writer in starts:
                jobs.start(writer(), AVAILABLE).awaitTermination()


def _time_slice(time: str, bounds: tuple, slices: int = SLICES) -> Column:
    """Number of the slice of a time, with equal slices between the bounds."""
    first, last = (bound.timestamp() for bound in bounds)
    place = (F.unix_timestamp(time) - F.lit(int(first))) / F.lit(max(last - first, 1.0))
    return F.least(F.greatest(F.floor(place * slices), F.lit(0)), F.lit(slices - 1))


def _bounds(rows: DataFrame, time: str) -> tuple:
    return tuple(rows.agg(F.min(time), F.max(time)).first())


def _hash_slice(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(SLICES))


def _file_sink(rows: DataFrame, feed: Feed, name: str = "out"):
    return (rows.writeStream.format("parquet").option("path", feed.path(name))
            .option("checkpointLocation", feed.path(f"checkpoint/{name}")))


def _routed(spark: SparkSession, folder: str) -> DataFrame:
    records = spark.read.schema(schemas.RECORD).parquet(folder)
    numeric = F.regexp_like("value", F.lit(r'"id":-?\d')).alias("id_is_number")
    fields = records.select("topic", "key", numeric, json_fields(F.col("value")).alias("_fields"))
    found = F.col("_fields")
    return fields.select("topic", "key", "id_is_number", found["id"].cast("bigint").alias("id"),
                         found["user_id"].alias("user_id"), found["name"].alias("name"),
                         found["final_total_amount"].cast("double").alias("final_total_amount"))


def stream_cdc_route(bed: Testbed) -> DataFrame:
    """All slices at once, a few files per micro-batch."""
    feed = Feed(bed, "cdc_route")
    feed.stage("raw", feed.bed.maxwell(), _hash_slice("value"))
    for number in range(SLICES):
        feed.hand_out(number)
    writer = jobs.route_changes(feed.stream("raw", max_per_trigger=8), feed.path("out"),
                                feed.path("checkpoint"))
    jobs.start(writer, AVAILABLE).awaitTermination()
    return _routed(bed.spark, feed.path("out"))


def stream_resume(bed: Testbed) -> DataFrame:
    """Stopped and started again between slices."""
    feed = Feed(bed, "resume")
    feed.stage("raw", feed.bed.maxwell(), _hash_slice("value"))
    feed.run(lambda: jobs.route_changes(feed.stream("raw"), feed.path("out"), feed.path("checkpoint")))
    return _routed(bed.spark, feed.path("out"))


def stream_dim_upsert(bed: Testbed) -> DataFrame:
    """The table as the stream's state has it."""
    feed = Feed(bed, "dim_upsert")
    changes = feed.bed.spu_feed()
    last = changes.agg(F.max("offset")).first()[0]
    feed.stage("changes", changes, F.floor(F.col("offset") * SLICES / F.lit(last + 1)))
    table = PublishedTable(feed.spark, feed.path("spu"), schemas.ddl(schemas.SPU))
    feed.run(lambda: jobs.maintain_dimension(
        feed.stream("changes"), lambda rows: dims.spu(rows, keep=("offset",)), table, ["offset"],
        feed.path("checkpoint")))
    return state.dimension_state(bed.spark, feed.path("checkpoint")).select(*schemas.SPU)


def stream_dim_published(bed: Testbed) -> DataFrame:
    """The same table as other jobs read it: of the keys that some facts name, from sorted files."""
    feed = Feed(bed, "dim_published")
    changes = feed.bed.spu_feed()
    last = changes.agg(F.max("offset")).first()[0]
    feed.stage("changes", changes, F.floor(F.col("offset") * SLICES / F.lit(last + 1)))
    table = PublishedTable(feed.spark, feed.path("spu"), schemas.ddl(schemas.SPU), every=1)
    feed.run(lambda: jobs.maintain_dimension(
        feed.stream("changes"), lambda rows: dims.spu(rows, keep=("offset",)), table, ["offset"],
        feed.path("checkpoint")))
    wanted = bed.table("part").where(F.col("p_size") <= 5).select(bed.spu_id().alias("k"))
    published = PublishedTable(bed.spark, table.path, table.columns, every=1)
    return published.read_keys(wanted, "k")


def stream_dau(bed: Testbed) -> DataFrame:
    """Logs arrive up to three hours after they were made, often on the next day."""
    feed = Feed(bed, "dau")
    late = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.pmod("event_id", F.lit(10_800)))
    events = feed.bed.table("events").select("event_id", (F.col("ts").cast("timestamp") + late).alias("at"))
    raw = feed.bed.logs().join(events, "event_id").drop("event_id")
    feed.stage("logs", raw, _time_slice("at", _bounds(events, "at")))
    feed.run(lambda: _file_sink(jobs.first_visits(feed.stream("logs")), feed))
    return bed.spark.read.parquet(feed.path("out")).select("dt", "mid")


def _keyed(table: Callable[[], DataFrame]) -> jobs.KeyedRead:
    return lambda facts, key: keyed_scan(table(), "id", facts, key)


def _order_info_writer(feed: Feed, keep: tuple[str, ...] = ()):
    as_of = F.lit("2024-01-01").cast("date")
    return jobs.order_info_job(feed.stream("orders"), feed.bed.provinces, _keyed(feed.bed.users),
                               to_folder(feed.path("dwd_orders")), feed.path("checkpoint/orders"), as_of, keep)


def _timed_orders(bed: Testbed) -> DataFrame:
    return bed.orders().withColumn("order_ts", F.to_timestamp("create_time"))


def stream_order_info(bed: Testbed) -> DataFrame:
    feed = Feed(bed, "order_info")
    timed = _timed_orders(feed.bed)
    feed.stage("orders", as_json(timed, "order_ts"), _time_slice("order_ts", _bounds(timed, "order_ts")))
    feed.run(lambda: _order_info_writer(feed))
    records = bed.spark.read.schema(schemas.RECORD).parquet(feed.path("dwd_orders"))
    return orders.parse_order_records(records)


def _arrivals(feed: Feed) -> tuple:
    """Stage orders and their lines by the second of their arrival; gives the first and last order's."""
    info = feed.bed.at(orders.with_time_parts(feed.bed.order_info()), "id", "order_ts")
    detail = feed.bed.at(feed.bed.priced_detail("l_linenumber"), "order_id", "detail_ts", "l_linenumber")
    detail = detail.select(*schemas.ORDER_DETAIL, "detail_ts")
    bounds = _bounds(feed.bed.at(feed.bed.order_times(), "id", "order_ts"), "order_ts")
    feed.cut(feed.bed.table("lineitem").count())
    feed.stage("info", info, _time_slice("order_ts", bounds, feed.slices))
    feed.stage("detail", detail, _time_slice("detail_ts", bounds, feed.slices))
    return bounds


def stream_wide_join(bed: Testbed) -> DataFrame:
    feed = Feed(bed, "wide_join")
    _arrivals(feed)
    feed.run(lambda: _file_sink(
        jobs.wide_pairs(feed.stream("info"), feed.stream("detail"), "30 seconds", salts=2).drop("at"), feed))
    return bed.spark.read.parquet(feed.path("out"))


def stream_late_lines(bed: Testbed) -> DataFrame:
    """Lines more than three seconds behind their order; an hour later comes one more of each, which moves
    the watermark past all the others."""
    feed = Feed(bed, "late_lines", idle=True)
    _, last = _arrivals(feed)
    later = F.lit(last) + F.expr("INTERVAL 1 HOUR")
    for name, time in (("info", "order_ts"), ("detail", "detail_ts")):
        rows = feed.staged[name]
        known = {time: later, "_slice": F.lit(feed.slices - 1), "id": F.lit(-1), "order_id": F.lit(-2)}
        mark = feed.spark.range(1).select(*(
            known.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name) for field in rows.schema))
        feed.staged[name] = rows.unionByName(mark)

    def writer():
        lines = jobs.unmatched_lines(feed.stream("info"), feed.stream("detail"), "30 seconds", "3 seconds")
        return _file_sink(lines.select("order_id", "id", "sku_id", "sku_num", "sku_price"), feed)
    feed.run(writer)
    return bed.spark.read.parquet(feed.path("out")).where("id >= 0")


def stream_order_wide(bed: Testbed) -> DataFrame:
    """Raw order and detail records through all four jobs to wide rows."""
    feed = Feed(bed, "order_wide")
    timed = _timed_orders(feed.bed)
    bounds = _bounds(timed, "order_ts")
    feed.cut(feed.bed.table("lineitem").count())
    feed.stage("orders", as_json(timed, "order_ts"), _time_slice("order_ts", bounds, feed.slices))
    created = feed.bed.order_times().select(
        F.col("id").alias("_order"), F.to_timestamp("create_time").alias("_created"))
    detail = feed.bed.details(F.col("l_linenumber"), spread=True)
    detail = (detail.join(created, F.col("order_id") == F.col("_order"))
              .withColumn("detail_ts", F.col("_created")
                          + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), 2 * F.col("l_linenumber")))
              .drop("_order", "_created", "l_linenumber"))
    feed.stage("details", as_json(detail, "detail_ts"), _time_slice("detail_ts", bounds, feed.slices))

    def detail_writer():
        return jobs.order_detail_job(feed.stream("details"), _keyed(feed.bed.flat_skus),
                                     to_folder(feed.path("dwd_details")),
                                     feed.path("checkpoint/details"),
                                     keep=("detail_ts",))

    def pair_writer():
        info, lines = (read_stream(feed.spark, "parquet", feed.path(name),
                                   f"{schemas.RECORD}, {time} timestamp, batch bigint")
                       for name, time in (("dwd_orders", "order_ts"), ("dwd_details", "detail_ts")))
        pairs = jobs.wide_pairs(orders.parse_order_records(info, "order_ts", written=True),
                                orders.order_detail(lines, keep=("detail_ts",), written=True), "1 minute", "1 minute")
        return jobs.order_pair_job(pairs, to_folder(feed.path("pairs")), feed.path("checkpoint/pairs"))

    def wide_writer():
        records = read_stream(feed.spark, "parquet", feed.path("pairs"), f"{schemas.RECORD}, batch bigint")
        return jobs.order_wide_job(wide.parse_pairs(records), to_folder(feed.path("dws")), feed.path("checkpoint/wide"))

    feed.run(lambda: _order_info_writer(feed, keep=("order_ts",)), detail_writer, pair_writer, wide_writer)
    records = bed.spark.read.schema(schemas.RECORD).parquet(feed.path("dws"))
    return wide.parse_wide_records(records)


STREAM_QUERIES: dict[str, Callable[[Testbed], DataFrame]] = {
    "stream_cdc_route": stream_cdc_route,
    "stream_dim_upsert": stream_dim_upsert,
    "stream_dim_published": stream_dim_published,
    "stream_dau": stream_dau,
    "stream_order_info": stream_order_info,
    "stream_wide_join": stream_wide_join,
    "stream_late_lines": stream_late_lines,
    "stream_order_wide": stream_order_wide,
    "stream_resume": stream_resume,
}
