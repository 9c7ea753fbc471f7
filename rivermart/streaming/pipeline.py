"""The pipeline's jobs, wired to topics and tables.

    python -m rivermart.streaming.pipeline order_info --topics kafka:host:9092 --root s3a://shop

With ``--topics kafka:<servers>`` records travel over Kafka (Spark's connector
must be on the cluster); otherwise topics are folders below the root. Tables
and checkpoints are folders below the root in either case.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from rivermart import schemas
from rivermart.operators import dims, orders, wide
from rivermart.session import build_session
from rivermart.sources.published import PublishedTable
from rivermart.sources.sinks import Emit, to_folder, to_kafka, to_records
from rivermart.sources.streams import read_stream
from rivermart.streaming import jobs

MAXWELL_TOPIC = "DB_MAXWELL"
CANAL_TOPIC = "DB_CANAL"
START_LOG_TOPIC = "APP_START_LOG"
VISITS = "DAU"
# What a folder topic holds besides key and value: the order and time of arrival.
ARRIVAL = ("offset", "timestamp")
RAW_RECORD = "value string, offset bigint, timestamp timestamp"

# Fixed values. Job -> (seconds between batches, records per second and partition, if asked for).
PACE = {
    "maxwell_router": (3, 500), "canal_router": (3, 150), "category1": (3, None),
    "category2": (3, None), "category3": (3, None), "spu": (3, None), "user": (3, None),
    "province": (3, None), "sku": (3, None), "order_info": (5, 200), "order_detail": (3, 500),
    "order_pair": (3, 500), "order_wide": (3, 500), "late_lines": (3, 500), "dau": (3, 50)}


@dataclass(frozen=True)
class Site:
    """Where the pipeline's topics and tables are, and how fast topics are read."""
    spark: SparkSession
    root: str
    kafka: str | None = None
    partitions: int | None = None
    files: int | None = None
    delay: str = "1 minute"
    bound: str | None = None
    salts: int = jobs.SALTS
    keep: str = "2 days"
    day_from: str = "event"
    as_of: Column | None = None

    def checkpoint(self, job: str) -> str:
        return f"{self.root}/checkpoints/{job}"

    def topic_folder(self, name: str) -> str:
        return f"{self.root}/topics/{name}"

    def records(self, topic: str, job: str, schema: str) -> DataFrame:
        """A topic's records, all there are; with ``partitions``, at the job's pace for a Kafka
        topic of so many, and with ``files`` so many files of a folder topic, per batch."""
        if not self.kafka:
            return read_stream(self.spark, "parquet", self.topic_folder(topic), schema, self.files)
        seconds, rate = PACE[job]
        cap = rate * seconds * self.partitions if rate and self.partitions else None
        return read_stream(self.spark, "kafka", topic, max_per_trigger=cap,
                           **{"kafka.bootstrap.servers": self.kafka})

    def source_records(self, table: str, job: str) -> DataFrame:
        """The routed records of a source table."""
        topic = f"ODS_T_{table.upper()}"
        if self.kafka:
            return self.records(topic, job, "")
        every = read_stream(self.spark, "parquet", self.topic_folder("maxwell"),
                            f"{schemas.RECORD}, offset bigint, timestamp timestamp", self.files)
        return every.filter(F.col("topic") == topic)

    def emit(self, topic: str) -> Emit:
        return to_kafka(self.kafka) if self.kafka else to_folder(self.topic_folder(topic))

    def dimension(self, name: str) -> PublishedTable:
        return PublishedTable(self.spark, f"{self.root}/tables/{name}", schemas.ddl(DIMENSIONS[name]),
                              "tm_id" if name == "trademark" else "id")


# Table -> columns. Region and trademark are filled from outside the pipeline.
DIMENSIONS = {
    "category1": schemas.CATEGORY1, "category2": schemas.CATEGORY2, "category3": schemas.CATEGORY3,
    "spu": schemas.SPU, "user": schemas.USER, "province": schemas.PROVINCE, "sku": schemas.SKU,
    "region": {"id": "string", "region_name": "string"},
    "trademark": {"tm_id": "string", "tm_name": "string"}}


def _router(envelope: str, topic: str) -> Callable[[Site, str], DataStreamWriter]:
    def job(site: Site, name: str) -> DataStreamWriter:
        raw = site.records(topic, name, RAW_RECORD)
        options = {"kafka.bootstrap.servers": site.kafka} if site.kafka else {}
        return jobs.route_changes(raw, site.topic_folder(envelope), site.checkpoint(name), envelope,
                                  "kafka" if site.kafka else "parquet", ARRIVAL, **options)
    return job


def _dimension(table: str, project: Callable[..., DataFrame],
               complete: Callable[[Site, DataFrame], DataFrame] = lambda _, rows: rows
               ) -> Callable[[Site, str], DataStreamWriter]:
    def job(site: Site, name: str) -> DataStreamWriter:
        order = ARRIVAL[:1]
        return jobs.maintain_dimension(
            site.source_records(table, name), lambda records: project(records, keep=order), site.dimension(name),
            list(order), site.checkpoint(name), lambda rows: complete(site, rows))
    return job


def _with_region(site: Site, rows: DataFrame) -> DataFrame:
    return dims.with_region(rows, site.dimension("region").read()).select(*schemas.PROVINCE)


def _flattened(site: Site, rows: DataFrame) -> DataFrame:
    parents = (site.dimension(name).read()
               for name in ("trademark", "category3", "category2", "category1", "spu"))
    return dims.flatten_sku(rows, *parents)


def _order_info(site: Site, name: str) -> DataStreamWriter:
    return jobs.order_info_job(
        site.source_records("order_info", name), lambda: site.dimension("province").read(),
        site.dimension("user").read_keys, site.emit(jobs.ORDER_TOPIC), site.checkpoint(name), site.as_of)


def _order_detail(site: Site, name: str) -> DataStreamWriter:
    return jobs.order_detail_job(
        site.source_records("order_detail", name), site.dimension("sku").read_keys,
        site.emit(jobs.DETAIL_TOPIC), site.checkpoint(name))


def _arrived(site: Site, name: str) -> tuple[DataFrame, DataFrame]:
    """Enriched orders and details as they arrive on their topics."""
    def records(topic: str, time: str) -> DataFrame:
        rows = site.records(topic, name, f"{schemas.RECORD}, timestamp timestamp, batch bigint")
        return rows.withColumnRenamed("timestamp", time)
    return (orders.parse_order_records(records(jobs.ORDER_TOPIC, "order_ts"), "order_ts"),
            orders.order_detail(records(jobs.DETAIL_TOPIC, "detail_ts"), keep=("detail_ts",)))


def _order_pair(site: Site, name: str) -> DataStreamWriter:
    pairs = jobs.wide_pairs(*_arrived(site, name), site.delay, site.bound, site.salts)
    return jobs.order_pair_job(pairs, site.emit(jobs.PAIR_TOPIC), site.checkpoint(name))


def _order_wide(site: Site, name: str) -> DataStreamWriter:
    records = site.records(jobs.PAIR_TOPIC, name, f"{schemas.RECORD}, batch bigint")
    return jobs.order_wide_job(wide.parse_pairs(records), site.emit(jobs.WIDE_TOPIC), site.checkpoint(name), site.keep)


def _late_lines(site: Site, name: str) -> DataStreamWriter:
    """Without a bound, pairs meet in windows of six seconds: beyond that a line has surely missed its order."""
    lines = jobs.unmatched_lines(*_arrived(site, name), site.delay, site.bound or wide.WINDOW)
    emit = site.emit(jobs.UNMATCHED_TOPIC)
    return (lines.writeStream.option("checkpointLocation", site.checkpoint(name))
            .foreachBatch(lambda rows, batch_id: emit(to_records(rows, jobs.UNMATCHED_TOPIC, "id"), batch_id)))


def _dau(site: Site, name: str) -> DataStreamWriter:
    raw = site.records(START_LOG_TOPIC, name, RAW_RECORD).withColumnRenamed("timestamp", "at")
    visits = jobs.first_visits(raw, site.keep, day_from=site.day_from)
    return (visits.writeStream.format("parquet").option("path", f"{site.root}/tables/{VISITS}")
            .option("checkpointLocation", site.checkpoint(name)))


JOBS: dict[str, Callable[[Site, str], DataStreamWriter]] = {
    "maxwell_router": _router("maxwell", MAXWELL_TOPIC),
    "canal_router": _router("canal", CANAL_TOPIC),
    "category1": _dimension("base_category1", dims.category1),
    "category2": _dimension("base_category2", dims.category2),
    "category3": _dimension("base_category3", dims.category3),
    "spu": _dimension("spu_info", dims.spu),
    "user": _dimension("user_info", dims.user),
    "province": _dimension("base_province", dims.province, _with_region),
    "sku": _dimension("sku_info", dims.sku, _flattened),
    "order_info": _order_info,
    "order_detail": _order_detail,
    "order_pair": _order_pair,
    "order_wide": _order_wide,
    "late_lines": _late_lines,
    "dau": _dau,
}


def start_job(site: Site, name: str, trigger: dict | None = None) -> StreamingQuery:
    """Start a job at its usual pace, or with another trigger."""
    seconds, _ = PACE[name]
    return jobs.start(JOBS[name](site, name), trigger or {"processingTime": f"{seconds} seconds"})


def main() -> None:
    parser = argparse.ArgumentParser(description="Run one of the pipeline's jobs.")
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--root", required=True, help="folder of tables, checkpoints and folder topics")
    parser.add_argument("--topics", default="", help="kafka:<bootstrap servers>; default: folders")
    parser.add_argument("--partitions", type=int, help="cap the rate to the jobs' pace, for so many partitions")
    parser.add_argument("--files", type=int, help="cap a batch of a folder topic to so many files")
    parser.add_argument("--delay", default="1 minute", help="how far orders and details may be behind the newest")
    parser.add_argument("--bound", help="join orders and details up to this far apart")
    parser.add_argument("--salts", type=int, default=jobs.SALTS, help="tasks one order is spread over")
    parser.add_argument("--keep", default="2 days", help="how long a device's visit of a day and an order's lines are known")
    parser.add_argument("--day-from", default="event", choices=("event", "processing"), help="the day of a visit")
    args = parser.parse_args()
    site = Site(build_session(), args.root.rstrip("/"), args.topics.removeprefix("kafka:") or None,
                args.partitions, args.files, args.delay, args.bound, args.salts, args.keep, args.day_from)
    start_job(site, args.job).awaitTermination()


if __name__ == "__main__":
    main()
