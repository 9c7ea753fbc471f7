"""Change-capture envelopes to routed records (topic, key, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rivermart.functions import parse_once

# Envelope types that mark the ends of a snapshot, topic prefixes.
SNAPSHOT_MARKS = ("bootstrap-start", "bootstrap-complete")
MAXWELL_PREFIX = "ODS_T_"
CANAL_PREFIX = "ODS_"

MAXWELL = ("database string, table string, type string, ts bigint, xid bigint, "
           "commit boolean, data variant")
CANAL = "database string, table string, type string, isDdl boolean, ts bigint, data array<variant>"


def _fields(row: Column) -> Column:
    """A row's fields by name, each with its JSON type; NULL for anything but an object."""
    return F.try_variant_get(row, "$", "map<string,variant>")


def field_text(fields: Column, name: str) -> Column:
    """One field as text, whatever its type."""
    return F.try_variant_get(fields[name], "$", "string")


def _payload(fields: Column) -> Column:
    """The fields as JSON text, types kept, without those that are null."""
    return F.to_json(F.map_filter(fields, lambda _, value: value.isNotNull() & ~F.is_variant_null(value)))


def parse_maxwell(raw: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    events = parse_once(raw, F.from_json(value, MAXWELL), "event", keep).select("event.*", *keep)
    return events.withColumn("data", _fields(F.col("data")))


def drop_snapshot_marks(events: DataFrame) -> DataFrame:
    """Leave out snapshot start and end; deletes and events without a type stay."""
    return events.filter(~F.coalesce("type", F.lit("")).isin(*SNAPSHOT_MARKS))


def route_maxwell(events: DataFrame, prefix: str = MAXWELL_PREFIX,
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """One record per event, on the topic of its table, keyed by the row's id."""
    routed = events.filter(F.col("table").isNotNull() & F.col("data").isNotNull())
    return routed.select(F.concat(F.lit(prefix), F.upper("table")).alias("topic"),
                         field_text(F.col("data"), "id").alias("key"),
                         _payload(F.col("data")).alias("value"), *keep)


def maxwell_records(raw: DataFrame, value: str = "value", prefix: str = MAXWELL_PREFIX,
                    keep: tuple[str, ...] = ()) -> DataFrame:
    return route_maxwell(drop_snapshot_marks(parse_maxwell(raw, value, keep)), prefix, keep)


def parse_canal(raw: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    return parse_once(raw, F.from_json(value, CANAL), "event", keep).select("event.*", *keep)


def explode_canal(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per changed row; an event without rows (a schema change) gives none."""
    rows = events.select("table", F.explode_outer("data").alias("data"), *keep)
    rows = rows.withColumn("data", _fields(F.col("data")))
    return rows.filter(F.col("data").isNotNull())


def route_canal(rows: DataFrame, prefix: str = CANAL_PREFIX,
                keep: tuple[str, ...] = ()) -> DataFrame:
    """One record per row, on the topic of its table, keyed by table name and id."""
    name = F.upper("table")
    return (rows.filter(F.col("table").isNotNull())
            .select(F.concat(F.lit(prefix), name).alias("topic"),
                    F.concat(name, F.coalesce(field_text(F.col("data"), "id"), F.lit("null"))).alias("key"),
                    _payload(F.col("data")).alias("value"), *keep))


def canal_records(raw: DataFrame, value: str = "value", prefix: str = CANAL_PREFIX,
                  keep: tuple[str, ...] = ()) -> DataFrame:
    return route_canal(explode_canal(parse_canal(raw, value, keep), keep), prefix, keep)


def select_topic(records: DataFrame, topic: str) -> DataFrame:
    return records.filter(F.col("topic") == topic)
