"""App start logs: validity, projection, first visit of the day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rivermart.functions import json_fields, parse_once
from rivermart.operators.lookup import first_per_key
from rivermart.operators.skew import DEFAULT, Skew, fits_broadcast


def _complete(fields: Column) -> Column:
    return F.coalesce(
        F.map_contains_key(fields, "mid") & F.map_contains_key(fields, "ts"), F.lit(False))


def has_device_and_time(text: Column) -> Column:
    """True for a JSON object with the keys mid and ts, even if their values are null."""
    return _complete(json_fields(text))


def valid_logs(raw: DataFrame, value: str = "value") -> DataFrame:
    parsed = parse_once(raw, json_fields(F.col(value)), "_fields", tuple(raw.columns))
    return parsed.filter(_complete(F.col("_fields"))).drop("_fields")


def start_logs(raw: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Valid logs, typed; optional fields default to "", day, hour and minute come from ts."""
    fields = F.col("_fields")
    typed = (parse_once(raw, json_fields(F.col(value)), "_fields", keep)
             .filter(_complete(fields))
             .select(fields["mid"].alias("mid"),
                     *(F.coalesce(fields[name], F.lit("")).alias(name)
                       for name in ("uid", "ar", "ch", "vc")),
                     fields["ts"].try_cast("bigint").alias("ts"), *keep))
    at = F.timestamp_millis("ts")
    return typed.select(
        "mid", "uid", "ar", "ch", "vc", F.date_format(at, "yyyyMMdd").alias("dt"),
        F.date_format(at, "HH").alias("hr"), F.date_format(at, "mm").alias("mi"), "ts", *keep)


def first_visits(logs: DataFrame, seen: DataFrame | None = None, order: tuple[str, ...] = ("ts",),
                 day_from: str = "event", skew: Skew = DEFAULT) -> DataFrame:
    """The first log of each device and day that is not in ``seen`` (dt, mid).

    ``day_from`` is "event" for the day of ts or "processing" for today.
    """
    if day_from == "processing":
        logs = logs.withColumn("dt", F.date_format(F.current_date(), "yyyyMMdd"))
    elif day_from != "event":
        raise ValueError(f"day_from: {day_from}")
    # Reduced first: what goes on to the seen set has one row per device and day.
    first = first_per_key(logs, ["dt", "mid"], *order)
    if seen is None:
        return first
    seen = seen.select(F.col("dt").alias("_dt"), F.col("mid").alias("_mid"))
    if fits_broadcast(seen, skew):
        seen = F.broadcast(seen)
    known = F.col("dt").eqNullSafe(F.col("_dt")) & F.col("mid").eqNullSafe(F.col("_mid"))
    return first.join(seen, known, "left_anti")
