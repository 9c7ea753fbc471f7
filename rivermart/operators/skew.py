"""Splitting groups that are too large for one task.

A group is *hot* when it has more rows than ``hot_rows`` and more than one in
``hot_share`` of all rows, so there are never more than ``hot_share`` hot
groups, and never more than ``2 * hot_share`` chunks: lists of hot groups are
safe to broadcast whatever the size of the data.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

CHUNK = "_chunk"
HOT_KEY = "_hot_key"
_SIZE = "_hot_size"
_CHUNKS = "_hot_chunks"


@dataclass(frozen=True)
class Skew:
    """Limits for treating a group as hot.

    small_input: inputs of up to this many bytes are one task's work even if
    they are a single group, so they are not examined.
    broadcast_limit: size up to which a lookup side is broadcast; None takes
    the session's ``spark.sql.autoBroadcastJoinThreshold``.
    """
    hot_rows: int = 1_000_000
    hot_share: int = 50_000
    buckets: int = 1 << 17
    small_input: int = 64 << 20
    broadcast_limit: int | None = None


DEFAULT = Skew()


def estimated_bytes(rows: DataFrame) -> int | None:
    """Catalyst's size estimate of a result, from file sizes upward; None without one."""
    try:
        return int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:
        return None


def input_bytes(rows: DataFrame) -> int | None:
    """Size of all inputs a result is computed from; None if unknown."""
    try:
        leaves = rows._jdf.queryExecution().withCachedData().collectLeaves()
        return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    except AttributeError:
        return None


def fits_broadcast(rows: DataFrame, skew: Skew = DEFAULT) -> bool:
    """Whether a lookup side is known to be small enough for every executor."""
    limit = skew.broadcast_limit
    if limit is None:
        text = rows.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
        # Spark's own reading of sizes: a plain number, or one with a unit.
        limit = rows.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text) \
            if not text.startswith("-") else -1
    size = estimated_bytes(rows)
    return size is not None and size <= limit


def is_small(rows: DataFrame, skew: Skew = DEFAULT) -> bool:
    """Whether the inputs together are little enough for one task."""
    size = input_bytes(rows)
    return size is not None and size <= skew.small_input


def hot_groups(rows: DataFrame, key: str, skew: Skew = DEFAULT, **measures: Column) -> DataFrame:
    """Key, size and chunk count of each hot group, with extra aggregates over its rows.

    Two narrow passes. The first counts rows per hash bucket, which the map
    side reduces to a bounded number of rows; a hot group always sits in a
    bucket over the limit, so the second pass looks only into those.
    """
    counted = _bucket_sizes(rows, key, skew)
    total = counted.agg(F.coalesce(F.sum("_rows"), F.lit(0))).scalar()
    limit = F.greatest(F.lit(skew.hot_rows), F.floor(total / F.lit(skew.hot_share)))
    heavy = counted.filter(F.col("_rows") > limit).select("_bucket")
    suspects = rows.join(F.broadcast(heavy), _bucket(key, skew) == F.col("_bucket"), "left_semi")
    return (suspects.groupBy(F.col(key).alias(HOT_KEY))
            .agg(F.count(F.lit(1)).alias(_SIZE),
                 *(column.alias(name) for name, column in measures.items()))
            .filter(F.col(_SIZE) > limit)
            .withColumn(_CHUNKS, F.ceil(F.col(_SIZE) / limit)))


def _bucket(key: str, skew: Skew) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(skew.buckets))


def _bucket_sizes(rows: DataFrame, key: str, skew: Skew) -> DataFrame:
    return rows.groupBy(_bucket(key, skew).alias("_bucket")).agg(F.count(F.lit(1)).alias("_rows"))


def _may_be_hot(rows: DataFrame, key: str, skew: Skew) -> bool:
    """Whether any bucket is over the limit; without one there is no hot group."""
    sizes = _bucket_sizes(rows, key, skew).agg(F.sum("_rows"), F.max("_rows")).first()
    total, largest = (size or 0 for size in sizes)
    return largest > max(skew.hot_rows, total // skew.hot_share)


def find_hot(rows: DataFrame, key: str, skew: Skew = DEFAULT, **measures: Column) -> DataFrame | None:
    """The hot groups as a fixed list, or None if there are none or the input is small.

    Fetching the bounded list now keeps later plans free of the search, and
    plans without hot groups free of any special treatment. The second pass, whose
    measures may need shuffles of all rows, is run only if the first gives cause.
    """
    if is_small(rows, skew) or not _may_be_hot(rows, key, skew):
        return None
    groups = hot_groups(rows, key, skew, **measures)
    found = groups.collect()
    return rows.sparkSession.createDataFrame(found, groups.schema) if found else None


@dataclass(frozen=True)
class Spread:
    """Rows whose hot groups are cut into chunks; ``keys`` says how to co-locate them.

    Ordinary groups are chunk 0. ``hot`` is None when there are no hot groups,
    and then there is no chunk column.
    """
    rows: DataFrame
    key: str
    hot: DataFrame | None
    skew: Skew = DEFAULT

    @property
    def keys(self) -> list[str]:
        return [self.key] if self.hot is None else [self.key, CHUNK]

    def on(self, rows: DataFrame) -> Spread:
        """The same spread after a step that kept the key and chunk columns."""
        return replace(self, rows=rows)

    def result(self) -> DataFrame:
        return self.rows if self.hot is None else self.rows.drop(CHUNK)

    def replicate(self, side: DataFrame, key: str) -> DataFrame:
        """The other side of a join, once per chunk of each hot key."""
        if self.hot is None:
            return side
        hot = self.hot.select(HOT_KEY, _CHUNKS)
        return (side.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col(HOT_KEY)), "left")
                .withColumn(CHUNK, F.explode(F.sequence(
                    F.lit(0).cast("bigint"), F.coalesce(_CHUNKS, F.lit(1)) - 1)))
                .drop(HOT_KEY, _CHUNKS))


    def hot_only(self, rows: DataFrame, key: str) -> DataFrame:
        """Those of the rows that belong to hot groups."""
        hot = self.hot.select(HOT_KEY)
        return rows.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col(HOT_KEY)), "left_semi")


def apply_spread(rows: DataFrame, key: str, hot: DataFrame | None,
                 chunk: Callable[[Column], Column], skew: Skew = DEFAULT) -> Spread:
    """Cut the rows of the given hot groups; ``chunk`` maps the chunk count to 0..count-1."""
    if hot is None:
        return Spread(rows, key, None, skew)
    cut = (rows.join(F.broadcast(hot), F.col(key).eqNullSafe(F.col(HOT_KEY)), "left")
           .withColumn(CHUNK, F.coalesce(chunk(F.col(_CHUNKS)), F.lit(0).cast("bigint")))
           .select(*rows.columns, CHUNK))
    return Spread(cut, key, hot, skew)


def spread(rows: DataFrame, key: str, chunk: Callable[[Column], Column], skew: Skew = DEFAULT,
           counted: DataFrame | None = None, **measures: Column) -> Spread:
    """Find the hot groups of ``key`` and cut them.

    The search scans the rows twice, reading only the key and the measured
    columns. If ``rows`` come out of joins, ``counted`` names the table they
    started from, which is cheaper to scan.
    """
    hot = find_hot(rows if counted is None else counted, key, skew, **measures)
    return apply_spread(rows, key, hot, chunk, skew)


def by_hash(*columns: str) -> Callable[[Column], Column]:
    """Chunk by hash: even, and equal values of the columns stay together."""
    return lambda chunks: F.pmod(F.xxhash64(*columns), chunks)


#: Bounds that say how a hot group's positions lie; between two of them they count as even.
CELLS = 64


def quantile_bounds(position: str) -> Column:
    """Measure of a hot group: CELLS + 1 bounds with about as many of its rows between any two."""
    return F.percentile_approx(position, F.array(*(F.lit(i / CELLS) for i in range(CELLS + 1))), F.lit(10_000))


def by_quantile(position: str, bounds: str) -> Callable[[Column], Column]:
    """Chunk by slices of about as many rows, however the positions lie: a later chunk holds later
    rows, and rows of one position stay together."""
    def chunk(chunks: Column) -> Column:
        at, ends = F.col(position), F.col(bounds)
        below = F.size(F.filter(ends, lambda bound: bound < at))
        low, high = (F.get(ends, below - 1).cast("double"), F.get(ends, below).cast("double"))
        # Within the cell (low, high]; ahead of the first bound and behind the last there is no cell.
        part = F.least((at.cast("double") - low) / (high - low), F.lit(1.0))
        place = F.when(below == 0, F.lit(0.0)).when(below > CELLS, F.lit(1.0)).otherwise((below - 1 + part) / CELLS)
        return F.least(F.floor(place * chunks), chunks - 1).cast("bigint")
    return chunk
