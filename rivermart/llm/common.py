"""Helpers of the text operators: Arrow text buffers, word hashes, tables between jobs."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from rivermart.sources.storage import work_folder

#: Texts are handled in chunks of about so many bytes, which bounds a task's memory.
CHUNK_BYTES = 1 << 20
#: Rows of an Arrow batch, unless the session says otherwise.
BATCH_ROWS = 1000
SHINGLE_WORDS = 5


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches, and this repository on the workers' path of a local session."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(BATCH_ROWS))
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))


_KEPT: list[tuple[str, Callable[[], None]]] = []


def claim(operator: str, forget: Callable[[], None] = lambda: None) -> None:
    """Called by an operator's tasks: what another operator has kept in this worker goes.

    Workers outlive stages, so what each operator keeps would otherwise add up.
    """
    if _KEPT and _KEPT[0][0] != operator:
        _KEPT.pop()[1]()
    if not _KEPT:
        _KEPT.append((operator, forget))


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """Write the rows to the shared folder and read them again, which cuts the lineage."""
    spark = frame.sparkSession
    folder = work_folder(spark, purpose)
    frame.write.parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def map_arrow(frame: DataFrame, function, schema: str) -> DataFrame:
    """``function`` from batches to batches; every batch is cast to ``schema``."""
    return frame.mapInArrow(function, schema)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts on end, and n + 1 bounds; a null text is empty."""
    column = column.fill_null("")
    if column.type != pa.large_string():
        column = column.cast(pa.large_string())
    n = len(column)
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    if n == 0 or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[bounds[0]:bounds[-1]]
    return data, bounds - bounds[0]


def chunks(bounds: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring texts of about ``limit`` bytes together, at least one text each."""
    first, n = 0, len(bounds) - 1
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64's finisher)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: A random-looking 64-bit number for each byte.
BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
FOLD = np.arange(256)
FOLD[65:91] += 32
FOLDED = BYTES[FOLD]
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64, at least n of each."""
    if _POWERS and len(_POWERS[0][0]) >= n:
        return _POWERS[0]
    size = max(n, CHUNK_BYTES + (1 << 17))
    tables = powers(BASE, size), powers(INVERSE, size)
    if size <= 8 * CHUNK_BYTES:
        _POWERS[0] = tables
    return tables


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Polynomial prefix hashes modulo 2^64, n + 1 of them."""
    up, _ = power_tables(len(values) + 1)
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=out[1:])
    return out


def words(data: np.ndarray, bounds: np.ndarray, fold: bool = True
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text number, start and end of every word.

    Words are runs of bytes other than the six ASCII spaces; with ``fold`` A-Z
    count as a-z. Texts lie on end in ``data`` and a word never crosses two.
    """
    n = len(data)
    none = np.zeros(0, np.int64)
    if n == 0:
        return none.astype(np.uint64), none, none, none
    inside = ~SPACE[data]
    cut = np.zeros(n + 1, bool)
    cut[bounds] = True
    before = np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:n]))
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    sums = prefix_sums((FOLDED if fold else BYTES)[data])
    _, down = power_tables(n + 1)
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    texts = np.searchsorted(bounds, starts, "right") - 1
    return hashes, texts, starts, ends


def shingles(hashes: np.ndarray, texts: np.ndarray, n_texts: int,
             size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every shingle of ``size`` words, in order, with repeats.

    A text of fewer words has its whole sequence as its one shingle; a text
    without words has none.
    """
    factors = mix(np.arange(1, size + 2, dtype=np.uint64))
    counts = np.bincount(texts, minlength=n_texts)
    n = len(hashes)
    if n >= size:
        total = np.zeros(n - size + 1, np.uint64)
        for j in range(size):
            total += hashes[j:n - size + 1 + j] * factors[j]
        whole = texts[:n - size + 1] == texts[size - 1:]
        out, owner = mix(total[whole]), texts[:n - size + 1][whole]
    else:
        out, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        ends = np.cumsum(counts)
        extra = np.empty(len(short), np.uint64)
        for i, text in enumerate(short):
            own = hashes[ends[text] - counts[text]:ends[text]]
            extra[i] = np.append(own, np.uint64(len(own))) @ np.append(factors[:len(own)], factors[size])
        out, owner = np.concatenate([out, mix(extra)]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        out, owner = out[order], owner[order]
    return out, owner


def distinct_per_text(hashes: np.ndarray, owner: np.ndarray, n_texts: int
                      ) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each text, on end, and n_texts + 1 bounds."""
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    if len(hashes):
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        hashes, owner = hashes[new], owner[new]
    return hashes, np.searchsorted(owner, np.arange(n_texts + 1))


def text_bytes(frame: DataFrame, column: str = "text") -> int:
    """Bytes of all texts: one pass, for choosing how many partitions to use."""
    return frame.agg(F.coalesce(F.sum(F.octet_length(F.col(column).cast("string"))), F.lit(0))).first()[0]


def batch_of(schema: Iterable[tuple[str, pa.DataType]], *columns) -> pa.RecordBatch:
    fields = list(schema)
    arrays = [x if isinstance(x, pa.Array) else pa.array(x, kind) for x, (_, kind) in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])
