"""Operator 4: fingerprints of every shingle hash below a fixed share of all hashes.

A hash is kept or not whatever else its text holds, so the sketch of a union is
the union of the sketches, a short text's sketch can be looked up in a very long
one's, and containment as well as Jaccard are ratios of counts.

A fingerprint is text: 16 hex digits that sum up the whole set (equal sets only),
a dash, and the kept hashes in order, 16 hex digits each.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rivermart.llm import common

#: One in so many hashes is kept.
KEEP_ONE_IN = 4
#: Ranges of doc_id for each shuffle partition.
RANGES = 4
RESULT = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
          ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
          ("near_next", pa.float64()), ("contained_edited", pa.float64()), ("contained_next", pa.float64())]
RESULT_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                 "near_edited double, near_next double, contained_edited double, contained_next double")


def sketches(texts: list[str], keep_one_in: int = KEEP_ONE_IN, size: int = common.SHINGLE_WORDS
             ) -> list[tuple[int, np.ndarray]]:
    """Sum over all distinct shingles and sorted kept hashes of each text."""
    data, bounds = common.utf8(pa.array(texts, pa.large_string()))
    out: list[tuple[int, np.ndarray]] = []
    for low, high in common.chunks(bounds):
        own = bounds[low:high + 1] - bounds[low]
        hashes, owner, _, _ = common.words(data[bounds[low]:bounds[high]], own)
        hashes, at = common.distinct_per_text(*common.shingles(hashes, owner, high - low, size), high - low)
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(common.mix(hashes + np.uint64(1)), out=sums[1:])
        limit = np.uint64((1 << 64) // keep_one_in - 1)
        small = hashes <= limit
        kept, ends = hashes[small], np.concatenate([[0], np.cumsum(small)])
        whole = sums[at[1:]] - sums[at[:-1]]
        out += [(int(whole[i]), kept[ends[at[i]]:ends[at[i + 1]]]) for i in range(high - low)]
    return out


def written(sketch: tuple[int, np.ndarray]) -> str:
    return f"{sketch[0]:016x}-{sketch[1].astype('>u8').tobytes().hex()}"


def read(fingerprint: str) -> tuple[int, np.ndarray]:
    whole, _, kept = fingerprint.partition("-")
    return int(whole, 16), np.frombuffer(bytes.fromhex(kept), ">u8").astype(np.uint64)


def merged(one: str, other: str) -> str:
    """The fingerprint's hashes for both texts' shingles together; the sum of the set is not known."""
    return written((0, np.union1d(read(one)[1], read(other)[1])))


def likeness(one: tuple[int, np.ndarray], other: tuple[int, np.ndarray]) -> tuple[float, float]:
    """Estimated Jaccard of two sets, and the share of the first that is in the second.

    Without kept hashes, sets of equal sums count as alike and others as apart.
    """
    a, b = one[1], other[1]
    if one[0] == other[0] and len(a) == len(b):
        return 1.0, 1.0
    both = len(np.intersect1d(a, b, assume_unique=True)) if len(a) and len(b) else 0
    return both / max(1, len(a) + len(b) - both), both / max(1, len(a))


def _compared(rows: list[tuple[int | None, str, str]], keep_one_in: int) -> pa.RecordBatch:
    """Result rows of (doc_id, text, next text)."""
    edited = [t[:len(t) - len(t) // 2] + after[:len(t) // 2] for _, t, after in rows]
    mine = sketches([t for _, t, _ in rows], keep_one_in)
    changed = sketches(edited, keep_one_in)
    # The next text is mostly the next row's own.
    n = len(rows)
    odd = [i for i in range(n) if i + 1 == n or rows[i][2] is not rows[i + 1][1]]
    nexts = mine[1:] + [(0, mine[0][1])] if n else []
    for i, sketch in zip(odd, sketches([rows[i][2] for i in odd], keep_one_in)):
        nexts[i] = sketch
    to_edited = [likeness(a, b) for a, b in zip(mine, changed)]
    to_next = [likeness(a, b) for a, b in zip(mine, nexts)]
    return common.batch_of(
        RESULT, [key for key, _, _ in rows], [len(t) for _, t, _ in rows],
        [hashlib.sha256(t.encode()).hexdigest() for t in edited], [written(s) for s in mine],
        [written(s) for s in changed], [x for x, _ in to_edited], [x for x, _ in to_next],
        [x for _, x in to_edited], [x for _, x in to_next])


def fingerprints(docs: DataFrame, keep_one_in: int = KEEP_ONE_IN) -> DataFrame:
    """Fingerprint each row of ``docs`` (doc_id, text), its edited text, and compare with the next.

    Rows follow each other in descending order of doc_id, a null doc_id last and
    rows of an equal doc_id by text; after the last comes the first. The edited
    text has the row's last floor(n / 2) code points replaced by the next text's
    first as many, or all it has. A null text is empty. Shingles are of five
    words, A-Z as a-z; other columns are ignored; an empty table gives no row.

    Rows meet their successors inside ranges of doc_id, each sorted in one task;
    only the first and last row of a range are joined across.
    """
    spark = docs.sparkSession
    common.prepare(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = parts * RANGES
    marks = [i / n for i in range(1, n)]
    bounds = rows.agg(F.percentile_approx("doc_id", marks, max(10_000, 10 * n))).first()[0] or []
    bounds = np.array(sorted(set(bounds)), np.int64)

    @F.pandas_udf("long")
    def range_of(ids):
        ids = ids.astype("Int64")
        found = np.searchsorted(bounds, ids.fillna(0).to_numpy(np.int64), "right")
        return ids.where(ids.isna(), found.astype("int64")).fillna(-1).astype("int64")

    dealt = (rows.withColumn("range", range_of("doc_id")).repartition(parts, "range")
             .sortWithinPartitions(F.desc("range"), F.desc_nulls_last("doc_id"), "text"))

    def inside(batches):
        waiting: list[tuple[int | None, str, int]] = []
        size = 0

        def ready():
            """Rows whose successor in their range is there; the last one stays."""
            nonlocal waiting, size
            done = [(k, t, waiting[i + 1][1]) for i, (k, t, r) in enumerate(waiting[:-1]) if waiting[i + 1][2] == r]
            waiting, size = waiting[-1:], 0
            return done

        for batch in batches:
            for key, text, number in zip(*(batch.column(i).to_pylist() for i in range(3))):
                waiting.append((key, text, number))
                size += len(text)
                if size >= common.CHUNK_BYTES and (done := ready()):
                    yield _compared(done, keep_one_in)
        if done := ready():
            yield _compared(done, keep_one_in)

    ends = [("doc_id", pa.int64()), ("text", pa.string()), ("range", pa.int64()), ("first", pa.bool_())]

    def edges(batches):
        last = None
        for batch in batches:
            numbers = batch.column(2).to_numpy(zero_copy_only=False)
            for i in np.flatnonzero(np.diff(numbers, prepend=numbers[0] - 1 if last is None else last[2])):
                if last is not None and i == 0:
                    yield common.batch_of(ends, [last[0]], [last[1]], [last[2]], [False])
                elif i:
                    yield common.batch_of(ends, *([batch.column(c)[int(i) - 1].as_py()] for c in range(3)), [False])
                yield common.batch_of(ends, *([batch.column(c)[int(i)].as_py()] for c in range(3)), [True])
            last = [batch.column(c)[len(numbers) - 1].as_py() for c in range(3)]
        if last is not None:
            yield common.batch_of(ends, *([x] for x in last), [False])

    whole = common.map_arrow(dealt, inside, RESULT_SCHEMA)
    edge = common.map_arrow(dealt, edges, "doc_id long, text string, range long, first boolean")
    firsts = edge.where("first").select("range", F.col("text").alias("after"))
    # At most as many ranges as bounds: numbers only, no texts.
    order = Window.orderBy(F.desc("range"))
    top = F.max("range").over(Window.orderBy(F.desc("range")).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing))
    follows = firsts.select("range").select(
        "range", F.coalesce(F.lead("range").over(order), top).alias("following"))
    lasts = edge.where("not first").join(follows, "range").join(
        firsts.withColumnRenamed("range", "following"), "following").select("doc_id", "text", "after")

    def across(batches):
        for batch in batches:
            yield _compared(list(zip(*(batch.column(i).to_pylist() for i in range(3)))), keep_one_in)

    return whole.union(common.map_arrow(lasts, across, RESULT_SCHEMA))
