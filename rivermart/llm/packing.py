"""Operator 10: training sequences filled to the sources' token shares.

Every source is a queue of tokens, its documents in order of doc_id. A window of
``window`` tokens takes from each queue its target share; what rounding leaves over
is that queue's deficit and carries into the next window. When a queue runs dry, the
targets of the others are taken to whole again, so that every id is packed. The
deficits have a closed form: between two queues' ends, tokens are given in proportion
to the weights of the queues that are left, and the queues up to s have given the
floor of their part after k windows. So a queue is never a whole token behind or before
its share, every window is exactly full, and each partition knows the deficits
at its first window without having seen the windows before. Windows are cut into
sequences; only the last sequence of all is padded.

Sources that are due less than a token a window are one queue together. In it
the document that its source is owed first comes next: each carries its deficit over
the windows until a document is due.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, bisect_right
from fractions import Fraction
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from rivermart.llm import bitpack, common, tokens

LENGTH = 2048
#: Sequences of one window: the unit that is filled to the shares.
WINDOW_SEQUENCES = 8
DOCS = [("part", pa.int32()), ("source", pa.string()), ("doc_id", pa.int64()), ("first", pa.int64()),
        ("n", pa.int64()), ("width", pa.int32()), ("ids", pa.binary())]
PIECES = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
          ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("source", pa.string())]
PIECES_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
                 "sequence_id long, offset long, source string")


def encoded(docs: DataFrame, vocabulary_path: str, end_id: int) -> DataFrame:
    """Ids of every document with its place in its source's queue within its partition.

    Rows are dealt by ranges of (source, doc_id), so a source with a third of
    all rows fills many partitions.
    """

    def encode(batches):
        library = tokens.encoder(vocabulary_path)
        width = bitpack.width_of(max(library.size, end_id + 1))
        part, now, first = TaskContext.get().partitionId(), None, 0
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            _, bounds = common.utf8(batch.column(2))
            for low, high in common.chunks(bounds):
                piece = batch.slice(low, high - low)
                sources, names = piece.column(0).to_pylist(), piece.column(1).to_pylist()
                made = library.encode([t or "" for t in piece.column(2).to_pylist()])
                firsts, counts, packed = [], [], []
                for source, ids in zip(sources, made):
                    if source != now:
                        now, first = source, 0
                    n = len(ids) // 4 + 1
                    firsts.append(first)
                    counts.append(n)
                    packed.append(bitpack.pack(np.frombuffer(ids + end, "<u4"), width))
                    first += n
                yield common.batch_of(DOCS, [part] * len(names), sources, names, firsts, counts,
                                      [width] * len(names), packed)

    ordered = (docs.select(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
                           F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
               .repartitionByRange("source", "doc_id").sortWithinPartitions("source", "doc_id"))
    return common.map_arrow(ordered, encode, "part int, source string, doc_id long, first long, n long, width int, ids binary")


def weighed(sizes: DataFrame, targets: dict[str, float] | None) -> DataFrame:
    """Adds weight: the source's tokens, or its target in units of 2^-40. Sources
    without a target share by tokens what the targets leave of one."""
    if targets is None:
        return sizes.withColumn("weight", F.col("n"))
    if not targets or min(targets.values()) <= 0 or sum(targets.values()) > 1 + 1e-9:
        raise ValueError("targets are positive shares of one at most")
    wanted = sizes.sparkSession.createDataFrame(sorted(targets.items()), "source string, target double")
    sizes = common.stored(sizes.join(F.broadcast(wanted), "source", "left"), "packing-sizes")
    others = sizes.where("target is null").agg(F.sum("n")).first()[0]
    rest = 1 - sum(targets.values())
    if others and rest <= 1e-9:
        raise ValueError("sources without a target have no share left")
    share = F.coalesce("target", F.col("n") * F.lit(rest / (others or 1)))
    return sizes.select("source", "n", F.greatest(F.lit(1), F.round(share * float(1 << 40))).cast("long").alias("weight"))


def queues(rows: DataFrame, window: int, targets: dict[str, float] | None = None
           ) -> tuple[DataFrame, list[tuple[str, int, int, int]]]:
    """source, weight and queue of each source; and name, tokens, weight and sources of each queue.

    A source whose share is under one token a window cannot be served in each
    window; such sources form one queue, and join that of the source of most weight if
    together they are that small. There are at most ``window`` + 1 queues.
    """
    sizes = weighed(rows.groupBy("source").agg(F.sum("n").alias("n")), targets)
    weight = F.col("weight").cast("decimal(38,0)")
    total = sizes.agg(F.sum("weight").alias("whole"), F.max(F.struct("weight", "source"))["source"].alias("largest"))
    sizes = sizes.join(F.broadcast(total)).withColumn("tiny", weight * window < F.col("whole"))
    rest = sizes.agg(F.coalesce(F.sum(F.when(F.col("tiny"), F.col("weight"))), F.lit(0)).alias("rest"))
    alone = F.col("rest").cast("decimal(38,0)") * window >= F.col("whole")
    sizes = sizes.join(F.broadcast(rest)).select("source", "n", "weight", F.when(
        ~F.col("tiny"), F.concat(F.lit("s"), "source")).when(alone, F.lit("r")).otherwise(
        F.concat(F.lit("s"), "largest")).alias("queue"))
    sizes = common.stored(sizes, "packing-queues")
    found = sizes.groupBy("queue").agg(F.sum("n"), F.sum("weight"), F.count("*")).collect()
    return sizes.select("source", "weight", "queue"), sorted(map(tuple, found))


def placed(rows: DataFrame, members: DataFrame, table: list[tuple[str, int, int, int]]) -> DataFrame:
    """``rows`` with their queue and begin, the queue's tokens before them."""
    held = rows.groupBy("source", "part").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select("source", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("inside")).join(members, "source")
    # Of a table written, Spark knows the size: a small one is broadcast, and the ids are not shuffled again.
    held = common.stored(held, "packing-held")
    inside = (F.col("inside") + F.col("first")).alias("begin")
    several = [name for name, _, _, sources in table if sources > 1]
    columns = ["source", "doc_id", "n", "width", "ids", "queue"]
    if not several:
        return rows.join(held, ["source", "part"]).select(*columns, inside)
    shared = F.col("queue") == several[0]  # small sources are together in one queue
    alone = rows.join(held.where(~shared), ["source", "part"]).select(*columns, inside)
    # A document is due when its source is owed the half of it.
    order = ["due", "source", "part", "first"]
    due = rows.select("source", "part", "first", "n").join(held.where(shared), ["source", "part"]).select(
        "source", "part", "first", "n", "queue", ((F.col("inside") + F.col("first") + F.col("n") / 2) / F.col("weight")).alias("due"))
    due = common.stored(due.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "packing-due")
    ranges = due.groupBy("range").agg(F.sum("n").alias("n")).select("range", F.coalesce(F.sum("n").over(
        Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    before = F.sum("n").over(Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    due = due.withColumn("before", F.coalesce(before, F.lit(0))).join(F.broadcast(ranges), "range").select(
        "source", "part", "first", "queue", (F.col("base") + F.col("before")).alias("begin"))
    return alone.unionByName(rows.join(due, ["source", "part", "first"]).select(*columns, "begin"))


def phases(sizes: list[int], weights: list[int], queue: int) -> list[tuple[int, int, int, int, int, int, int]]:
    """Between the ends of queues: place of the phase's first token; tokens of the queues that have ended, and
    weight of the others; the same two of the queues before ``queue`` only, and of those up to it."""
    ends = [Fraction(n, w) for n, w in zip(sizes, weights)]
    out, gone, left = [], [0, 0, 0], [sum(weights), sum(weights[:queue]), sum(weights[:queue + 1])]
    at = 0
    for end, group in groupby(sorted(range(len(sizes)), key=ends.__getitem__), key=ends.__getitem__):
        # Windows begin at whole places, so the phase counts from the next one.
        out.append((math.ceil(at), gone[0], left[0], gone[1], left[1], gone[2], left[2]))
        at = gone[0] + left[0] * end
        for other in group:
            for i, counts in enumerate((True, other < queue, other <= queue)):
                if counts:
                    gone[i] += sizes[other]
                    left[i] -= weights[other]
    out.append((math.ceil(at), gone[0], left[0], gone[1], left[1], gone[2], left[2]))
    return out


def cuts_of(begin: int, end: int, parts: list[tuple[int, ...]], total: int, window: int, length: int, hint: int = 0
            ) -> tuple[list[tuple[int, int, int]], int]:
    """Pieces (position in the queue, sequence, offset) of the queue's tokens begin to end, and the last window.

    ``parts`` are the queue's phases. It has at least one token a window until its end, or there is one window.
    """
    starts = [part[0] for part in parts]

    def given(k):  # tokens that the queues before this one, and up to it, gave in k windows
        place = min(k * window, total)
        _, gone, left, low_gone, low, high_gone, high = parts[bisect_right(starts, place) - 1]
        if not left:
            return low_gone, high_gone
        return low_gone + (place - gone) * low // left, high_gone + (place - gone) * high // left

    own = lambda k: (lambda low, high: high - low)(*given(k))
    if not own(hint) <= begin < own(hint + 1):
        # The last window before which the queue gave no more than begin.
        hint = bisect_right(range(-(-total // window) + 1), begin, key=own) - 1
    out, k, at = [], hint, begin
    while at < end:
        (low, upto), (next_low, next_upto) = given(k), given(k + 1)
        mine, until = upto - low, next_upto - next_low
        if until > at:
            # Place in the window: behind the tokens of the queues before this one.
            place = k * window + (next_low - low) + (at - mine)
            stop = place + min(until, end) - at
            while place < stop:
                sequence, offset = divmod(place, length)
                step = min(stop, (sequence + 1) * length) - place
                out.append((at, sequence, offset))
                at, place = at + step, place + step
        if at < end:
            k += 1
    return out, k


def cuts(begin: int, end: int, below: int, size: int, total: int, window: int, length: int
         ) -> list[tuple[int, int, int]]:
    """Pieces of a queue's tokens where all queues end together."""
    return cuts_of(begin, end, [(0, 0, total, 0, below, 0, below + size)], total, window, length)[0]


def pack_documents(docs: DataFrame, vocabulary_path: str, end_id: int = 1, length: int = LENGTH,
                   window_sequences: int = WINDOW_SEQUENCES, targets: dict[str, float] | None = None) -> DataFrame:
    """One row per piece of a document: where its ids lie, and their crc32.

    A null text is empty and still has its end id; a null source is the queue
    ''. ``targets`` are shares of tokens by source, by default those of the
    corpus; sources without one share by tokens what the others leave. Rows of an equal doc_id are packed one after the other. Other columns
    are ignored; an empty table gives no piece.
    """
    common.prepare(docs.sparkSession)
    rows = common.stored(encoded(docs, vocabulary_path, end_id), "packing")
    window = length * window_sequences

    members, table = queues(rows, window, targets)
    names, sizes, weights = ([q[i] for q in table] for i in range(3))
    total = sum(sizes)

    def pieces(batches):
        known, hints = {}, {}
        for batch in batches:
            out = [[] for _ in PIECES]
            for row in batch.to_pylist():
                begin, queue = row["begin"], row["queue"]
                if queue not in known:
                    known[queue] = phases(sizes, weights, bisect_left(names, queue))
                found, hints[queue] = cuts_of(begin, begin + row["n"], known[queue], total, window, length, hints.get(queue, 0))
                raw = bitpack.unpack(row["ids"], row["width"], 0, row["n"]).astype("<u4").tobytes()
                starts = [at - begin for at, _, _ in found] + [row["n"]]
                for i, (_, sequence, offset) in enumerate(found):
                    a, b = starts[i], starts[i + 1]
                    for column, value in zip(out, (row["doc_id"], a, b - a, zlib.crc32(raw[4 * a:4 * b]),
                                                   row["n"], sequence, offset, row["source"])):
                        column.append(value)
            yield common.batch_of(PIECES, *out)

    return common.map_arrow(placed(rows, members, table), pieces, PIECES_SCHEMA)
