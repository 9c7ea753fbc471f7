"""Operator 7: token ids in files, each id in the vocabulary's minimum of bits.

A file row (a shard) holds whole documents: their ids on end, packed with a
fixed width. 64 ids take exactly ``width`` 64-bit little-endian words, so block
b starts at byte ``b * 8 * width``: that rule is the block index, and any id can
be read without those before it. Packing and unpacking are 64 vector
operations per call, whatever the number of ids.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from rivermart.llm import common, tokens

BLOCK = 64
PLAIN = {8: "<u1", 16: "<u2", 32: "<u4"}
#: Ids of a shard, unless one document alone has more.
SHARD_IDS = 1 << 20
SHARDS = ("part int, shard int, first long, width int, n long, doc_ids array<long>, "
          "ends array<long>, blocks binary")
ROWS = [("part", pa.int32()), ("shard", pa.int32()), ("first", pa.int64()), ("width", pa.int32()),
        ("n", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())),
        ("blocks", pa.binary())]


def width_of(vocabulary_size: int) -> int:
    """Bits that hold every id below ``vocabulary_size``."""
    return max(1, int(vocabulary_size - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Blocks of 64 ids in ``width`` words each; the last block is filled with zeros."""
    if not 1 <= width <= 32:
        raise ValueError("ids have 1 to 32 bits")
    if len(ids) and int(ids.max()) >> width:
        raise ValueError("an id does not fit into the width")
    n = -(-len(ids) // BLOCK)
    if width in PLAIN:  # whole bytes: the same layout is a plain array
        plain = np.zeros(n * BLOCK, PLAIN[width])
        plain[:len(ids)] = ids
        return plain.tobytes()
    square = np.zeros(n * BLOCK, np.uint64)
    square[:len(ids)] = ids
    square = np.ascontiguousarray(square.reshape(n, BLOCK).T)
    out = np.zeros((width, n), np.uint64)
    for i in range(BLOCK):
        word, shift = divmod(i * width, 64)
        out[word] |= square[i] << np.uint64(shift)
        if shift + width > 64:
            out[word + 1] |= square[i] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T).astype("<u8").tobytes()


def unpack(blocks: bytes, width: int, start: int, stop: int) -> np.ndarray:
    """Ids start to stop, reading only the blocks that hold them."""
    if stop <= start:
        return np.zeros(0, np.uint32)
    if width in PLAIN:
        return np.frombuffer(blocks, PLAIN[width], stop - start, start * width // 8).astype(np.uint32)
    low, high = start // BLOCK, -(-stop // BLOCK)
    square = np.frombuffer(blocks, "<u8", (high - low) * width, low * 8 * width)
    square = np.ascontiguousarray(square.reshape(high - low, width).T)
    mask = np.uint64((1 << width) - 1)
    out = np.empty((BLOCK, high - low), np.uint32)
    for i in range(BLOCK):
        word, shift = divmod(i * width, 64)
        value = square[word] >> np.uint64(shift)
        if shift + width > 64:
            value |= square[word + 1] << np.uint64(64 - shift)
        out[i] = value & mask
    return np.ascontiguousarray(out.T).ravel()[start - low * BLOCK:stop - low * BLOCK]


def write_shards(docs: DataFrame, path: str, vocabulary_path: str, end_id: int,
                 shard_ids: int = SHARD_IDS) -> None:
    """Encode ``docs`` (doc_id, text; a null text is empty) and write shards to ``path``.

    Rows are dealt by ranges of doc_id and sorted, so that the files in order
    of ``part`` and ``shard`` hold the ids in ascending doc_id order. Rows of an
    equal doc_id all stay; a null doc_id comes first. Other columns are ignored.
    An empty table gives no shard.
    """
    common.prepare(docs.sparkSession)

    def encode(batches):
        library = tokens.encoder(vocabulary_path)
        width = width_of(max(library.size, end_id + 1))
        part, shard, first = TaskContext.get().partitionId(), 0, 0
        ids, ends, names, n = [], [], [], 0
        end = np.array([end_id], "<u4").tobytes()

        def row():
            packed = pack(np.frombuffer(b"".join(ids), "<u4"), width)
            return common.batch_of(ROWS, [part], [shard], [first], [width], [n], [names], [ends], [packed])

        for batch in batches:
            keys = batch.column(0).to_pylist()
            _, bounds = common.utf8(batch.column(1))
            for low, high in common.chunks(bounds):
                texts = batch.column(1).slice(low, high - low).to_pylist()
                for key, made in zip(keys[low:high], library.encode([t or "" for t in texts])):
                    ids += (made, end)
                    n += len(made) // 4 + 1
                    ends.append(n)
                    names.append(key)
                    if n >= shard_ids:
                        yield row()
                        shard, first = shard + 1, first + n
                        ids, ends, names, n = [], [], [], 0
        if names:
            yield row()

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id"))
    common.map_arrow(ordered, encode, SHARDS).write.parquet(path)


def read_documents(shards: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and the crc32 of the ids, from shards."""
    # One row for each part of the files: few, whatever the data hold.
    parts = shards.groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    schema = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]

    def decode(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ends = np.array(row["ends"], np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                raw = unpack(row["blocks"], row["width"], 0, row["n"]).astype("<u4").tobytes()
                sums = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield common.batch_of(schema, row["doc_ids"], starts + row["base"] + row["first"], ends - starts, sums)

    return common.map_arrow(shards.join(F.broadcast(parts), "part"), decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_and_read(docs: DataFrame, path: str, vocabulary_path: str, end_id: int) -> DataFrame:
    """Write the files of ``docs`` below ``path`` and return what they hold per document."""
    write_shards(docs, path, vocabulary_path, end_id)
    return read_documents(docs.sparkSession.read.parquet(path))
