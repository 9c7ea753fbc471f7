"""Operator 6: remove bytes of passages that a document with a smaller doc_id has too.

A string of ``width`` bytes is found twice by sorting suffixes. Two suffixes are
compared by their common extension: polynomial prefix hashes tell whether two
substrings are equal, and binary search over the length finds how far they
agree, so a comparison costs log(width) steps. A bottom-up mergesort uses that
comparison for all elements of a level at once. Neighbours that agree in
``width`` bytes are then compared byte by byte; should hashes have collided, the
task sorts by the bytes themselves.

Not every suffix has to travel. The string's smallest ``gram``-hash (leftmost on
ties) is its anchor: equal strings have equal anchors at equal offsets, so
suffixes are dealt by anchor, and an anchor seen in one document only is dropped
before any text is sent. Documents of equal text are one text. Occurrences of an
anchor with the same surroundings are one element of the sort.

Texts are dealt once, by document, and all three passes over them (anchors,
surroundings, cutting) read that one shuffle. What the passes send each other is
packed: see ``pack``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType

from rivermart.llm import common

WIDTH = 50
GRAM = 16
PARTITION_BYTES = 24 << 20
SEND_ANCHORS = 1 << 20
SEND_CONTEXTS = 1 << 17
KEYED = [("part", pa.int32()), ("n", pa.int32()), ("packed", pa.binary())]
KEYED_SCHEMA = "part int, n int, packed binary"
DONE = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
        ("kept_sha256", pa.string())]


class Anchors:
    """Anchors of a run of texts: where they lie and which strings they stand for."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, width: int, gram: int):
        n = len(data)
        self.at = self.first = self.count = self.text = np.zeros(0, np.int64)
        self.hash = np.zeros(0, np.uint64)
        if n < width:
            return
        sums = common.prefix_sums(common.BYTES[data])
        _, down = common.power_tables(n + 1)
        grams = common.mix((sums[gram:] - sums[:-gram]) * down[:n - gram + 1])
        places = max(21, int(n).bit_length())
        best = (grams >> np.uint64(places) << np.uint64(places)) | np.arange(len(grams), dtype=np.uint64)
        span, have = width - gram + 1, 1
        while 2 * have <= span:
            best = np.minimum(best[:-have], best[have:])
            have *= 2
        if span > have:
            best = np.minimum(best[:-(span - have)], best[span - have:])
        at = (best & np.uint64((1 << places) - 1)).astype(np.int64)
        inside = np.zeros(n + 1, np.int32)
        low, high = bounds[:-1], bounds[1:] - width + 1
        real = high > low
        np.add.at(inside, low[real], 1)
        np.add.at(inside, high[real], -1)
        starts = np.flatnonzero(np.cumsum(inside[:len(at)]) > 0)
        if not len(starts):
            return
        at, text = at[starts], np.searchsorted(bounds, starts, "right") - 1
        new = np.ones(len(starts), bool)
        new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
        begin = np.flatnonzero(new)
        self.at, self.first, self.text = at[begin], starts[begin], text[begin]
        self.count = np.diff(np.append(begin, len(starts)))
        self.hash = grams[self.at]


def pieces(data: np.ndarray, bounds: np.ndarray, width: int, limit: int = common.CHUNK_BYTES
           ) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """Parts (bytes, bounds, first text, place of the first byte in it); a very long text
    comes in parts that overlap by width - 1 bytes, so that each string is in one part."""
    for low, high in common.chunks(bounds, limit):
        a, b = int(bounds[low]), int(bounds[high])
        if b - a <= 2 * limit:
            yield data[a:b], bounds[low:high + 1] - a, low, 0
        else:
            for s in range(a, max(a + 1, b - width + 1), limit):
                e = min(b, s + limit + width - 1)
                yield data[s:e], np.array([0, e - s]), low, s - a


def pack(numbers: np.ndarray) -> bytes:
    """Rows of int64 in few bytes: the first column as differences, then by byte planes, compressed."""
    rows = np.array(numbers, np.int64, order="C")
    rows[1:, 0] -= numbers[:-1, 0]
    planes = np.ascontiguousarray(rows.view(np.uint8).T)
    return pa.compress(planes, codec="zstd", asbytes=True)


def unpack(packed: bytes, n: int, columns: int) -> np.ndarray:
    planes = pa.decompress(packed, decompressed_size=n * columns * 8, codec="zstd", asbytes=True)
    rows = np.array(np.frombuffer(planes, np.uint8).reshape(columns * 8, n).T, order="C").view(np.int64)
    rows[:, 0] = np.cumsum(rows[:, 0])
    return rows


def tags(hashes: np.ndarray) -> np.ndarray:
    """32 bits of an anchor's hash: an anchor taken for a repeated one by them is sent in vain, none is lost."""
    return (hashes >> np.uint64(32)).astype(np.int64)


def keyed_rows(numbers: np.ndarray, parts: int, shape: list = KEYED) -> Iterator[pa.RecordBatch]:
    """Rows (part, n, packed) for int64 rows [n, 3] of two keys and a value, dealt by key."""
    bucket = (common.mix(numbers[:, 0].view(np.uint64) * np.uint64(3) + numbers[:, 1].view(np.uint64))
              % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((numbers[:, 0], bucket))
    ends = np.searchsorted(bucket[order], np.arange(parts + 1))
    for i in np.flatnonzero(np.diff(ends)):
        some = numbers[order[ends[i]:ends[i + 1]]]
        yield common.batch_of(shape, [int(i)], [len(some)], [pack(some)])


def per_key(rows: DataFrame, parts: int, finish: Callable[[np.ndarray], bytes]) -> DataFrame:
    """One row (k1, k2, values) per key from keyed rows; ``finish`` makes the values' bytes."""
    kinds = [("k1", pa.int64()), ("k2", pa.int64()), ("values", pa.binary())]

    def gather(batches):
        got = [unpack(r["packed"], r["n"], 3) for b in batches for r in b.to_pylist()]
        if not got:
            return
        numbers = np.concatenate(got)
        numbers = numbers[np.lexsort((numbers[:, 1], numbers[:, 0]))]
        new = np.ones(len(numbers), bool)
        new[1:] = (numbers[1:, :2] != numbers[:-1, :2]).any(axis=1)
        begin = np.append(np.flatnonzero(new), len(numbers))
        for i in range(0, len(begin) - 1, 1000):
            some = begin[i:i + 1001]
            yield common.batch_of(kinds, numbers[some[:-1], 0], numbers[some[:-1], 1],
                                  [finish(numbers[a:b, 2]) for a, b in zip(some[:-1], some[1:])])

    return common.map_arrow(rows.repartition(parts, "part"), gather, "k1 long, k2 long, values binary")


def repeated_anchors(texts: DataFrame, parts: int, width: int, gram: int) -> DataFrame:
    """doc_id and the tags of anchors that the document shares with another, from (doc_id, text).

    Within what a task has gathered, an anchor of several documents is known to
    repeat and goes on once, so a very common one is no large group.
    """
    shape = [("part", pa.int32()), ("n", pa.int32()), ("packed", pa.binary()), ("known", pa.bool_())]

    def send(batches):
        held, count = [], 0

        def rows():
            hashes = np.concatenate([h for h, _ in held])
            docs = np.concatenate([k for _, k in held])
            order = np.lexsort((docs, hashes))
            hashes, docs = hashes[order], docs[order]
            same_hash = np.zeros(len(hashes), bool)
            same_hash[1:] = hashes[1:] == hashes[:-1]
            same = same_hash.copy()
            same[1:] &= docs[1:] == docs[:-1]
            hashes, docs, same_hash = hashes[~same], docs[~same], same_hash[~same]
            group = np.cumsum(~same_hash) - 1
            several = (np.bincount(group) > 1)[group]
            bucket = (hashes % np.uint64(parts)).astype(np.int64)
            numbers = np.stack([docs, tags(hashes)], axis=1)
            for known, pick in ((True, several), (False, ~same_hash)):
                at = np.flatnonzero(pick)
                at = at[np.lexsort((docs[at], bucket[at]))]
                ends = np.searchsorted(bucket[at], np.arange(parts + 1))
                for i in np.flatnonzero(np.diff(ends)):
                    some = numbers[at[ends[i]:ends[i + 1]]]
                    yield common.batch_of(shape, [int(i)], [len(some)], [pack(some)], [known])

        for batch in batches:
            docs = batch.column(0).to_numpy()
            for data, bounds, low, _ in pieces(*common.utf8(batch.column(1)), width):
                found = Anchors(data, bounds, width, gram)
                held.append((found.hash, docs[found.text + low]))
                count += len(found.hash)
                if count >= SEND_ANCHORS:
                    yield from rows()
                    held, count = [], 0
        if count:
            yield from rows()

    def meet(batches):
        got, settled = [], []
        for batch in batches:
            for row in batch.to_pylist():
                (settled if row["known"] else got).append(unpack(row["packed"], row["n"], 2))
        if not got:  # every settled anchor comes with one row that is not
            return
        numbers = np.concatenate(got)
        numbers = numbers[np.lexsort((numbers[:, 0], numbers[:, 1]))]
        docs, names = numbers[:, 0], numbers[:, 1]
        same = names[1:] == names[:-1]
        again = np.append(False, same & (docs[1:] == docs[:-1]))
        other = same & ~again[1:]
        group = np.append(0, np.cumsum(~same))
        mixed = np.zeros(group[-1] + 1, bool)
        mixed[group[1:][other]] = True
        # What a task has found to repeat stays so, whoever else has the anchor.
        shared = np.concatenate([numbers[mixed[group] & ~again], *settled])
        yield from keyed_rows(np.stack([shared[:, 0], np.zeros(len(shared), np.int64), shared[:, 1]], axis=1), parts)

    sent = common.map_arrow(texts, send, "part int, n int, packed binary, known boolean")
    met = common.map_arrow(sent.repartition(parts, "part"), meet, KEYED_SCHEMA)
    return per_key(met, parts, lambda values: values.astype(np.uint32).tobytes()).select(F.col("k1").alias("doc_id"), "values")


def context_rows(texts: DataFrame, parts: int, width: int, gram: int) -> DataFrame:
    """Surroundings of repeated anchors, dealt by anchor, from (doc_id, variant, text, values)."""
    full = 2 * width - gram
    shape = [("part", pa.int32()), ("n", pa.int32()), ("numbers", pa.binary()), ("contexts", pa.binary())]

    def send(batches):
        held, count = [], 0

        def rows():
            hashes, numbers, contexts = (np.concatenate(x) for x in zip(*held))
            bucket = (hashes % np.uint64(parts)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[order], np.arange(parts + 1))
            for i in np.flatnonzero(np.diff(ends)):
                at = order[ends[i]:ends[i + 1]]
                yield common.batch_of(shape, [int(i)], [len(at)], [pack(numbers[at])],
                                      [pa.compress(contexts[at], codec="zstd", asbytes=True)])

        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(2)], axis=1)
            wanted = np.unique(np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint32))
            for data, bounds, low, place in pieces(*common.utf8(batch.column(2)), width):
                found = Anchors(data, bounds, width, gram)
                if not len(found.hash) or not len(wanted):
                    continue
                own = tags(found.hash)
                pick = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, own), len(wanted) - 1)] == own)
                for some in np.array_split(pick, -(-len(pick) // SEND_CONTEXTS)) if len(pick) else ():
                    first, number, text = found.first[some], found.count[some], found.text[some]
                    length = number + width - 1
                    spread = first[:, None] + np.arange(full)
                    contexts = np.where(np.arange(full) < length[:, None], data[np.minimum(spread, len(data) - 1)], 0)
                    # doc_id, variant, first string's place, number of strings, anchor's place from the first
                    numbers = np.stack([keys[text + low, 0], keys[text + low, 1], first - bounds[text] + place,
                                        number, found.at[some] - first], axis=1).astype(np.int64)
                    held.append((found.hash[some], numbers, contexts.astype(np.uint8)))
                    count += len(some)
                    if count >= SEND_CONTEXTS:
                        yield from rows()
                        held, count = [], 0
        if count:
            yield from rows()

    sent = common.map_arrow(texts, send, "part int, n int, numbers binary, contexts binary")
    return sent.repartition(parts, "part")


def unpack_contexts(row: dict, width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hashes, numbers and surroundings of a row of ``context_rows``."""
    numbers, full = unpack(row["numbers"], row["n"], 5), 2 * width - gram
    raw = pa.decompress(row["contexts"], decompressed_size=row["n"] * full, codec="zstd", asbytes=True)
    contexts = np.frombuffer(raw, np.uint8).reshape(-1, full)
    up, _ = common.power_tables(gram + 1)
    sums = np.zeros(len(contexts), np.uint64)
    for j in range(gram):
        sums += common.BYTES[contexts[np.arange(len(contexts)), numbers[:, 4] + j]] * up[j]
    return common.mix(sums), numbers, contexts


class Suffixes:
    """Strings of ``width`` bytes at (row, start) of a matrix of bytes, compared by prefix hashes."""

    def __init__(self, rows: np.ndarray, width: int):
        self.rows, self.width = rows, width
        up, down = common.power_tables(rows.shape[1] + 1)
        self.down = down[:rows.shape[1] + 1]
        self.sums = np.zeros((len(rows), rows.shape[1] + 1), np.uint64)
        np.cumsum(common.BYTES[rows] * up[:rows.shape[1]], axis=1, out=self.sums[:, 1:])

    def hashes(self, row: np.ndarray, start: np.ndarray, length) -> np.ndarray:
        return (self.sums[row, start + length] - self.sums[row, start]) * self.down[start]

    def agree(self, a: tuple, b: tuple) -> np.ndarray:
        """Length of the common extension of two lists of suffixes, up to ``width``."""
        low = np.zeros(len(a[0]), np.int64)
        high = np.full(len(a[0]), self.width, np.int64)
        for _ in range(int(self.width).bit_length()):
            middle = (low + high + 1) // 2
            same = self.hashes(*a, middle) == self.hashes(*b, middle)
            low, high = np.where(same, middle, low), np.where(same, high, np.maximum(middle - 1, low))
        return low

    def before(self, a: tuple, b: tuple, or_equal: np.ndarray) -> np.ndarray:
        """Whether a sorts before b; equal ones count as ``or_equal`` says."""
        n = self.agree(a, b)
        at = np.minimum(n, self.width - 1)
        x, y = self.rows[a[0], a[1] + at], self.rows[b[0], b[1] + at]
        return np.where(n >= self.width, or_equal, x < y)

    def mergesort(self, group: np.ndarray, row: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Order of the suffixes by (group, string); ``group`` ascends already."""
        n = len(group)
        order = np.arange(n)
        begin = np.searchsorted(group, group, "left")
        size = np.searchsorted(group, group, "right") - begin
        inside = np.arange(n) - begin
        run = 1
        while n and run < size.max():
            block = inside // run
            other = (block ^ 1) * run
            active = np.flatnonzero(other < size)
            low = begin[active] + other[active]
            high = begin[active] + np.minimum(other[active] + run, size[active])
            first, mine = low.copy(), order[active]
            # A tie keeps the element of the left run in front.
            right = (block[active] & 1).astype(bool)
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) // 2
                there, here = order[middle], mine[open_]
                less = self.before((row[there], start[there]), (row[here], start[here]), right[open_])
                low[open_] = np.where(less, middle + 1, low[open_])
                high[open_] = np.where(less, high[open_], middle)
            merged = order.copy()
            pair = begin[active] + (block[active] // 2) * 2 * run
            merged[pair + (inside[active] % run) + (low - first)] = mine
            order = merged
            run *= 2
        return order


def classes_of(suffixes: Suffixes, group: np.ndarray, row: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of the suffixes and, along it, the number of each one's class of equal strings."""
    order = suffixes.mergesort(group, row, start)
    a, b = (row[order[:-1]], start[order[:-1]]), (row[order[1:]], start[order[1:]])
    near = group[order[1:]] == group[order[:-1]]
    equal = near & (suffixes.agree(a, b) >= suffixes.width)
    at = np.flatnonzero(equal)
    reach = np.arange(suffixes.width)
    for some in np.array_split(at, len(at) // 50_000 + 1):
        x = suffixes.rows[a[0][some][:, None], a[1][some][:, None] + reach]
        y = suffixes.rows[b[0][some][:, None], b[1][some][:, None] + reach]
        if not (x == y).all():  # hashes collided: sort by the bytes
            every = suffixes.rows[row[:, None], start[:, None] + reach]
            names = np.unique(np.ascontiguousarray(every).view(f"V{suffixes.width}").ravel(), return_inverse=True)[1]
            order = np.lexsort((names, group))
            equal = (group[order[1:]] == group[order[:-1]]) & (names[order[1:]] == names[order[:-1]])
            break
    return order, np.append(0, np.cumsum(~equal)) if len(order) else np.zeros(0, np.int64)


def found_again(hashes: np.ndarray, numbers: np.ndarray, contexts: np.ndarray, width: int
                ) -> np.ndarray:
    """Rows (doc_id, variant, span = place << 24 | length) of strings that a smaller doc_id has too."""
    doc, number, offset = numbers[:, 0], numbers[:, 3], numbers[:, 4]
    # Occurrences with the same surroundings are one element, with the smallest doc_id.
    up, _ = common.power_tables(contexts.shape[1] + 2)
    name = common.mix((common.BYTES[contexts] * up[:contexts.shape[1]]).sum(axis=1)
                      + (number * 256 + offset).astype(np.uint64))
    for attempt in range(2):
        order = np.lexsort((doc, name, hashes))
        new = np.ones(len(order), bool)
        new[1:] = (hashes[order[1:]] != hashes[order[:-1]]) | (name[order[1:]] != name[order[:-1]])
        element = np.cumsum(new) - 1
        chief = order[np.flatnonzero(new)]
        same = (contexts[order] == contexts[chief[element]]).all(axis=1) \
            & (numbers[order, 3:] == numbers[chief[element], 3:]).all(axis=1)
        if same.all():
            break
        both = np.concatenate([contexts, number[:, None].astype(np.uint8), offset[:, None].astype(np.uint8)], axis=1)
        both = np.ascontiguousarray(both)
        name = np.unique(both.view(f"V{both.shape[1]}").ravel(), return_inverse=True)[1].astype(np.uint64)
    least = doc[chief]
    later = doc[order] > least[element]
    keys = [numbers[order[later], :2]]
    places, lengths = [numbers[order[later], 2]], [number[order[later]] + width - 1]

    # Elements of an anchor with several surroundings: sort their strings.
    hash_of = hashes[chief]
    several = np.zeros(len(chief), bool)
    several[1:] = hash_of[1:] == hash_of[:-1]
    several[:-1] |= several[1:].copy()
    some = np.flatnonzero(several)
    if len(some):
        suffixes = Suffixes(contexts[chief[some]], width)
        counts = number[chief[some]]
        row = np.repeat(np.arange(len(some)), counts)
        start = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        # Equal strings have the anchor at the same offset.
        anchor = np.unique(hash_of[some], return_inverse=True)[1]
        group = anchor[row] * 256 + offset[chief[some]][row] - start
        # Equal strings have equal hashes: strings alone with theirs need no sorting.
        whole = suffixes.hashes(row, start, width)
        by = np.lexsort((whole, group))
        group, row, start, whole = group[by], row[by], start[by], whole[by]
        twin = np.zeros(len(by), bool)
        twin[1:] = (group[1:] == group[:-1]) & (whole[1:] == whole[:-1])
        twin[:-1] |= twin[1:].copy()
        group, row, start = group[twin], row[twin], start[twin]
        if len(row):
            by, equal = classes_of(suffixes, group, row, start)
            row, start = row[by], start[by]
            docs = least[some][row]
            smallest = np.full(equal[-1] + 1, np.iinfo(np.int64).max)
            np.minimum.at(smallest, equal, docs)
            again = np.flatnonzero(docs > smallest[equal])
            # The verdict holds for all occurrences of the element in its own document.
            row, start = some[row[again]], start[again]
            begin = np.append(np.flatnonzero(new), len(order))
            mine = begin[row]
            end = begin[row + 1]
            while len(mine):
                here = order[mine]
                own = doc[here] == least[row]
                keys.append(numbers[here[own], :2])
                places.append(numbers[here[own], 2] + start[own])
                lengths.append(np.full(int(own.sum()), width))
                mine = mine + 1
                go = own & (mine < end)
                mine, row, start, end = mine[go], row[go], start[go], end[go]
    spans = (np.concatenate(places) << 24) | np.concatenate(lengths)
    return np.concatenate([np.concatenate(keys), spans[:, None]], axis=1)


def joined_spans(values: np.ndarray) -> np.ndarray:
    """Maximal runs [start, end) of overlapping or touching spans."""
    values = np.sort(values)
    starts = values >> 24
    ends = np.maximum.accumulate(starts + (values & ((1 << 24) - 1)))
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > ends[:-1]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1) if len(starts) else np.zeros(0, np.int64)
    return np.stack([starts[new], ends[last]], axis=1)


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_bytes, n_removed, n_spans and kept_sha256.

    Removed is every byte of a ``width``-byte string (UTF-8) that also starts in
    a document with a smaller doc_id; matches never cross documents. A null text
    is empty. Rows of an equal doc_id never remove from each other; a row
    without doc_id takes no part and keeps all. With ``with_text`` the kept
    bytes come too (``kept``, binary). Other columns are ignored; an empty table
    gives no row.
    """
    spark = docs.sparkSession
    common.prepare(spark)
    # A cast to the type it has would leave an alias that Spark drops in some places only: two shuffles for one.
    doc_id = F.col("doc_id") if docs.schema["doc_id"].dataType == LongType() else F.col("doc_id").cast("long").alias("doc_id")
    rows = docs.select(doc_id, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit(1), "text")})
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), common.text_bytes(rows) // PARTITION_BYTES + 1)
    whole, keys = rows.where(F.col("doc_id").isNotNull()), ["doc_id", "k1", "k2"]
    names = whole.select(keys).distinct()
    first = names.groupBy("k1", "k2").agg(F.min("doc_id").alias("chief"))
    # A document's texts, if its doc_id has several, are told apart by k2.
    texts = names.groupBy("doc_id").agg((F.count(F.lit(1)) > 1).alias("several"))
    info = names.join(first, ["k1", "k2"]).join(texts, "doc_id").select(
        *keys, (F.col("doc_id") > F.col("chief")).alias("copy"),
        F.when(F.col("several"), F.col("k2")).otherwise(F.lit(0).cast("long")).alias("variant"))
    info = common.stored(info, "suffix-names")
    chiefs = info.where("not copy").drop("copy")

    # Every pass joins this same frame, with no filter of its own, so Spark shuffles the texts once.
    dealt = whole.repartition(parts, *keys)
    shared = repeated_anchors(dealt.join(chiefs, keys).select("doc_id", "text"), parts, width, gram)
    anchored = dealt.join(chiefs.join(shared, "doc_id"), keys)
    sent = context_rows(anchored.select("doc_id", "variant", "text", "values"), parts, width, gram)

    def sort(batches):
        got = [unpack_contexts(r, width, gram) for b in batches for r in b.to_pylist()]
        if not got:
            return
        hashes, numbers, contexts = (np.concatenate(x) for x in zip(*got))
        # Some anchors at a time: their strings take many times the room of their surroundings.
        order = np.argsort(hashes, kind="stable")
        cut = np.flatnonzero(np.diff(hashes[order])) + 1
        low, found = 0, []
        while low < len(order):
            at = np.searchsorted(cut, low + SEND_CONTEXTS // 4)
            high = int(cut[at]) if at < len(cut) else len(order)
            some = order[low:high]
            found.append(found_again(hashes[some], numbers[some], contexts[some], width))
            low = high
        yield from keyed_rows(np.concatenate(found), parts)

    runs = per_key(common.map_arrow(sent, sort, KEYED_SCHEMA), parts, lambda values: joined_spans(values).tobytes()).select(
        F.col("k1").alias("doc_id"), F.col("k2").alias("variant"), F.col("values").alias("runs"))
    marks = info.join(runs, ["doc_id", "variant"], "left").drop("variant")
    shape = [*DONE, ("kept", pa.binary())] if with_text else DONE

    def cut_out(batches):
        for batch in batches:
            keys, out = batch.column(0).to_pylist(), [[] for _ in shape]
            for i, key in enumerate(keys):
                raw = (batch.column(1)[i].as_py() or "").encode()
                runs = np.zeros((0, 2), np.int64)
                if batch.column(2)[i].as_py() and len(raw) >= width:
                    runs = np.array([[0, len(raw)]])
                elif (found := batch.column(3)[i].as_py()) is not None:
                    runs = np.frombuffer(found, np.int64).reshape(-1, 2)
                at, left = 0, []
                for a, b in runs.tolist():
                    left.append(raw[at:a])
                    at = b
                kept = b"".join([*left, raw[at:]])
                for column, value in zip(out, (key, len(raw), len(raw) - len(kept), len(runs),
                                               hashlib.sha256(kept).hexdigest(), kept)):
                    column.append(value)
            yield common.batch_of(shape, *out)

    marked = dealt.join(marks, keys).select("doc_id", "text", "copy", "runs")
    unnamed = rows.where(F.col("doc_id").isNull()).select(
        "doc_id", "text", F.lit(False).alias("copy"), F.lit(None).cast("binary").alias("runs"))
    result = marked.unionAll(unnamed)
    return common.map_arrow(result, cut_out, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
                            + (", kept binary" if with_text else ""))
