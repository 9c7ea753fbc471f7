"""Operator 11: the owner of every text, found with compressed radix (Patricia) tries.

Texts are compared without their ASCII spaces, byte by byte. Each task first puts
its own texts into a trie, so that a text travels once per task however many
copies the task has; then texts are dealt by length and content hash, and each
partition puts the full byte strings of what it gets into a trie whose terminal
nodes hold the smallest identifier: most code points in the original text, then
smallest doc_id. A partition whose trie outgrows its budget gives away its largest
subtree, with all that later falls into it; those strings are dealt anew in the
next round, so a lost executor repeats one task of one round.

Documents find their owner by the task and the number of their string there, not
by a hash, and no key of that join has more rows than one task has read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from rivermart.llm import common

SPACES = b" \t\n\x0b\x0c\r"
#: Bytes of strings that a task gathers before it passes them on.
GATHERED_BYTES = 16 << 20
#: Bytes of strings dealt to a partition, and those a trie may hold before it spills.
PARTITION_BYTES = 24 << 20
TRIE_BYTES = 64 << 20
#: What a node costs beside its bytes.
NODE_BYTES = 200

ENTRY = [("task", pa.int32()), ("string", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()), ("chars", pa.int64()),
         ("times", pa.int64()), ("own_task", pa.int32()), ("sha256", pa.string()), ("n_bytes", pa.int64()), ("text", pa.binary())]
ENTRY_SCHEMA = ("task int, string long, row long, doc_id long, chars long, times long, own_task int, "
                "sha256 string, n_bytes long, text binary")


class Spilled:
    """The entry of a place whose strings were given away."""



class Node:
    """The bytes on the way to a node, its children by their first byte, and what a string that ends here holds."""
    __slots__ = ("label", "below", "entry")

    def __init__(self, label: bytes, below: dict | None = None, entry=None):
        self.label, self.below, self.entry = label, below, entry


def agreement(label: bytes, key: bytes, at: int) -> int:
    """How many bytes of ``label`` agree with those of ``key`` from ``at`` on, by binary search."""
    low, high = 0, min(len(label), len(key) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if key.startswith(label[low:middle], at + low):
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """Byte strings with an entry each. ``size`` is about the bytes it holds."""

    def __init__(self):
        self.root, self.size = Node(b""), 0

    def place(self, key: bytes) -> Node:
        """The node where ``key`` ends, made if there is none; one whose entry is Spilled if it fell into a spilled subtree."""
        node, at = self.root, 0
        while at < len(key) and node.entry is not Spilled:
            if node.below is None:
                node.below = {}
            child = node.below.get(key[at])
            if child is None:
                child = node.below[key[at]] = Node(key[at:])
                self.size += len(child.label) + NODE_BYTES
                return child
            if not key.startswith(child.label, at):
                same = agreement(child.label, key, at)
                upper = node.below[key[at]] = Node(child.label[:same], {child.label[same]: child})
                child.label = child.label[same:]
                self.size += NODE_BYTES
                child = upper
            at += len(child.label)
            node = child
        return node

    def strings(self, top: Node | None = None, before: bytes = b"") -> Iterator[tuple[bytes, object]]:
        """Every string below ``top`` with its entry; ``before`` is what leads to ``top``."""
        waiting = [(top or self.root, before)]
        while waiting:
            node, path = waiting.pop()
            path += node.label
            if node.entry is not None and node.entry is not Spilled:
                yield path, node.entry
            if node.below:
                waiting += [(child, path) for child in node.below.values()]

    def _measured(self) -> dict[Node, tuple[int, int]]:
        """Bytes and strings at and below each node."""
        order, waiting = [], [self.root]
        while waiting:
            node = waiting.pop()
            order.append(node)
            waiting += (node.below or {}).values()
        found: dict[Node, tuple[int, int]] = {}
        for node in reversed(order):
            below = [found[child] for child in (node.below or {}).values()]
            own = node.entry is not None and node.entry is not Spilled
            found[node] = (len(node.label) + NODE_BYTES + sum(b for b, _ in below), own + sum(n for _, n in below))
        return found

    def spill(self) -> list[tuple[bytes, object]]:
        """Take out the largest subtree of at most half of the trie, or a single string beyond
        that, and remember its place. At least one string stays; with one string, nothing goes."""
        measured = self._measured()
        whole, strings = measured[self.root]
        if strings < 2:
            return []
        node, path = self.root, b""
        while measured[node][1] == strings or 2 * measured[node][0] > whole:
            below = [child for child in (node.below or {}).values() if measured[child][1]]
            if not below:
                break
            path += node.label
            node = max(below, key=lambda child: measured[child][0])
        gone = list(self.strings(node, path))
        node.entry, node.below = Spilled, None
        self.size -= measured[node][0] - len(node.label) - NODE_BYTES
        return gone


def better(a: tuple, b: tuple) -> tuple:
    """The owner of two (chars, doc_id, task, row): most code points, then smallest doc_id (null last), then the first row."""
    def rank(x):
        return -x[0], x[1] is None, x[1] or 0, x[2], x[3]
    return a if rank(a) <= rank(b) else b


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows of ENTRY in batches of about a chunk's bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += NODE_BYTES + len(row[-1] or b"")
        if size > common.CHUNK_BYTES:
            yield common.batch_of(ENTRY, *zip(*held))
            held, size = [], 0
    if held:
        yield common.batch_of(ENTRY, *zip(*held))


def _gather(budget: int):
    """Rows (doc_id, text) to one row per document and one per distinct string of the task."""
    def gather(batches):
        task, trie, strings, row = TaskContext.get().partitionId(), Trie(), 0, 0

        def entries():
            return _batches((task, number, at, doc_id, chars, times, task, None, len(key), key)
                            for key, (number, times, (chars, doc_id, _, at), _) in trie.strings())

        for batch in batches:
            ids = batch.column(0).to_pylist()
            data, bounds = common.utf8(batch.column(1))
            for low, high in common.chunks(bounds):
                raw = data[bounds[low]:bounds[high]]
                places = (bounds[low:high + 1] - bounds[low]).tolist()
                points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[places]
                raw, numbers, sums = raw.tobytes(), [], []
                for i, (a, b, chars) in enumerate(zip(places, places[1:], np.diff(points).tolist())):
                    key = raw[a:b].translate(None, SPACES)
                    node = trie.place(key)
                    own = (chars, ids[low + i], task, row + i)
                    if node.entry is None:
                        node.entry = [strings, 1, own, hashlib.sha256(key).hexdigest()]
                        strings += 1
                    else:
                        node.entry[1] += 1
                        node.entry[2] = better(node.entry[2], own)
                    numbers.append(node.entry[0])
                    sums.append(node.entry[3])
                n = high - low
                none = [None] * n
                yield common.batch_of(ENTRY, [task] * n, numbers, np.arange(row, row + n), ids[low:high], none, none, none, sums, none, none)
                row += n
                if trie.size > budget:
                    yield from entries()
                    trie = Trie()
        yield from entries()

    return gather


def _settle(budget: int):
    """Entries dealt by length and hash to their owners; entries of spilled subtrees go on as they came."""
    def settle(batches):
        trie = Trie()

        def passed_on():
            names = ("task", "string", "row", "doc_id", "chars", "times")
            for batch in batches:
                for key, *member in zip(batch.column("text").to_pylist(), *(batch.column(name).to_pylist() for name in names)):
                    node = trie.place(key)
                    if node.entry is Spilled:
                        yield *member, member[0], None, len(key), key
                        continue
                    if node.entry is None:
                        node.entry = []
                    node.entry.append(member)
                    trie.size += NODE_BYTES
                    while trie.size > budget and (gone := trie.spill()):
                        trie.size -= NODE_BYTES * sum(len(members) for _, members in gone)
                        yield from ((*m, m[0], None, len(some), some) for some, members in gone for m in members)

        def settled():
            for _, members in trie.strings():
                own, times = None, 0
                for task, _, row, doc_id, chars, some in members:
                    times += some
                    own = better(own or (chars, doc_id, task, row), (chars, doc_id, task, row))
                chars, doc_id, own_task, row = own
                yield from ((m[0], m[1], row, doc_id, chars, times, own_task, None, None, None) for m in members)

        yield from _batches(passed_on())
        yield from _batches(settled())

    return settle


def _owners(entries: DataFrame, partition_bytes: int, trie_bytes: int) -> DataFrame:
    """(task, string) of every entry with its text's owner, over as many rounds as spilled subtrees need."""
    done, left, turn = None, entries, 0
    while True:
        n_bytes = left.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
        if done is not None and left.isEmpty():
            return done
        parts = max(1, -(-n_bytes // partition_bytes), entries.sparkSession.sparkContext.defaultParallelism if turn else 1)
        dealt = left.repartition(parts, "n_bytes", F.xxhash64("text", F.lit(turn)))
        made = common.stored(common.map_arrow(dealt, _settle(trie_bytes), ENTRY_SCHEMA), "owners")
        settled = made.where("text IS NULL").select(
            "task", "string", F.col("doc_id").alias("keep_id"), F.col("own_task").alias("keep_task"),
            F.col("row").alias("keep_row"), F.col("times").alias("group_size"))
        done = settled if done is None else done.unionByName(settled)
        left, turn = made.where("text IS NOT NULL"), turn + 1


def owners(docs: DataFrame, gathered_bytes: int = GATHERED_BYTES, partition_bytes: int = PARTITION_BYTES,
           trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are so without the characters of SPACES. Of equal
    texts the one with the most code points stays, then the smallest doc_id, a null
    doc_id last; of rows alike in both, one stays. A null text is empty, and so
    equal to one of spaces only. ``text_sha256`` is of the text without spaces.
    Other columns are ignored; an empty table gives no rows.
    """
    common.prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    gathered = common.stored(common.map_arrow(rows, _gather(gathered_bytes), ENTRY_SCHEMA), "gathered-strings")
    found = _owners(gathered.where("times IS NOT NULL"), partition_bytes, trie_bytes)
    members = gathered.where("times IS NULL").select("task", "string", "row", "doc_id", "sha256")
    kept = (F.col("task") == F.col("keep_task")) & (F.col("row") == F.col("keep_row"))
    return members.join(found, ["task", "string"]).select(
        "doc_id", "keep_id", "group_size", kept.alias("kept"), F.col("sha256").alias("text_sha256"))
