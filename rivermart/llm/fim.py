"""Operator 12: fill-in-the-middle, by rotating blocks of a text in place.

A scan over a run of texts marks where tokens begin (runs of ASCII letters, or any
other character), so both cuts are places in an array. The three sentinels are
inserted into the text's bytearray as prefix, middle, suffix, and the blocks then
change places by rotations, each made of three reversals within the array.
Restoring finds the sentinels, rotates back and takes them out; the text held
none of them, and no two pieces can form one where they meet, as a sentinel's
first character occurs in it only once.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rivermart.llm import common

# Fixed values.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Of a hundred texts, how many are rearranged, and how many of those begin with the suffix.
REARRANGED, SUFFIX_FIRST = 90, 20
SEED = 1
#: Bytes that change places at a time.
BLOCK = 1 << 16

LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
REARRANGED_ROWS = [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                   ("middle_chars", pa.int64()), ("output", pa.string())]
RESTORED_ROWS = [*REARRANGED_ROWS, ("restored", pa.string())]


def _schema(rows: list) -> str:
    return ", ".join(f"{name} {'long' if kind == pa.int64() else 'string'}" for name, kind in rows)


def reverse(view: np.ndarray, low: int, high: int) -> None:
    """Reverse a stretch in place; no more than a block is held beside it."""
    while high - low > 1:
        step = min(BLOCK, (high - low) // 2)
        held = view[low:low + step].copy()
        view[low:low + step] = view[high - step:high][::-1]
        view[high - step:high] = held[::-1]
        low, high = low + step, high - step


def rotate(buffer: bytearray, low: int, middle: int, high: int) -> None:
    """Exchange the neighbouring blocks [low, middle) and [middle, high)."""
    view = np.frombuffer(buffer, np.uint8)
    reverse(view, low, middle)
    reverse(view, middle, high)
    reverse(view, low, high)


def arrange(text: bytes, first: int, second: int, form: str) -> bytes:
    """``text`` cut at two byte places and laid out in a form."""
    buffer = bytearray(text)
    if form == PLAIN:
        return text
    buffer[second:second] = SUFFIX
    buffer[first:first] = MIDDLE
    buffer[0:0] = PREFIX
    at_middle, at_suffix = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    rotate(buffer, at_middle if form == PSM else 0, at_suffix, len(buffer))
    return bytes(buffer)


def restore_text(output: bytes, form: str) -> bytes:
    """The text that ``arrange`` has laid out."""
    if form == PLAIN:
        return output
    buffer = bytearray(output)
    at_suffix, at_middle, n = buffer.index(SUFFIX), buffer.index(MIDDLE), len(buffer)
    if form == PSM:  # prefix, suffix, middle
        rotate(buffer, at_suffix, at_middle, n)
        at_suffix, at_middle = n - (at_middle - at_suffix), at_suffix
    else:  # suffix, prefix, middle
        shift = buffer.index(PREFIX)
        rotate(buffer, 0, shift, n)
        at_suffix, at_middle = n - shift, at_middle - shift
    del buffer[at_suffix:at_suffix + len(SUFFIX)], buffer[at_middle:at_middle + len(MIDDLE)], buffer[:len(PREFIX)]
    return bytes(buffer)


def draws(seed: int, doc_id: int | None) -> list[int]:
    """The first four unsigned 32-bit numbers of the digest of seed and doc_id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]


def rearrange(docs: DataFrame, seed: int = SEED, rearranged: int = REARRANGED, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n (tokens), form, prefix_chars, middle_chars, output.

    Cuts lie between tokens and are drawn, like the form, from a digest of ``seed``
    and doc_id; a null doc_id counts as an empty one, and rows of an equal doc_id
    draw alike. A text that is empty (or null), holds a sentinel or is not drawn
    stays plain, and then the lengths are null. Other columns are ignored. Each task
    works on a run of whole texts at a time; nothing is shuffled.
    """
    common.prepare(docs.sparkSession)

    def work(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            data, bounds = common.utf8(batch.column(1))
            for low, high in common.chunks(bounds):
                raw = data[bounds[low]:bounds[high]]
                places = bounds[low:high + 1] - bounds[low]
                inside = np.zeros(len(raw), bool)  # letters behind a letter of the same text
                letter = LETTER[raw]
                inside[1:] = letter[1:] & letter[:-1]
                inside[places[:-1][places[:-1] < len(raw)]] = False
                points = (raw & 0xC0) != 0x80
                starts = np.flatnonzero(points & ~inside)
                before = np.concatenate([[0], np.cumsum(points)])
                tokens = np.searchsorted(starts, places)
                whole, rows = raw.tobytes(), []
                for i, doc_id in enumerate(ids[low:high]):
                    a, b, n = int(places[i]), int(places[i + 1]), int(tokens[i + 1] - tokens[i])
                    text, (h1, h2, h3, h4) = whole[a:b], draws(seed, doc_id)
                    if not text or h3 % 100 >= rearranged or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
                        rows.append((doc_id, n, PLAIN, None, None, text))
                        continue
                    cuts = sorted((h1 % (n + 1), h2 % (n + 1)))
                    first, second = (int(starts[tokens[i] + cut]) if cut < n else b for cut in cuts)
                    form = SPM if h4 % 100 < suffix_first else PSM
                    rows.append((doc_id, n, form, int(before[first] - before[a]), int(before[second] - before[first]),
                                 arrange(text, first - a, second - a, form)))
                yield _rows(REARRANGED_ROWS, rows)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return common.map_arrow(texts, work, _schema(REARRANGED_ROWS))


def _rows(schema: list, rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(column, pa.binary()).cast(pa.string()) if name in ("output", "restored") else pa.array(column, kind)
               for (name, kind), column in zip(schema, zip(*rows))]
    return common.batch_of(schema, *columns)


def restore(rows: DataFrame) -> DataFrame:
    """The rows of ``rearrange`` with the exact text, rebuilt from output and form, in ``restored``."""
    names = [name for name, _ in REARRANGED_ROWS]

    def work(batches):
        for batch in batches:
            data, bounds = common.utf8(batch.column(names.index("output")))
            forms = batch.column(names.index("form")).to_pylist()
            for low, high in common.chunks(bounds):
                texts = [restore_text(data[bounds[i]:bounds[i + 1]].tobytes(), forms[i]) for i in range(low, high)]
                restored = pa.array(texts, pa.binary()).cast(pa.string())
                yield common.batch_of(RESTORED_ROWS, *batch.slice(low, high - low).columns, restored)

    return common.map_arrow(rows.select(*names), work, _schema(RESTORED_ROWS))
