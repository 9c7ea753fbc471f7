"""Operator 13: the cheapest repair of a conversation, by bidirectional Dijkstra.

The edit lattice has a node for each place between rows and each state of the wanted
pattern; keeping, reroling and deleting a row lead to the next place, inserting
a row stays at the place. One heap searches from the front, one from the back. Once
they meet, the search goes on until no path as cheap as the best is left, so all
crossings of that cost are seen, and the one of the least concatenated audit wins.

Two audits that lead to one node at one cost are never each other's beginning:
both have a letter per row, so the longer one would have more insertions and cost
more. The least audit to a node therefore begins the least audit through it, and
a long conversation can be cut into segments whose tables (from state, to state:
cost, audit) are put together one after the other.

Rows are dealt by ranges of (conversation, turn), so a conversation of any length
is spread over as many tasks as it needs. Conversations that lie within one range
are settled there. For the others each range makes its segment's table, one row
per range is folded per conversation, and the audits go back to the ranges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from heapq import heappop, heappush
from itertools import groupby
from math import inf
from operator import itemgetter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from rivermart.llm import common

SPACES = " \t\n\x0b\x0c\r"
# Costs of the edits, and what a truncated row that stays adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States of the pattern (s?(ua)+)?: nothing yet, after the system's turn, the user's, the assistant's.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: Where an inserted or reroled row leads, and its role.
WANTED = (USER, USER, ASSISTANT, USER)
ROLE = ("user", "user", "assistant", "user")
ENDS = (NOTHING, ASSISTANT)
#: Rows of a segment; audits are held as texts within it.
SEGMENT = 128
PARTITION_BYTES = 8 << 20
#: Number of the first row of a range's last conversation; its first conversation's rows count from 0.
LAST = 1 << 40
BLANK, DUPLICATE, CUT_OFF = "blank", "duplicate", "truncated"
COUNTS = ("gaps", BLANK, DUPLICATE, CUT_OFF, "illegal", "cost")

REPORT = [("conv_id", pa.int64()), *((name, pa.int64()) for name in COUNTS), ("audit", pa.string())]
OPEN = [("part", pa.int32()), ("pos", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()),
        ("mark", pa.string())]
TURNS = [("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]
SORTED = [*REPORT, *TURNS, *OPEN]
PIECE = [("conv_id", pa.int64()), ("part", pa.int32()), *((name, pa.int64()) for name in COUNTS[1:5]), ("low", pa.int64()),
         ("high", pa.int64()), ("turns", pa.int64()), ("first", pa.string()), ("last", pa.string()),
         ("cells", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))]
FOLDED = [*REPORT, ("part", pa.int32()), ("state", pa.int32())]
BLOCK = [("conv_id", pa.int64()), ("part", pa.int32()), ("block", pa.int64()), *TURNS]
KINDS = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.list_(pa.string()): "array<string>",
         pa.list_(pa.int64()): "array<long>"}

Row = tuple[str, str | None]  # a row's role initial, and its fault if it has one
Label = tuple[int, str]


def _schema(fields: list) -> str:
    return ", ".join(f"{name} {KINDS[kind]}" for name, kind in fields)


# ---------------------------------------------------------------- the lattice

def row_edits(state: int, row: Row) -> Iterator[tuple[str, int, int]]:
    """(letter, cost, state after) of the edits that take a row in a state."""
    initial, fault = row
    yield "D", DELETE, state
    if fault in (BLANK, DUPLICATE):
        return
    more = TRUNCATED if fault else 0
    if initial in NEXT[state]:
        yield "K", KEEP + more, NEXT[state][initial]
    yield "R", REROLE + more, WANTED[state]


def search(rows: list[Row], start: int, ends: tuple[int, ...]) -> Label | None:
    """Cost and least audit of the cheapest edits of ``rows`` that lead from a state to one of ``ends``.

    Either heap gives nodes by cost and then by place, in its own direction: an edit
    without cost moves on by a row, so all labels of a node are known when it is
    settled, and the least audit comes first.
    """
    n = len(rows)
    ahead: dict[tuple[int, int], Label] = {}
    behind: dict[tuple[int, int], Label] = {}
    front, back = [(0, 0, "", start)], [(0, -n, "", end) for end in ends]
    best: tuple[float, str] = (inf, "")

    def after(place: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        if place < n:
            for letter, cost, to in row_edits(state, rows[place]):
                yield letter, cost, place + 1, to
        yield "I", INSERT, place, WANTED[state]

    def before(place: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        for origin in range(4):
            if place > 0:
                for letter, cost, to in row_edits(origin, rows[place - 1]):
                    if to == state:
                        yield letter, cost, place - 1, origin
            if WANTED[origin] == state:
                yield "I", INSERT, place, origin

    def step(heap: list, own: dict, other: dict, edges: Callable, forward: bool) -> None:
        nonlocal best
        cost, place, audit, state = heappop(heap)
        node = (abs(place), state)
        if node in own:
            return
        own[node] = (cost, audit)
        if node in other:
            best = min(best, _met(cost, audit, 0, "", other[node], forward))
        for letter, more, at, to in edges(*node):
            if (at, to) in other:  # the heaps meet on this edit
                best = min(best, _met(cost, audit, more, letter, other[at, to], forward))
            if (at, to) not in own:
                made = audit + letter if forward else letter + audit
                heappush(heap, (cost + more, at if forward else -at, made, to))

    for _ in ends:  # so that a path that only one side has walked is met at its end
        step(back, behind, ahead, before, False)
    while front or back:
        first = front[0][0] if front else inf
        last = back[0][0] if back else inf
        if first + last > best[0]:
            break
        if first <= last:
            step(front, ahead, behind, after, True)
        else:
            step(back, behind, ahead, before, False)
    return None if best[0] == inf else (int(best[0]), best[1])


def _met(cost: int, audit: str, more: int, letter: str, other: Label, forward: bool) -> tuple[float, str]:
    total = cost + more + other[0]
    return total, audit + letter + other[1] if forward else other[1] + letter + audit


Table = dict[tuple[int, int], Label]


def segment_table(rows: list[Row]) -> Table:
    """(from, to): cost and least audit, for all states that edits of ``rows`` can lead to."""
    found = {}
    for start in range(4):
        for end in range(min(start, USER), 4):
            label = search(rows, start, (end,))
            if label is not None:
                found[start, end] = label
    return found


def follow(labels: dict[int, Label], table: Table) -> dict[int, tuple[int, str, int]]:
    """Per state after a segment: cost, least audit, and the state before it."""
    out: dict[int, tuple[int, str, int]] = {}
    for (start, end), (cost, audit) in table.items():
        if start in labels:
            made = (labels[start][0] + cost, labels[start][1] + audit, start)
            if end not in out or made < out[end]:
                out[end] = made
    return out


def long_table(rows: list[Row], starts: tuple[int, ...] = tuple(range(4))) -> Table:
    """The table of any number of rows, segment after segment."""
    if len(rows) <= SEGMENT and len(starts) == 4:
        return segment_table(rows)
    found: Table = {}
    tables = [segment_table(rows[i:i + SEGMENT]) for i in range(0, len(rows), SEGMENT)]
    for start in starts:
        labels = {start: (0, "")}
        for table in tables:
            labels = {end: label[:2] for end, label in follow(labels, table).items()}
        found.update({(start, end): label for end, label in labels.items()})
    return found


def cheapest(rows: list[Row]) -> Label:
    """Cost and least audit of the cheapest repair of a whole conversation."""
    if len(rows) <= SEGMENT:
        return search(rows, NOTHING, ENDS)
    table = long_table(rows, (NOTHING,))
    return min(table[NOTHING, end] for end in ENDS if (NOTHING, end) in table)


def edited(audit: str, turns: Iterator[tuple[str, str]], state: int = NOTHING) -> Iterator[tuple[str, str]]:
    """Role and text of the rows that an audit leaves or adds."""
    for letter in audit:
        if letter == "I":
            yield ROLE[state], ""
            state = WANTED[state]
            continue
        role, text = next(turns)
        if letter == "K":
            yield role, text
            state = NEXT[state][role[:1]]
        elif letter == "R":
            yield ROLE[state], text
            state = WANTED[state]


# ---------------------------------------------------------------- rows

def fault_of(text: str, repeated: bool) -> str | None:
    """The first fault of a row."""
    body = text.strip(SPACES)
    if not body:
        return BLANK
    return DUPLICATE if repeated else None if body[-1] in ".!?" else CUT_OFF


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def _faults(rows: list[Row]) -> list[int]:
    return [sum(fault == kind for _, fault in rows) for kind in (BLANK, DUPLICATE, CUT_OFF)]


def _judged(rows: list[tuple]) -> list[Row]:
    """Initial and fault of a whole conversation's rows (turn, role, text, mark)."""
    seen, out = set(), []
    for _, role, text, mark in rows:
        out.append((role[:1], fault_of(text, (role, mark) in seen)))
        seen.add((role, mark))
    return out


def _settled(conv_id: int | None, rows: list[tuple]) -> tuple:
    """The report and the repaired turns of a whole conversation."""
    judged = _judged(rows)
    cost, audit = cheapest(judged)
    turns = [row[0] for row in rows if row[0] is not None]
    gaps = turns[-1] - turns[0] + 1 - len(set(turns)) if turns else 0
    left = list(edited(audit, ((role, text) for _, role, text, _ in rows)))
    return (conv_id, gaps, *_faults(judged), illegal_pairs([initial for initial, _ in judged]), cost, audit,
            [role for role, _ in left], [text for _, text in left])


def _batches(fields: list, rows: Iterator[tuple], size: Callable[[tuple], int]) -> Iterator[pa.RecordBatch]:
    held, held_bytes = [], 0
    for row in rows:
        held.append(row)
        held_bytes += size(row)
        if held_bytes > common.CHUNK_BYTES:
            yield common.batch_of(fields, *zip(*held))
            held, held_bytes = [], 0
    if held:
        yield common.batch_of(fields, *zip(*held))


def _tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _settle_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a range, in order: conversations that begin and end in it are settled, the rows of the others passed on.

    The range's first and last conversation may go on in its neighbours.
    """
    part = TaskContext.get().partitionId()
    no_report, no_turns, no_row = (None,) * (len(REPORT) - 1), (None, None), (None,) * len(OPEN)

    def open_rows(conv_id, rows, first):
        return ((conv_id, *no_report, *no_turns, part, pos, *row) for pos, row in enumerate(rows, first))

    def rows():
        last = None
        for number, (conv_id, members) in enumerate(groupby(_tuples(batches), itemgetter(0))):
            if last is not None:
                yield (*_settled(*last), *no_row)
                last = None
            members = (member[1:] for member in members)
            if number == 0:
                yield from open_rows(conv_id, members, 0)
            else:
                last = (conv_id, list(members))
        if last is not None:
            yield from open_rows(*last, LAST)

    yield from _batches(SORTED, rows(), lambda row: 300 + len(row[-2] or "") + sum(map(len, row[len(REPORT) + 1] or ())))


# ---------------------------------------------------------------- conversations over several ranges

def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, conv_id, pos, turn, role, text, is_first) in order to one row per range and conversation."""
    def rows():
        for (part, conv_id), members in groupby(_tuples(batches), itemgetter(0, 1)):
            judged, turns = [], []
            for _, _, _, turn, role, text, is_first in members:
                judged.append((role[:1], fault_of(text, not is_first)))
                if turn is not None:
                    turns.append(turn)
            table = long_table(judged)
            initials = [initial for initial, _ in judged]
            cells = [x for (start, end), (cost, _) in table.items() for x in (start, end, cost)]
            yield (conv_id, part, *_faults(judged), illegal_pairs(initials), turns[0] if turns else None,
                   turns[-1] if turns else None, len(set(turns)), initials[0], initials[-1], cells, [audit for _, audit in table.values()])

    yield from _batches(PIECE, rows(), lambda row: 300 + sum(map(len, row[-1])))


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces by conversation, in order, to its report (part null) and, per piece, its state and audit."""
    def rows():
        for conv_id, pieces in groupby(_tuples(batches), itemgetter(0)):
            labels, trail, parts = {NOTHING: (0, "")}, [], []
            sums, low, high, turns, last = [0] * 4, None, None, 0, None
            for _, part, *counts, first_turn, last_turn, own_turns, first, final, cells, audits in pieces:
                sums = [a + b for a, b in zip(sums, counts)]
                sums[3] += 0 if last is None else illegal_pairs([last, first])
                if first_turn is not None:
                    turns += own_turns - (high == first_turn)
                    low, high = first_turn if low is None else low, last_turn
                last = final
                table = {(cells[3 * i], cells[3 * i + 1]): (cells[3 * i + 2], audit) for i, audit in enumerate(audits)}
                reached = follow(labels, table)
                # Per state: where its path stood before the piece, and how long the audit was there.
                trail.append({end: (start, len(labels[start][1])) for end, (_, _, start) in reached.items()})
                parts.append(part)
                labels = {end: label[:2] for end, label in reached.items()}
            (cost, audit), state = min((labels[end], end) for end in ENDS if end in labels)
            gaps = 0 if low is None else high - low + 1 - turns
            yield conv_id, gaps, *sums, cost, audit, None, None
            until = len(audit)
            for part, back in zip(reversed(parts), reversed(trail)):
                state, since = back[state]
                yield conv_id, *(None,) * len(COUNTS), audit[since:until], part, state
                until = since

    yield from _batches(FOLDED, rows(), lambda row: 300 + len(row[len(COUNTS) + 1]))


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, conv_id, pos, state, audit, role, text), a piece's audit before its rows, to blocks of repaired turns."""
    def rows():
        for (part, conv_id), members in groupby(_tuples(batches), itemgetter(0, 1)):
            _, _, _, state, audit, _, _ = next(members)
            roles, texts, size, block = [], [], 0, 0
            for role, text in edited(audit, (member[5:] for member in members), state):
                roles.append(role)
                texts.append(text)
                size += 50 + len(text)
                if size > common.CHUNK_BYTES:
                    yield conv_id, part, block, roles, texts
                    roles, texts, size, block = [], [], 0, block + 1
            if roles:
                yield conv_id, part, block, roles, texts

    yield from _batches(BLOCK, rows(), lambda row: 300 + sum(map(len, row[-1])))


@dataclass(frozen=True)
class Repaired:
    """``report``: one row per conversation, with conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit.
    ``turns``: the repaired turns in blocks (conv_id, part, block, roles, texts); a conversation is the blocks
    in order of part and block, and has none if nothing is left of it. ``whole`` says that it is one block."""
    report: DataFrame
    turns: DataFrame


def repair(rows: DataFrame, partition_bytes: int = PARTITION_BYTES) -> Repaired:
    """Repair the conversations of ``rows`` (conv_id, turn, role, text).

    Rows are taken by turn, a null turn first, rows of one turn by role and the MD5 of
    their text. A null role or text is one space; rows of a null conv_id are a
    conversation. A row is a duplicate if a row of its role and text (told apart by
    MD5) was there before. Other columns are ignored; an empty table gives no rows.
    """
    common.prepare(rows.sparkSession)
    typed = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text")).withColumn("mark", F.md5("text"))
    parts = 1 + common.text_bytes(typed) // partition_bytes
    order = ("conv_id", "turn", "role", "mark")
    # Rows alike in all of these may be parted anywhere.
    dealt = (typed.withColumn("copy", F.monotonically_increasing_id()).repartitionByRange(parts, *order, "copy")
             .sortWithinPartitions(*order).drop("copy"))
    done = common.stored(common.map_arrow(dealt, _settle_range, _schema(SORTED)), "conversations")
    closed = done.where("part IS NULL")
    left = done.where("part IS NOT NULL").select("conv_id", *(name for name, _ in OPEN))
    # A role and text may recur in any range, so its first place is found by a combined minimum.
    firsts = (left.groupBy("conv_id", "role", "mark").agg(F.min(F.struct("part", "pos")).alias("at"))
              .select("at.part", "at.pos", F.lit(True).alias("is_first")))
    spread = left.drop("mark").join(firsts, ["part", "pos"], "left").select(
        "part", "conv_id", "pos", "turn", "role", "text", F.coalesce("is_first", F.lit(False)).alias("is_first"))
    by_range = spread.repartition(parts, "part", "conv_id").sortWithinPartitions("part", "conv_id", "pos")
    pieces = common.stored(common.map_arrow(by_range, _pieces, _schema(PIECE)), "conversation-pieces")
    by_conversation = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    folded = common.stored(common.map_arrow(by_conversation, _fold, _schema(FOLDED)), "conversation-audits")
    audits = folded.where("part IS NOT NULL").select(
        "part", "conv_id", F.lit(-1).cast("long").alias("pos"), "state", "audit",
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    given = audits.unionByName(left.select("part", "conv_id", "pos", "role", "text"), allowMissingColumns=True)
    given = given.repartition(parts, "part", "conv_id").sortWithinPartitions("part", "conv_id", "pos")
    blocks = common.map_arrow(given, _apply, _schema(BLOCK)).withColumn("whole", F.lit(False))
    names = [name for name, _ in REPORT]
    settled = closed.where(F.size("roles") > 0).select(
        "conv_id", F.lit(0).alias("part"), F.lit(0).cast("long").alias("block"), "roles", "texts", F.lit(True).alias("whole"))
    return Repaired(closed.select(*names).unionByName(folded.where("part IS NULL").select(*names)),
                    settled.unionByName(blocks))


def digests(turns: DataFrame) -> DataFrame:
    """conv_id and repaired_sha256 of ``Repaired.turns``: the SHA-256 of the lines role:text.

    Whole conversations are digested as they lie; of the others, blocks are read one after
    the other, which the digest demands, and never held together.
    """
    lines = F.array_join(F.zip_with("roles", "texts", lambda role, text: F.concat(role, F.lit(":"), text)), "\n")
    whole = turns.where("whole").select("conv_id", F.sha2(lines, 256).alias("repaired_sha256"))

    def digest(batches):
        def rows():
            for conv_id, blocks in groupby(_tuples(batches), itemgetter(0)):
                made = hashlib.sha256()
                for number, (*_, body) in enumerate(blocks):
                    made.update(b"\n" * (number > 0) + body.encode())
                yield conv_id, made.hexdigest()
        yield from _batches([("conv_id", pa.int64()), ("repaired_sha256", pa.string())], rows(), lambda row: 100)

    parts = turns.where("NOT whole").select("conv_id", "part", "block", lines.alias("lines"))
    dealt = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
    return whole.unionByName(common.map_arrow(dealt, digest, "conv_id long, repaired_sha256 string"))


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with faults drawn by crc32(``conv_id:turn``) % 20: 0 drops the row, 1 empties
    its text, 2 takes its sentence ends, 3 repeats it, 4 makes it the user's. Nulls count as one space."""
    def text_of(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    draw = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    times = F.when(draw == 0, 0).when(draw == 3, 2).otherwise(1)
    text = (F.when(draw == 1, F.lit("")).when(draw == 2, F.regexp_replace(text_of("text"), "[.!?]", ""))
            .otherwise(text_of("text")))
    return rows.select("conv_id", "turn", F.when(draw == 4, F.lit("user")).otherwise(text_of("role")).alias("role"),
                       text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("copy")).drop("copy")


def damage_and_repair(rows: DataFrame) -> DataFrame:
    """Every conv_id of ``rows`` with the report and digest of its repair after ``damaged``."""
    repaired = repair(damaged(rows))
    every = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    found = repaired.report.withColumnRenamed("conv_id", "found")
    sums = digests(repaired.turns).withColumnRenamed("conv_id", "digested")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return (every.join(found, F.col("conv_id").eqNullSafe(F.col("found")), "left")
            .join(sums, F.col("conv_id").eqNullSafe(F.col("digested")), "left")
            .select("conv_id", *(F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in COUNTS),
                    F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256")))
