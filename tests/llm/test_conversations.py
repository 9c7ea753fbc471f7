import hashlib
import random
import re
import zlib

import pytest

from rivermart.llm import conversations
from rivermart.llm.conversations import ENDS, NOTHING, cheapest, long_table, search

SPACES = " \t\n\x0b\x0c\r"


def audits(rows):
    """Cost and least audit of the cheapest repair, by a table over rows and what the roles so far end in.

    ``rows`` are (initial, fault). The pattern's states are spelled out as the last role's initial."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "")}

    def put(into, state, label):
        if state not in into or label < into[state]:
            into[state] = label

    def inserted(labels):
        for _ in range(4):
            for state, (cost, audit) in list(labels.items()):
                put(labels, follow[state][-1], (cost + 5, audit + "I"))
        return labels
    inserted(best)
    for initial, fault in rows:
        new = {}
        for state, (cost, audit) in best.items():
            put(new, state, (cost + 2, audit + "D"))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 if fault else 0
            if initial and initial in follow[state]:
                put(new, initial, (cost + extra, audit + "K"))
            put(new, follow[state][-1], (cost + extra + 1, audit + "R"))
        best = inserted(new)
    return min(best[state] for state in ("", "a") if state in best)


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if draw == 1:
            text = ""
        if draw == 2:
            text = re.sub("[.!?]", "", text)
        if draw == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(draw, 1)
    return out


def repaired(rows):
    """conv_id: the contract's columns, from rows after damage."""
    found = {}
    for conv in {row[0] for row in rows}:
        own = sorted((r[1:] for r in rows if r[0] == conv),
                     key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        judged, seen = [], set()
        for _, role, text in own:
            body = text.strip(SPACES)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else None if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            judged.append((role[:1], fault))
        cost, audit = audits(judged)
        lines, at, state = [], 0, ""
        for letter in audit:
            role = {"": "user", "s": "user", "u": "assistant", "a": "user"}[state]
            if letter == "I":
                lines.append((role, ""))
            else:
                (_, kept, text), at = own[at], at + 1
                if letter == "D":
                    continue
                lines.append((kept if letter == "K" else role, text))
            state = lines[-1][0][:1]
        assert re.fullmatch("(s?(ua)+)?", "".join(role[:1] for role, _ in lines)) and at == len(own)
        turns = [r[0] for r in own if r[0] is not None]
        counts = [sum(f == kind for _, f in judged) for kind in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        sha = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in lines).encode()).hexdigest()
        found[conv] = (gaps, *counts, illegal, cost, audit, sha)
    return found


def rows_like(seed, n):
    draw = random.Random(seed)
    return [(draw.choice("suuaat"), draw.choice([None] * 5 + ["blank", "duplicate", "truncated"])) for _ in range(n)]


def test_search_finds_the_least_audit():
    for seed in range(600):
        rows = rows_like(seed, seed % 14)
        assert search(rows, NOTHING, ENDS) == audits(rows), rows


def test_ties_go_to_the_least_audit():
    assert search([("u", None)], NOTHING, ENDS) == (2, "D")
    assert search([("a", None), ("a", None)], NOTHING, ENDS) == audits([("a", None), ("a", None)]) == (1, "RK")
    assert search([], NOTHING, ENDS) == (0, "")


def test_segments_put_together(monkeypatch):
    monkeypatch.setattr(conversations, "SEGMENT", 5)
    for seed in range(200):
        rows = rows_like(seed, seed % 37)
        assert cheapest(rows) == audits(rows), rows
        table = long_table(rows)
        assert min(table[NOTHING, end] for end in ENDS if (NOTHING, end) in table) == audits(rows)


def test_a_long_conversation():
    rows = rows_like(7, 1500)
    assert cheapest(rows) == audits(rows)


def some_rows(seed, conversations_, turns):
    draw = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "a b", "", " \n", "Yes.", "x.\t", None] + [f"text {i}." for i in range(30)]
    return [(c, None if draw.random() < 0.05 else draw.randint(0, turns), draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
             draw.choice(texts)) for c in [*range(conversations_), None] for _ in range(draw.randint(1, turns))]


def as_found(frame):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {row["conv_id"]: tuple(row[name] for name in names) for row in frame.collect()}


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("partition_bytes", [1 << 23, 400])
def test_repair_over_any_ranges(frame, partition_bytes):
    rows = some_rows(partition_bytes, 25, 12)
    result = conversations.repair(frame(rows, SCHEMA), partition_bytes)
    blocks = result.turns.collect()
    sums = {row["conv_id"]: row["repaired_sha256"] for row in conversations.digests(result.turns).collect()}
    plain = [tuple(" " if x is None and i > 1 else x for i, x in enumerate(row)) for row in rows]
    expected = repaired(plain)
    report = {row["conv_id"]: tuple(row)[1:] for row in result.report.collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert {conv: (*row, sums.get(conv, empty)) for conv, row in report.items()} == expected
    assert len(blocks) >= len(sums)
    if partition_bytes == 400:
        assert any(not block["whole"] for block in blocks)


def test_one_conversation_holds_all_rows(frame):
    draw = random.Random(5)
    rows = [(1, i, draw.choice(["user", "assistant"]), draw.choice(["Same.", f"Own {i}.", "cut"])) for i in range(900)]
    result = conversations.repair(frame(rows, SCHEMA), 2000)
    assert [tuple(r)[1:] for r in result.report.collect()] == [repaired(rows)[1][:-1]]
    assert conversations.digests(result.turns).collect()[0]["repaired_sha256"] == repaired(rows)[1][-1]
    assert len({block["part"] for block in result.turns.collect()}) >= 3


def test_rows_alike_are_parted(frame):
    rows = [(1, 0, "user", "Again and again.")] * 400 + [(2, 0, "user", "Hi."), (2, 1, "assistant", "Ho.")]
    result = conversations.repair(frame(rows, SCHEMA), 1000)
    found = {r["conv_id"]: (r["duplicate"], r["cost"], r["audit"]) for r in result.report.collect()}
    assert found == {1: (399, 800, "D" * 400), 2: (0, 0, "KK")}


def test_damage_and_repair(frame):
    rows = some_rows(11, 40, 6)
    after = repaired(damage(rows))
    gone = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    expected = {conv: after.get(conv, gone) for conv in {row[0] for row in rows}}
    assert as_found(conversations.damage_and_repair(frame(rows, SCHEMA))) == expected
    assert gone in expected.values() or len(after) == len(expected)


def test_all_rows_dropped(frame):
    turn = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    found = as_found(conversations.damage_and_repair(frame([(1, turn, "user", "Hi.")], SCHEMA)))
    assert found == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_an_empty_table(frame):
    assert conversations.damage_and_repair(frame([], SCHEMA)).collect() == []


def test_the_query(spark, sf_dir):
    from rivermart.llm.queries import op13_repaired_conversations
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    after = repaired(damage(rows))
    found = as_found(op13_repaired_conversations(spark, sf_dir))
    assert set(found) == {row[0] for row in rows}
    assert all(found[conv] == row for conv, row in after.items())
