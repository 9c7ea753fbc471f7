import hashlib
import random

import pytest

from rivermart.llm import tries
from rivermart.llm.tries import Spilled, Trie

COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def expected(rows):
    """(doc_id, keep_id, group_size, kept, sha256) of rows with distinct ids, by a dictionary."""
    groups = {}
    for doc_id, text in rows:
        key = "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")
        groups.setdefault(key, []).append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    out = []
    for key, members in groups.items():
        keep = min(members)[3]
        out += [(m[3], keep, len(members), m[3] == keep, hashlib.sha256(key.encode()).hexdigest()) for m in members]
    return sorted(out, key=str)


def found(frame, docs, **options):
    return sorted(map(tuple, tries.owners(frame(docs), **options).select(*COLUMNS).collect()), key=str)


def strings_of(seed, n):
    draw = random.Random(seed)
    return ["".join(draw.choice("ab") for _ in range(draw.randint(0, 12))).encode() for _ in range(n)]


def test_a_trie_is_a_dictionary():
    for seed in range(20):
        trie, known = Trie(), {}
        for i, key in enumerate(strings_of(seed, 200)):
            node = trie.place(key)
            assert (node.entry is None) == (key not in known)
            node.entry = known.setdefault(key, i)
        assert dict(trie.strings()) == known


def test_a_spilled_subtree_takes_all_its_strings():
    for seed in range(20):
        trie, known, gone = Trie(), {}, {}
        for i, key in enumerate(strings_of(seed, 400)):
            node = trie.place(key)
            if node.entry is Spilled:
                gone.setdefault(key, []).append(i)
                assert key not in dict(trie.strings())
                continue
            node.entry = (node.entry or []) + [i]
            if i % 37 == 0:
                left = dict(trie.strings())
                for some, entry in trie.spill():
                    gone[some] = entry
                    assert left.pop(some) == entry
                assert dict(trie.strings()) == left and (left or not gone)
        every = dict(trie.strings())
        assert not every.keys() & gone.keys() and every
        for i, key in enumerate(strings_of(seed, 400)):
            known.setdefault(key, []).append(i)
        assert {**every, **gone} == known


def test_one_string_is_never_spilled():
    trie = Trie()
    trie.place(b"x" * 100).entry = 1
    assert trie.spill() == [] and dict(trie.strings()) == {b"x" * 100: 1}


def test_owners_of_odd_texts(frame, odd_texts):
    assert found(frame, odd_texts) == expected(odd_texts)


def test_spaces_do_not_count_and_the_longest_stays(frame):
    docs = [(5, "a b"), (4, "ab"), (3, "a  b\n"), (2, "a b \t"), (1, None), (9, " "), (8, "a b"), (7, "日 本"), (6, "日本")]
    assert found(frame, docs) == expected(docs)
    assert {row[0]: row[1] for row in found(frame, docs)} == {5: 2, 4: 2, 3: 2, 2: 2, 1: 9, 9: 9, 8: 8, 7: 7, 6: 7}


def test_small_budgets_give_the_same(frame):
    draw = random.Random(4)
    texts = ["".join(draw.choice("abc ") for _ in range(draw.randint(0, 9))) for _ in range(300)]
    docs = [(i, draw.choice(texts)) for i in range(900)]
    assert found(frame, docs, gathered_bytes=2000, partition_bytes=1 << 20, trie_bytes=3000) == expected(docs)


def test_a_hot_text_travels_once_per_task(spark, monkeypatch):
    sent = []
    monkeypatch.setattr(tries, "_owners", lambda entries, *a, f=tries._owners: sent.append(entries.collect()) or f(entries, *a))
    docs = spark.range(0, 4000, 1, 4).selectExpr("id AS doc_id", "IF(id % 3 = 0, repeat('hot ', 50), 'own ' || id) AS text")
    rows = tries.owners(docs).where("group_size > 1").collect()
    assert len(rows) == 1334 and {r["keep_id"] for r in rows} == {0}
    hot = [r for r in sent[0] if r["text"] == b"hot" * 50]
    assert len(hot) <= 4 and sum(r["times"] for r in hot) == 1334


def test_repeated_rows_and_null_ids(frame):
    rows = tries.owners(frame([(1, "a"), (1, "a"), (None, "a"), (None, "b"), (None, "b ")])).collect()
    by = sorted(((str(r["doc_id"]), r["keep_id"], r["group_size"], r["kept"]) for r in rows), key=str)
    assert by == [("1", 1, 3, False), ("1", 1, 3, True), ("None", 1, 3, False), ("None", None, 2, False), ("None", None, 2, True)]


def test_an_empty_table(frame):
    assert tries.owners(frame([])).collect() == []


def test_the_query(spark, sf_dir):
    from rivermart.llm.queries import op11_trie_owners
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    rows = op11_trie_owners(spark, sf_dir).select(*COLUMNS).collect()
    assert sorted(map(tuple, rows), key=str) == expected(docs)
    assert any(r["group_size"] > 1 for r in rows)


@pytest.mark.parametrize("label, key, at, same", [(b"abc", b"xabd", 1, 2), (b"abc", b"abc", 0, 3), (b"", b"a", 0, 0), (b"abc", b"a", 0, 1)])
def test_agreement(label, key, at, same):
    assert tries.agreement(label, key, at) == same
