"""Suffix dedup against a search of every string."""

import random
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from rivermart.llm import suffixes  # noqa: E402


def key(row):
    return (row[0] is not None, *(x if x is not None else -1 for x in row))


def check(frame, rows, **options):
    got = suffixes.remove_repeats(frame(rows).repartition(3), **options).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute.removed(rows, options.get("width", 50)), key=key)


def test_odd_texts(frame, odd_texts):
    check(frame, odd_texts + [(None, odd_texts[0][1]), odd_texts[2], odd_texts[2]])


def test_random_texts_of_few_letters(frame):
    draw = random.Random(9)
    texts = ["".join(draw.choice("ab") for _ in range(draw.randint(0, 160))) for _ in range(60)]
    texts += [texts[i][5:90] + texts[i + 1][20:] for i in range(30)]
    check(frame, list(enumerate(texts)), width=12, gram=4)
    check(frame, list(enumerate(texts)), width=7, gram=7)


def test_texts_of_one_id_do_not_remove_each_other(frame, odd_texts):
    base = odd_texts[0][1]
    got = suffixes.remove_repeats(frame([(5, base), (5, base[:300]), (9, base[100:400])])).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in got) == [(5, 0), (5, 0), (9, 300)]


def test_long_texts_are_cut_into_parts(odd_texts):
    text = np.frombuffer((odd_texts[-1][1] * 2).encode(), np.uint8)
    bounds = np.array([0, 0, len(text), len(text)])
    whole = suffixes.Anchors(text, bounds, 50, 16)
    parts = [(p, suffixes.Anchors(d, b, 50, 16)) for d, b, _, p in suffixes.pieces(text, bounds, 50, 5000)]
    strings = sorted((a, f + i) for a, f, c in zip(whole.at, whole.first, whole.count) for i in range(c))
    again = sorted((a + p, f + p + i) for p, x in parts for a, f, c in zip(x.at, x.first, x.count) for i in range(c))
    assert strings == again and len(parts) > 5


def test_mergesort_orders_by_group_and_bytes():
    random = np.random.default_rng(3)
    rows = random.integers(97, 99, (200, 84)).astype(np.uint8)
    rows[100:] = rows[:100]
    s = suffixes.Suffixes(rows, 50)
    row, start = np.repeat(np.arange(200), 20), np.tile(np.arange(20), 200)
    group = np.sort(random.integers(0, 7, len(row)))
    names = [(g, rows[r, a:a + 50].tobytes()) for g, r, a in zip(group, row, start)]
    order, equal = suffixes.classes_of(s, group, row, start)
    assert [names[i] for i in order] == sorted(names)
    assert len(set(names)) == equal[-1] + 1


def test_colliding_hashes_are_found_out(monkeypatch):
    rows = np.random.default_rng(4).integers(97, 123, (30, 84)).astype(np.uint8)
    s = suffixes.Suffixes(rows, 50)
    monkeypatch.setattr(s, "hashes", lambda row, start, length: np.zeros(len(row), np.uint64))
    group, row, start = np.zeros(30, np.int64), np.arange(30), np.zeros(30, np.int64)
    order, equal = suffixes.classes_of(s, group, row, start)
    assert equal[-1] == 29 and [rows[i].tobytes() for i in order] == sorted(r.tobytes() for r in rows)


def test_kept_bytes_and_empty_table(frame, odd_texts):
    base = odd_texts[0][1]
    got = suffixes.remove_repeats(frame([(1, base), (2, "new " + base + " tail")]), with_text=True).orderBy("doc_id").collect()
    assert bytes(got[0]["kept"]).decode() == base and bytes(got[1]["kept"]).decode() == "new  tail"
    assert suffixes.remove_repeats(frame([])).count() == 0


def shuffled(spark):
    """Bytes of the shuffle files that lie on disk now, by file."""
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {path: path.stat().st_size for x in folders for path in Path(str(x)).rglob("shuffle_*.data")}


def test_shuffles_take_little_more_room_than_the_texts(spark, frame):
    draw = random.Random(5)
    passages = ["".join(draw.choices("abcdefgh ", k=300)) for _ in range(300)]
    rows = [(i, "".join("".join(draw.choices("abcdefgh ", k=500)) + draw.choice(passages) for _ in range(2))) for i in range(2500)]
    rows += [(i + 5000, t) for i, t in rows[:200]]
    docs = frame(rows).repartition(3).localCheckpoint()
    before = shuffled(spark)
    got = suffixes.remove_repeats(docs)
    assert len(got.collect()) == len(rows)
    written = sum(n for path, n in shuffled(spark).items() if path not in before)
    assert 0 < written < 1.6 * sum(len(t) for _, t in rows)
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    dealt = [line for line in plan.splitlines() if "REPARTITION_BY_NUM" in line and "k2#" in line]
    assert sum("ReusedExchange" not in line for line in dealt) == 1


def test_packed_numbers_come_back():
    odd = np.array([[-2**63, 0, 5], [-2**63, 2**63 - 1, 0], [-1, 3, 2**40], [2**63 - 1, -7, 1]])
    for numbers in (odd, odd[:1], odd[::-1], np.asfortranarray(odd), odd[:0]):
        assert (suffixes.unpack(suffixes.pack(numbers), len(numbers), 3) == numbers).all()


def test_anchors_are_named_by_their_surroundings():
    data = np.random.default_rng(6).integers(97, 123, 400).astype(np.uint8)
    found = suffixes.Anchors(data, np.array([0, 400]), 50, 16)
    contexts = np.zeros((len(found.at), 84), np.uint8)
    for row, first in zip(contexts, found.first):
        row[:len(data[first:first + 84])] = data[first:first + 84]
    numbers = np.stack([found.at, found.at, found.first, found.count, found.at - found.first], axis=1)
    row = {"n": len(numbers), "numbers": suffixes.pack(numbers), "contexts": suffixes.pa.compress(contexts, codec="zstd", asbytes=True)}
    hashes, got, _ = suffixes.unpack_contexts(row, 50, 16)
    assert (hashes == found.hash).all() and (got == numbers).all()


def test_texts_of_one_id_are_told_apart(frame):
    draw = random.Random(8)
    a, b, c = ("".join(draw.choices("abcdefghij", k=300)) for _ in range(3))
    check(frame, [(7, c + a), (7, b + c), (7, c + a), (3, a[:200]), (3, b[50:]), (9, c + b), (None, a), (None, a)])


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_whole_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text").collect()]
    from rivermart.llm import queries
    got = queries.op6_suffix_dedup(spark, f"/root/testdata/{sf}").collect()
    assert sorted(map(tuple, got)) == sorted(brute.removed(rows))
