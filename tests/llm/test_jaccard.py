"""Similar sets against all pairs, and connected components."""

import random
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from rivermart.llm import jaccard, queries  # noqa: E402
from rivermart.llm.components import smallest_reachable  # noqa: E402


def found(frame):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in frame.collect()}


def test_odd_texts(frame, odd_texts):
    assert found(jaccard.similar_sets(frame(odd_texts).repartition(3))) == brute.components(odd_texts)


def near_copies():
    draw = random.Random(2)
    rows, number = [], 0
    for group in range(12):
        base = [f"w{draw.randint(0, 5000)}" for _ in range(draw.choice([1, 4, 5, 6, 12, 40, 120]))]
        for _ in range(draw.choice([1, 3, 25])):
            words = list(base)
            for _ in range(draw.choice([0, 1, 2, 3])):
                words[draw.randrange(len(words))] = f"x{draw.randint(0, 3000)}"
            rows.append((number * 7 % 1009, " ".join(words[:len(words) - draw.choice([0, 0, 1])]) + draw.choice(["", " tail"])))
            number += 1
    passage = [f"p{i}" for i in range(30)]
    for _ in range(80):  # a passage that unlike documents share
        words = [f"y{draw.randint(0, 9000)}" for _ in range(draw.choice([6, 20, 60]))]
        rows.append((number * 7 % 1009, " ".join(words + passage)))
        number += 1
    return rows


def test_groups_of_near_copies(frame):
    rows = near_copies()
    assert found(jaccard.similar_sets(frame(rows).repartition(5))) == brute.components(rows)
    assert found(jaccard.similar_sets(frame(rows), percent=60)) == brute.components(rows, 60)


def test_few_first_connections_lose_no_link(frame, monkeypatch):
    monkeypatch.setattr(jaccard, "HUBS", 1)
    monkeypatch.setattr(jaccard, "STAR_TOKENS", 1)
    monkeypatch.setattr(jaccard, "SEND_TOKENS", 50)
    rows = near_copies()
    assert found(jaccard.similar_sets(frame(rows))) == brute.components(rows)


def test_missing_ids_repeated_rows_and_empty_table(frame, odd_texts):
    rows = odd_texts + [odd_texts[0], (None, "alone without an id"), (None, odd_texts[0][1])]
    got = [tuple(r) for r in jaccard.similar_sets(frame(rows)).collect()]
    assert len(got) == len(rows)
    assert sorted(r[2] or -1 for r in got if r[0] is None) == [-1, 1]
    assert jaccard.similar_sets(frame([])).count() == 0


def test_one_of_each_group_stays(frame, odd_texts):
    kept = jaccard.keep_one(frame(odd_texts))
    want = {k for k, (_, c) in brute.components(odd_texts).items() if k == c}
    assert {r["doc_id"] for r in kept.collect()} == want and "component" in kept.columns


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(300, 300), (260, 12)]
    got = {r["node"]: r["component"] for r in smallest_reachable(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 161)} == {100} and {got[i] for i in range(200, 260)} == {7}
    assert got[260] == 12 and 300 not in got
    assert smallest_reachable(spark.createDataFrame([], "a long, b long")).count() == 0


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert found(queries.op8_jaccard_components(spark, "/root/testdata/sf0.001")) == brute.components(rows)
