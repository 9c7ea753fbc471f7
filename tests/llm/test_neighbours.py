"""NN-descent against brute force."""

import numpy as np
import pytest

from rivermart.llm import neighbours, queries


def truth(rows, every, nearest):
    ids = np.array([k for k, _ in rows])
    x = np.array([v for _, v in rows], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        score = x @ x[i]
        order = sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-score[j], ids[j]))[:nearest]
        out[int(ids[i])] = [(int(ids[j]), score[j]) for j in order]
    return out


def found(frame):
    out = {}
    for row in frame.collect():
        out.setdefault(row["query_id"], []).append((row["rank"], row["vec_id"], row["score"]))
    return {k: sorted(v) for k, v in out.items()}


def test_recall_and_exact_scores(frame):
    random = np.random.default_rng(7)
    centres = random.standard_normal((8, 24))
    rows = [(i, (centres[i % 8] + random.standard_normal(24) * 0.7).tolist()) for i in range(1200)]
    got = found(neighbours.nearest_neighbours(frame(rows, "vec_id long, embedding array<float>").repartition(4)))
    rows = [(k, np.array(v, np.float32).astype(float).tolist()) for k, v in rows]
    want = truth(rows, 50, 5)
    assert set(got) == set(want)
    hits = sum(len({v for _, v, _ in got[k]} & {v for v, _ in want[k]}) for k in want)
    assert hits >= 0.9 * 5 * len(want)
    scores = {(k, v): s for k, near in truth(rows, 50, 1199).items() for v, s in near}
    for query, near in got.items():
        assert [r for r, _, _ in near] == [1, 2, 3, 4, 5]
        assert all(abs(s - scores[query, v]) < 1e-12 for _, v, s in near)
        assert [(-s, v) for _, v, s in near] == sorted((-s, v) for _, v, s in near)


def test_odd_vectors_take_no_part(frame):
    rows = [(0, [1.0, 0.0]), (50, None), (100, [0.0, 0.0]), (150, [1.0, None]), (200, [float("nan"), 1.0]),
            (250, [float("inf"), 1.0]), (300, []), (None, [1.0, 1.0]), (1, [1.0, 0.1]), (2, [1.0, 0.1]), (3, [0.0, 1.0]),
            (4, [1.0, 2.0, 3.0]), (350, [3.0, 2.0, 1.0]), (2, [1.0, 0.1])]
    got = found(neighbours.nearest_neighbours(frame(rows, "vec_id long, embedding array<float>")))
    assert {k: [v for _, v, _ in near] for k, near in got.items()} == {0: [1, 2, 3], 350: [4]}


def test_few_vectors_and_none(frame):
    schema = "vec_id long, embedding array<float>"
    assert neighbours.nearest_neighbours(frame([], schema)).count() == 0
    assert neighbours.nearest_neighbours(frame([(0, [1.0])], schema)).count() == 0
    same = [(i, [1.0, 2.0]) for i in range(300)]  # all alike: ties
    got = found(neighbours.nearest_neighbours(frame(same, schema)))
    assert set(got) == {0, 50, 100, 150, 200, 250} and all(len(v) == 5 for v in got.values())
    assert all(abs(s - 1) < 1e-12 for v in got.values() for _, _, s in v)


def test_whole_table_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    got, want = found(queries.op3_nn_descent(spark, "/root/testdata/sf0.001")), truth(rows, 50, 5)
    assert set(got) == set(want)
    assert sum(len({v for _, v, _ in got[k]} & {v for v, _ in want[k]}) for k in want) >= 0.9 * 5 * len(want)


@pytest.mark.parametrize("most", [1 << 22, 300])
def test_gathered_pairs_are_the_best(monkeypatch, most):
    monkeypatch.setattr(neighbours, "HELD_PAIRS", 200)
    monkeypatch.setattr(neighbours, "MOST_PAIRS", most)
    draw = np.random.default_rng(3)
    best, every, out = neighbours._Best(4), [], []
    for _ in range(60):
        pairs = draw.integers(0, 40, 90), draw.integers(0, 40, 90)
        every.append((*pairs, (pairs[0] * 7919 + pairs[1] * 104729) % 1000 / np.float32(1000)))
        out += best.add(*every[-1])
    out += best.rows()
    given = [np.concatenate([batch.column(i).to_numpy() for batch in out]) for i in range(3)]
    expected = neighbours.best_per(*(np.concatenate(x) for x in zip(*every)), 4)
    for got, wanted in zip(neighbours.best_per(*given, 4), expected):
        assert np.array_equal(got, wanted.astype(got.dtype))


def test_pairs_that_met_before_are_not_compared_again(frame):
    draw = np.random.default_rng(5)
    rows = [(i, draw.standard_normal(16).tolist()) for i in range(600)]
    table = frame(rows, "vec_id long, embedding array<float>")
    units = neighbours.packed(neighbours.usable(table, "vec_id", "embedding")).cache()
    start = neighbours.first_graph(units, 8, 1, 32, 600, 3).cache()
    short, every, met, new = start, start, None, []
    for number in range(4):
        better, met = neighbours.improve(short, units, 8, number, met)
        short, every = better.cache(), neighbours.improve(every, units, 8, number)[0].cache()
        new.append(met.where("new").count() / met.count())
        edges = [sorted((r["a"], r["b"], round(r["score"], 4)) for r in graph.collect()) for graph in (short, every)]
        assert edges[0] == edges[1] and len(edges[0]) == 600 * 8
    assert new[0] == 1 and new[3] < 0.8
    live = {r["group"] for r in met.where("new").collect()}
    assert {r["group"] for r in met.where("live").collect()} == live


def test_state_of_a_query_is_in_packed_rows(frame, monkeypatch):
    monkeypatch.setattr(neighbours, "STATE_VECTORS", 7)
    draw = np.random.default_rng(6)
    rows = [(i, draw.standard_normal(8).tolist()) for i in range(300)]
    vectors = neighbours.usable(frame(rows, "vec_id long, embedding array<float>"), "vec_id", "embedding").cache()
    graph = neighbours.build_graph(neighbours.packed(vectors).cache(), 10).cache()
    links = {r["a"]: r["near"] for r in neighbours.links_of(neighbours.both_ways(graph, 10, 1)).collect()}
    assert set(links) == set(range(300)) and all(len(set(x)) == len(x) >= 10 for x in links.values())
    got = found(neighbours.search(vectors, graph, vectors.where("id % 50 = 0"), 5, 10, 20, 4, 6))
    rows = [(k, np.array(v, np.float32).astype(float).tolist()) for k, v in rows]
    want = truth(rows, 50, 5)
    assert sum(len({v for _, v, _ in got[k]} & {v for v, _ in want[k]}) for k in want) >= 0.9 * 5 * len(want)
