"""Operator 3: nearest neighbours by cosine from a graph that improves itself.

NN-descent: a vector's neighbours' neighbours are likely its neighbours. Each
round sends every vector to the vectors it is a neighbour of and to its own
neighbours (a join and a shuffle by the vector they meet at); those that meet
there are compared with each other, and each keeps its best. The graph starts from the leaves of a few
random-projection trees, fitted on a bounded sample; all vectors are in it.

Queries walk the graph: the beam of a query holds the best vectors seen, and
each round joins the graph's links of the best ones not followed yet. Scores are
exact cosines in double precision of the original vectors.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from rivermart.llm import common

#: Links kept for each vector.
LINKS = 30
#: Trees and leaf size of the first graph; trees are fitted on so many vectors at most.
TREES, LEAF, FIT_VECTORS = 5, 128, 8192
ROUNDS = 5
#: Vectors in a query's beam, links followed in a round, and rounds at most.
BEAM, FOLLOWED, WALKS = 128, 64, 8
SEED = 11
EDGES = [("a", pa.int64()), ("b", pa.int64()), ("score", pa.float32())]
EDGES_SCHEMA = "a long, b long, score float"
#: Pairs that a task holds before it keeps the best of each vector only, and before it hands them on.
HELD_PAIRS, MOST_PAIRS = 1 << 20, 1 << 22
GATHERED_PAIRS = 1 << 17


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id, v (array of double) and n (its norm) of the vectors that take part; one row for each id."""
    rows = vectors.select(F.col(id_column).cast("long").alias("id"),
                          F.col(vector_column).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & finite)
    rows = rows.withColumn("n", F.sqrt(F.aggregate("v", F.lit(0.0).cast("double"), lambda total, x: total + x * x)))
    return rows.where(F.col("n") > 0).where(F.col("n") < float("inf")).groupBy("id").agg(
        F.min(F.struct("v", "n")).alias("row")).select("id", "row.v", "row.n")


def best_per(a: np.ndarray, b: np.ndarray, score: np.ndarray, keep: int
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``keep`` best distinct b of each a, best first, ties to the smaller b."""
    order = np.lexsort((b, -score, a))
    a, b, score = a[order], b[order], score[order]
    # Equal pairs have nearly equal scores: drop the later ones by a second sort.
    by = np.lexsort((np.arange(len(a)), b, a))
    first = np.ones(len(a), bool)
    first[by[1:]] = (a[by[1:]] != a[by[:-1]]) | (b[by[1:]] != b[by[:-1]])
    a, b, score = a[first], b[first], score[first]
    rank = np.arange(len(a)) - np.searchsorted(a, a, "left")
    top = rank < keep
    return a[top], b[top], score[top]


class _Best:
    """Gathers scored pairs and gives the best of each vector that this task knows.

    Once a vector has as many as it keeps, pairs below its worst are not taken. The
    held pairs are sorted when they have doubled; beyond ``MOST_PAIRS`` they are handed on,
    to be joined with other tasks' pairs, and gathering starts anew.
    """

    def __init__(self, keep: int):
        self.keep = keep
        self._clear()

    def _clear(self) -> None:
        self.held, self.count, self.limit = [], 0, HELD_PAIRS
        self.full, self.worst = np.zeros(0, np.int64), np.zeros(0, np.float32)

    def add(self, a: np.ndarray, b: np.ndarray, score: np.ndarray):
        score = score.astype(np.float32)
        if len(self.full):
            at = np.minimum(np.searchsorted(self.full, a), len(self.full) - 1)
            good = (self.full[at] != a) | (score >= self.worst[at])
            a, b, score = a[good], b[good], score[good]
        self.held.append((a, b, score))
        self.count += len(a)
        if self.count > self.limit:
            self._shrink()
            if self.count > MOST_PAIRS:
                yield from self.rows()
                self._clear()

    def _shrink(self) -> None:
        a, b, score = best_per(*(np.concatenate(x) for x in zip(*self.held)), self.keep)
        self.held, self.count, self.limit = [(a, b, score)], len(a), max(HELD_PAIRS, 2 * len(a))
        ends = np.flatnonzero(np.append(a[1:] != a[:-1], True)) if len(a) else np.zeros(0, np.int64)
        whole = np.diff(ends, prepend=-1) >= self.keep
        self.full, self.worst = a[ends[whole]], score[ends[whole]]

    def rows(self):
        if self.held:
            self._shrink()
            a, b, score = self.held[0]
            for i in range(0, len(a), 50_000):
                yield common.batch_of(EDGES, a[i:i + 50_000], b[i:i + 50_000], score[i:i + 50_000])


def numpy_columns(batches) -> list[np.ndarray] | None:
    """All rows of the batches as an array for each column, or None if there is none."""
    held = [[column.to_numpy(zero_copy_only=False) for column in batch.columns] for batch in batches if batch.num_rows]
    return [np.concatenate(x) for x in zip(*held)] or None


def kept_best(pairs: DataFrame, keep: int) -> DataFrame:
    """The best ``keep`` links of every vector from scored pairs."""

    def choose(batches):
        held = numpy_columns(batches)
        if held:
            a, b, score = best_per(*held, keep)
            for i in range(0, len(a), 50_000):
                yield common.batch_of(EDGES, a[i:i + 50_000], b[i:i + 50_000], score[i:i + 50_000])

    return common.map_arrow(pairs.repartition("a"), choose, EDGES_SCHEMA)


def matrix(column: pa.Array, kind: str = "<f2") -> np.ndarray:
    """Vectors of one dimension, packed as bytes, as rows."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2].slice(ends[0], ends[-1] - ends[0])
    return np.frombuffer(data, kind).reshape(len(column), -1).astype(np.float32)


def packed(vectors: DataFrame, kind: str = "<f2") -> DataFrame:
    """id, dim and the vectors of length one as bytes; the graph is built from halves of the usual precision."""
    kinds = [("id", pa.int64()), ("dim", pa.int32()), ("unit", pa.binary())]

    def pack(batches):
        for batch in batches:
            column, norms = batch.column(1), batch.column(2).to_numpy()
            dims = pc.list_value_length(column).to_numpy()
            units = (column.flatten().to_numpy() / np.repeat(norms, dims)).astype(kind)
            ends = np.concatenate([[0], np.cumsum(dims)]) * units.itemsize
            unit = pa.Array.from_buffers(pa.binary(), len(dims), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(units)])
            yield common.batch_of(kinds, batch.column(0), dims, unit)

    return common.map_arrow(vectors.select("id", "v", "n"), pack, "id long, dim int, unit binary")


def fit_trees(sample: dict[int, np.ndarray], trees: int, leaf: int, rows: int, seed: int) -> dict:
    """For each dimension the splits of every tree: a direction and a median at each inner node."""
    random = np.random.default_rng(seed)
    out = {}
    for dim, vectors in sorted(sample.items()):
        depth = max(0, min(math.ceil(math.log2(max(1, rows / leaf))), int(math.log2(max(1, len(vectors) / 8)))))
        for tree in range(trees):
            nodes, place = [], np.zeros(len(vectors), np.int64)
            for level in range(depth):
                directions = random.standard_normal((2 ** level, dim)).astype(np.float32)
                for node in range(2 ** level):  # between two vectors of the node, if there are two
                    inside = np.flatnonzero(place == node)
                    if len(inside) > 1:
                        i, j = random.choice(inside, 2, replace=False)
                        if not np.array_equal(vectors[i], vectors[j]):
                            directions[node] = vectors[i] - vectors[j]
                along = (vectors * directions[place]).sum(axis=1)
                middles = np.array([np.median(along[place == node]) if (place == node).any() else 0.0
                                    for node in range(2 ** level)], np.float32)
                place = place * 2 + (along > middles[place])
                nodes.append((directions, middles))
            out[dim, tree] = nodes
    return out


def first_graph(units: DataFrame, links: int, trees: int, leaf: int, fit_vectors: int, seed: int) -> DataFrame:
    """The best links inside the leaves of random-projection trees.

    A leaf with more rows than three times ``leaf`` is cut by a hash of the id,
    so no leaf is a large group, however alike the vectors are.
    """
    spark = units.sparkSession
    rows = units.count()
    draw = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    chosen = units.where(draw < min(1.0, fit_vectors / max(1, rows))).limit(2 * fit_vectors).collect()
    sample: dict[int, list] = {}
    for row in chosen:
        sample.setdefault(row["dim"], []).append(np.frombuffer(row["unit"], "<f2").astype(np.float32))
    model = spark.sparkContext.broadcast(fit_trees({d: np.stack(v) for d, v in sample.items()}, trees, leaf, rows, seed))
    kinds = [("id", pa.int64()), ("dim", pa.int32()), ("tree", pa.int32()), ("leaf", pa.int64()), ("unit", pa.binary())]

    def place(batches):
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims).tolist():
                at = pa.array(np.flatnonzero(dims == dim))
                ids, column = batch.column(0).take(at), batch.column(2).take(at)
                vectors = matrix(column)
                for tree in range(trees):
                    leaf_of = np.zeros(len(at), np.int64)
                    for directions, middles in model.value.get((dim, tree), ()):
                        along = np.einsum("ij,ij->i", vectors, directions[leaf_of])
                        leaf_of = leaf_of * 2 + (along > middles[leaf_of])
                    yield common.batch_of(kinds, ids, [dim] * len(at), [tree] * len(at), leaf_of, column)

    placed = common.map_arrow(units, place, "id long, dim int, tree int, leaf long, unit binary")
    group = ["dim", "tree", "leaf"]
    sizes = placed.groupBy(*group).agg(F.count("*").alias("size"))
    cut = F.pmod(F.xxhash64("id", F.lit(seed), "tree"), F.ceil(F.col("size") / (2 * leaf)))
    placed = placed.join(F.broadcast(sizes), group).withColumn(  # as many sizes as leaves: bounded by the trees
        "part", F.when(F.col("size") > 3 * leaf, cut).otherwise(F.lit(0)))
    dealt = placed.select(F.xxhash64("dim", "tree", "leaf", "part").alias("group"), "dim", "id", "unit").repartition(
        "group").sortWithinPartitions("group", "id")

    def compare(batches):
        best = _Best(links)
        for ids, vectors in groups(batches):
            score = vectors @ vectors.T
            np.fill_diagonal(score, -2)
            k = min(links, len(ids) - 1)
            if k > 0:
                top = np.argpartition(-score, k - 1, axis=1)[:, :k]
                yield from best.add(np.repeat(ids, k), ids[top].ravel(), np.take_along_axis(score, top, axis=1).ravel())
        yield from best.rows()

    return kept_best(common.map_arrow(dealt, compare, EDGES_SCHEMA), links)


def groups(batches, more: int = 0):
    """Ids, vectors and ``more`` further columns of every run of rows (group, dim, id, unit, ...) sorted by group."""
    key, held = None, []
    for batch in batches:
        names, dims = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        numbers, column = batch.column(2).to_numpy(), batch.column(3)
        others = [batch.column(4 + i).to_numpy(zero_copy_only=False) for i in range(more)]
        changes = np.flatnonzero(np.diff(dims)) + 1
        for first, last in zip([0, *changes], [*changes, len(dims)]):
            if first == last:
                continue
            vectors = matrix(column.slice(first, last - first))
            edges = [first, *(np.flatnonzero(np.diff(names[first:last])) + first + 1).tolist(), last]
            for low, high in zip(edges[:-1], edges[1:]):
                if (names[low], dims[low]) != key:
                    if held:
                        yield joined(held)
                    key, held = (names[low], dims[low]), []
                held.append((numbers[low:high], vectors[low - first:high - first], *(x[low:high] for x in others)))
    if held:
        yield joined(held)


def joined(parts: list[tuple]) -> tuple:
    return parts[0] if len(parts) == 1 else tuple(np.concatenate(x) for x in zip(*parts))


MET = [("group", pa.int64()), ("id", pa.int64()), ("new", pa.bool_()), ("live", pa.bool_())]
MET_SCHEMA = "group long, id long, new boolean, live boolean"
FORWARD, BACKWARD, BEFORE = 0, 1, 2


def drawn(a: np.ndarray, b: np.ndarray, draw: np.ndarray, links: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``links`` b of each a with the smallest draws."""
    order = np.lexsort((draw, a))
    a, b, draw = a[order], b[order], draw[order]
    take = np.arange(len(a)) - np.searchsorted(a, a, "left") < links
    return a[take], b[take], draw[take]


def both_ways(graph: DataFrame, links: int, seed: int, before: DataFrame | None = None) -> DataFrame:
    """group, id, new, live: who meets at each vector, which are its links, and backward links drawn by hash,
    as many at most; whether they did not in the round ``before``, and whether anyone there did not.

    So a vector that is very many vectors' neighbour is no large group. The draw
    is made per task before the shuffle and again after.
    """
    kinds = [("a", pa.int64()), ("b", pa.int64()), ("draw", pa.int64())]

    def draw(batches):
        held = numpy_columns(batches)
        if held:
            yield common.batch_of(kinds, *drawn(*held, links))

    def meet(batches):
        held = numpy_columns(batches)
        if not held:
            return
        a, b, number, kind = held
        back = drawn(*(x[kind == BACKWARD] for x in (a, b, number)), links)
        a, b, old = (np.concatenate(x) for x in (
            (a[kind == FORWARD], back[0], a[kind == BEFORE]), (b[kind == FORWARD], back[1], b[kind == BEFORE]),
            (np.zeros((kind == FORWARD).sum() + len(back[0]), bool), np.ones((kind == BEFORE).sum(), bool))))
        order = np.lexsort((old, b, a))
        a, b, old = a[order], b[order], old[order]
        first = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
        known = np.logical_or.reduceat(old, np.flatnonzero(first))
        now = ~old[first]
        a, b, new = a[first][now], b[first][now], ~known[now]
        live = np.isin(a, a[new])
        for i in range(0, len(a), 50_000):
            yield common.batch_of(MET, *(x[i:i + 50_000] for x in (a, b, new, live)))

    back = graph.select(F.col("b").alias("a"), F.col("a").alias("b"), F.xxhash64("a", "b", F.lit(seed)).alias("draw"))
    back = common.map_arrow(back, draw, "a long, b long, draw long")
    rows = graph.select("a", "b", F.lit(0).cast("long").alias("draw"), F.lit(FORWARD).alias("kind")).union(
        back.withColumn("kind", F.lit(BACKWARD)))
    if before is not None:
        rows = rows.union(before.select("group", "id", F.lit(0).cast("long"), F.lit(BEFORE)))
    return common.map_arrow(rows.repartition("a"), meet, MET_SCHEMA)


def improve(graph: DataFrame, units: DataFrame, links: int, seed: int, before: DataFrame | None = None
            ) -> tuple[DataFrame, DataFrame]:
    """One round of NN-descent: neighbours of a vector, and those it is a neighbour of, meet at it.

    Pairs that met at the same vector in the round ``before`` were compared then: either they are links
    or the vectors have had ``links`` better ones since. The new graph and the round's meetings are returned.
    """
    met = common.stored(both_ways(graph, links, seed, before), "meetings")
    worst = graph.groupBy(F.col("a").alias("id")).agg(
        F.when(F.count("*") >= links, F.min("score")).otherwise(F.lit(-2.0)).cast("float").alias("worst"))
    dealt = met.where("live").join(units.join(worst, "id", "left"), "id").select(
        "group", "dim", "id", "unit", "new", F.coalesce("worst", F.lit(-2.0)).cast("float").alias("worst")).repartition(
        "group").sortWithinPartitions("group", "dim")

    def compare(batches):
        best, held, count = _Best(links), [], 0
        for ids, vectors, new, worst in groups(batches, 2):
            at = np.flatnonzero(new)
            if not len(at) or len(ids) < 2:
                continue
            score = vectors[at] @ vectors.T
            score[np.arange(len(at)), at] = -3
            i, j = np.nonzero(score >= worst[at, None])
            held.append((ids[at[i]], ids[j], score[i, j]))
            score[:, at] = -3  # the other way of a pair of new ones is there already
            i, j = np.nonzero(score >= worst)
            held.append((ids[j], ids[at[i]], score[i, j]))
            count += len(held[-1][0]) + len(held[-2][0])
            if count > GATHERED_PAIRS:
                yield from best.add(*joined(held))
                held, count = [], 0
        if held:
            yield from best.add(*joined(held))
        yield from best.rows()

    return kept_best(common.map_arrow(dealt, compare, EDGES_SCHEMA).union(graph), links), met


def build_graph(units: DataFrame, links: int = LINKS, trees: int = TREES, leaf: int = LEAF,
                fit_vectors: int = FIT_VECTORS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """a, b, score: the links of every vector."""
    graph = common.stored(first_graph(units, links, trees, leaf, fit_vectors, seed), "graph")
    met = None
    for number in range(rounds):
        better, met = improve(graph, units, links, seed + number, met)
        graph = common.stored(better, "graph")
    return graph


#: Vectors of a query that one row of its state holds.
STATE_VECTORS = 1024
LONGS, DOUBLES, FLAGS = pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.bool_())
STATE = [("query_id", pa.int64()), ("vecs", LONGS), ("scores", DOUBLES), ("done", FLAGS), ("follow", LONGS)]
STATE_SCHEMA = "query_id long, vecs array<long>, scores array<double>, done array<boolean>, follow array<long>"


def flat(keys: pa.Array, *lists: pa.Array) -> list[np.ndarray]:
    """Arrays of equal lengths in each row, on end, behind the row's key as often; a null is an empty one."""
    lengths = pc.list_value_length(lists[0]).fill_null(0).to_numpy()
    return [np.repeat(keys.to_numpy(), lengths), *(x.flatten().to_numpy(zero_copy_only=False) for x in lists)]


def lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Rows of the values between the ``ends``."""
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind.value_type))


def links_of(met: DataFrame) -> DataFrame:
    """a, near: all that ``both_ways`` lets meet at a vector in one row."""
    kinds = [("a", pa.int64()), ("near", LONGS)]

    def gather(batches):
        held = numpy_columns(batch.select([0, 1]) for batch in batches)
        if held:
            a, b = held
            edges = np.append(np.flatnonzero(np.append(True, a[1:] != a[:-1])), len(a))  # sorted within a task
            for i in range(0, len(edges) - 1, 1000):
                ends = edges[i:i + 1001]
                yield common.batch_of(kinds, a[ends[:-1]], lists(b[ends[0]:ends[-1]], ends - ends[0], LONGS))

    return common.map_arrow(met, gather, "a long, near array<long>")


def not_seen(batches):
    """(query_id, vec_id) for each new pair; rows of a query are in one task, which say whether theirs were seen."""
    held = []
    for batch in batches:
        query, vec = flat(batch.column(0), batch.column(1))
        lengths = pc.list_value_length(batch.column(1)).fill_null(0).to_numpy()
        held.append((query, vec, np.repeat(batch.column(2).to_numpy(zero_copy_only=False), lengths)))
    if not held:
        return
    query, vec, known = (np.concatenate(x) for x in zip(*held))
    order = np.lexsort((~known, vec, query))  # seen ones first
    query, vec, known = query[order], vec[order], known[order]
    first = np.ones(len(query), bool)
    first[1:] = (query[1:] != query[:-1]) | (vec[1:] != vec[:-1])
    pick = first & ~known & (query != vec)
    query, vec = query[pick], vec[pick]
    out = [("query_id", pa.int64()), ("vec_id", pa.int64())]
    for i in range(0, len(query), 50_000):
        yield common.batch_of(out, query[i:i + 50_000], vec[i:i + 50_000])


def scored(batches):
    """(query_id, vec_id, score) arrays of rows (query_id, vec_id, unit, ...) sorted by query_id, the query's
    own unit ahead, with no vec_id; vectors of another length than the query's are left out."""
    last, own = None, None
    for batch in batches:
        rows = batch.filter(pc.is_valid(batch.column(2)))
        if not rows.num_rows:
            yield batch, None
            continue
        query, column = rows.column(0).to_numpy(), rows.column(2)
        asked = np.asarray(pc.is_null(rows.column(1)))
        sizes = pc.binary_length(column).to_numpy()
        units = {int(query[i]): column[int(i)] for i in np.flatnonzero(asked)}
        if last is not None:
            units.setdefault(last, own)
        last = int(query[-1])
        own = units[last]
        names = np.array(sorted(units), np.int64)
        mine = pa.array([units[int(x)].as_py() for x in names], pa.binary())
        place = np.searchsorted(names, query)
        wanted = pc.binary_length(mine).to_numpy()[place]
        parts = []
        for size in np.unique(sizes[~asked]).tolist():
            at = np.flatnonzero((sizes == size) & ~asked & (wanted == size))
            if len(at):
                there, here = matrix(column.take(pa.array(at)), "<f4"), matrix(mine.take(pa.array(place[at])), "<f4")
                parts.append((query[at], rows.column(1).take(pa.array(at)).to_numpy(),
                              np.einsum("ij,ij->i", there, here).astype(float)))
        yield batch, joined(parts) if parts else None


def search(vectors: DataFrame, graph: DataFrame, queries: DataFrame, nearest: int, links: int = LINKS,
           beam: int = BEAM, followed: int = FOLLOWED, walks: int = WALKS) -> DataFrame:
    """query_id, rank, vec_id, score of the nearest found for ``queries`` (id, v, n).

    The walk starts at the query's own links. It ends when no query has a vector
    in its beam that it has not followed, after ``walks`` rounds at most. It
    compares in single precision; the best are then scored exactly.
    """
    links = common.stored(links_of(both_ways(graph, links, SEED)), "links")
    units = common.stored(packed(vectors, "<f4"), "units")
    none = F.lit(None)
    asked = common.stored(units.join(queries.select("id"), "id").select(F.col("id").alias("query_id"), "unit"), "asked")
    now = asked.select("query_id", F.col("query_id").alias("a"))
    seen = None

    def go_on(batches):
        held = []
        for batch, pairs in scored(batches):
            if pairs is not None:
                held.append((*pairs, np.zeros(len(pairs[0]), bool)))
            held.append(flat(batch.column(0), *(batch.column(i) for i in (3, 4, 5))))
        if not held:
            return
        query, vec, score, done = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((vec, -score, query))
        query, vec, score, done = query[order], vec[order], score[order], done[order].astype(bool)
        place = np.arange(len(query)) - np.searchsorted(query, query, "left")
        pick = np.flatnonzero((place < beam) & ~done)
        pick = pick[np.arange(len(pick)) - np.searchsorted(query[pick], query[pick], "left") < followed]
        done[pick] = True
        edges = np.append(np.flatnonzero(place % STATE_VECTORS == 0), len(query))
        for i in range(0, len(edges) - 1, 100):
            ends = edges[i:i + 101]
            low, high = ends[0], ends[-1]
            follow = np.searchsorted(pick, ends)
            yield common.batch_of(STATE, query[ends[:-1]], lists(vec[low:high], ends - low, LONGS),
                                  lists(score[low:high], ends - low, DOUBLES), lists(done[low:high], ends - low, FLAGS),
                                  lists(vec[pick[follow[0]:follow[-1]]], follow - follow[0], LONGS))

    for _ in range(walks):
        reached = now.join(links, "a").select("query_id", "near", F.lit(False).alias("seen"))
        if seen is not None:
            reached = reached.union(seen.select("query_id", "vecs", F.lit(True)))
        new = common.map_arrow(reached.repartition("query_id"), not_seen, "query_id long, vec_id long")
        state = [none.cast(kind).alias(name) for name, kind in (
            ("vecs", "array<long>"), ("scores", "array<double>"), ("done", "array<boolean>"))]
        rows = new.join(units.withColumnRenamed("id", "vec_id"), "vec_id").select("query_id", "vec_id", "unit", *state)
        rows = rows.union(asked.select("query_id", none.cast("long"), "unit", *state))
        if seen is not None:
            rows = rows.union(seen.select("query_id", none.cast("long"), none.cast("binary"), "vecs", "scores", "done"))
        rows = rows.repartition("query_id").sortWithinPartitions("query_id", F.col("vec_id").isNotNull())
        seen = common.stored(common.map_arrow(rows, go_on, STATE_SCHEMA), "walk")
        now = seen.select("query_id", F.explode("follow").alias("a"))
        if now.isEmpty():
            break

    def finalists(batches):
        held = [flat(batch.column(0), batch.column(1), batch.column(2)) for batch in batches]
        if held:
            query, vec, score = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((vec, -score, query))
            query, vec = query[order], vec[order]
            top = np.arange(len(query)) - np.searchsorted(query, query, "left") < 4 * nearest
            yield common.batch_of([("query_id", pa.int64()), ("vec_id", pa.int64())], query[top], vec[top])

    best = common.map_arrow(seen.select("query_id", "vecs", "scores").repartition("query_id"), finalists,
                            "query_id long, vec_id long")
    there = vectors.select(F.col("id").alias("vec_id"), "v", "n")
    mine = queries.select(F.col("id").alias("query_id"), F.col("v").alias("q"), F.col("n").alias("qn"))
    dot = F.aggregate(F.zip_with("q", "v", lambda x, y: x * y), F.lit(0.0).cast("double"), lambda total, x: total + x)
    exact = best.join(there, "vec_id").join(mine, "query_id").where(F.size("q") == F.size("v")).select(
        "query_id", "vec_id", (dot / (F.col("qn") * F.col("n"))).alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")  # at most 4 * nearest rows each
    return exact.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest).select(
        "query_id", "rank", "vec_id", "score")


def nearest_neighbours(table: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
                       every: int = 50, nearest: int = 5) -> DataFrame:
    """The ``nearest`` found for each row whose id is divisible by ``every``.

    Vectors that are null, zero or hold null or non-finite components take no
    part; vectors of different lengths are not compared; of rows of an equal id
    the smallest vector counts; other columns are ignored. An empty table, or
    one vector alone, gives no row. Ties go to the smaller id.
    """
    spark = table.sparkSession
    common.prepare(spark)
    vectors = common.stored(usable(table, id_column, vector_column), "vectors")
    units = common.stored(packed(vectors), "units")
    graph = build_graph(units)
    return search(vectors, graph, vectors.where(F.col("id") % every == 0), nearest)
