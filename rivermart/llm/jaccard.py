"""Operator 8: documents that share three quarters of their word shingles.

Prefix filters under several global token orders:

1. Under a first order (by hash) each document sends the front half of its set.
   Two linked documents share at least ``need`` tokens of those fronts, so a
   document that does not share so many with anybody is done. A front is short
   on the wire: tokens travel as packed arrays, dealt by token.
2. The others, usually few, take a second order, rarest token first. Linked
   documents share a token of the shortest prefix under it.
3. Such candidates must also share a prefix token under a third order (another
   hash) before their whole sets are compared.

Candidates are not all pairs of a token's documents: first each document meets
only the few most typical ones of some tokens, and documents already connected
are not compared again. Two sets of n and m tokens of which k and l occur in any
other set cannot link if min(k, l) is below the overlap that n and m need. Only components are asked for, so no link that matters is lost.
Documents of equal sets count as one throughout.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rivermart.llm import common
from rivermart.llm.components import smallest_reachable

#: Bytes of text for each partition that counts tokens.
PARTITION_BYTES = 12 << 20
#: A task sends what it has gathered once it holds so many tokens.
SEND_TOKENS = 1 << 20
FRONTS = [("bucket", pa.int32()), ("tokens", pa.binary()), ("owners", pa.binary()), ("sets", pa.binary()),
          ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64()))]
FRONTS_SCHEMA = ("bucket int, tokens binary, owners binary, sets binary, "
                 "doc_ids array<long>, sizes array<long>")
COUNTS = [("set_id", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("shared", pa.int64())]
#: For a first connection: tokens of each document, and documents of each token that the others meet.
STAR_TOKENS, HUBS = 3, 4
SECOND, THIRD = np.uint64(0xA0761D6478BD642F), 0x2545F4914F6CDD1D


def overlap_needed(n, percent: int):
    """Tokens that a set of n shares at least with any set it links to."""
    return -(-n * percent // 100)


def front_length(n, percent: int):
    return n - overlap_needed(n, percent) + n // 4 + 1


def front_shared(n, percent: int):
    """Tokens of its front that a linked set of n shares at least with fronts of others."""
    return overlap_needed(n, percent) // 4 + 1


def shingle_sets(column: pa.Array, size: int):
    """Chunks (low, high, sorted distinct hashes, bounds) of a column of texts."""
    common.claim("sets")
    data, bounds = common.utf8(column)
    for low, high in common.chunks(bounds):
        own = bounds[low:high + 1] - bounds[low]
        hashes, texts, _, _ = common.words(data[bounds[low]:bounds[high]], own)
        yield low, high, *common.distinct_per_text(*common.shingles(hashes, texts, high - low, size), high - low)


def _fronts(docs: DataFrame, size: int, percent: int, parts: int) -> DataFrame:
    def send(batches):
        held, sets, count = [], 0, 0
        names: list[list] = []

        def rows():
            tokens = np.concatenate([t for t, _, _ in held])
            owners = np.concatenate([o for _, o, _ in held])
            ids = np.concatenate([s for _, _, s in held])
            bucket = (common.mix(tokens * SECOND) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            tokens, owners = tokens[order], owners[order]
            ends = np.searchsorted(bucket[order], np.arange(parts + 1))
            for i in range(parts):
                a, b = ends[i], ends[i + 1]
                if a < b:
                    used, at = np.unique(owners[a:b], return_inverse=True)
                    yield common.batch_of(FRONTS, [i], [tokens[a:b].tobytes()], [at.astype("<u4").tobytes()],
                                          [ids[used].tobytes()], [None], [None])

        for number, batch in enumerate(batches):
            keys = batch.column(0)
            for low, high, hashes, bounds in shingle_sets(batch.column(1), size):
                n = np.diff(bounds)
                # A set's id: the sum of its mixed hashes, and its size.
                sums = np.zeros(len(hashes) + 1, np.uint64)
                np.cumsum(common.mix(hashes ^ SECOND), out=sums[1:])
                ids = common.mix(sums[bounds[1:]] - sums[bounds[:-1]] + n.astype(np.uint64)).view(np.int64)
                yield common.batch_of(FRONTS, [(number + low) % parts], [None], [None], [ids.tobytes()],
                                      [keys.slice(low, high - low).to_pylist()], [n])
                _, first = np.unique(ids, return_index=True)  # equal sets go once
                take = np.zeros(len(n), np.int64)
                take[first] = np.minimum(front_length(n, percent), n)[first]
                ranks = np.arange(len(hashes)) - np.repeat(bounds[:-1], n)
                mask = ranks < np.repeat(take, n)
                held.append((hashes[mask], np.repeat(np.arange(len(n)), n)[mask] + sets, ids))
                sets, count = sets + len(n), count + int(mask.sum())
                if count >= SEND_TOKENS:
                    yield from rows()
                    held, sets, count = [], 0, 0
        if held:
            yield from rows()

    return common.map_arrow(docs, send, FRONTS_SCHEMA)


def _shared(fronts: DataFrame) -> DataFrame:
    """(set_id, doc_id, n) of every document and (set_id, shared) of the sets in each bucket."""

    def count(batches):
        common.claim("sets")
        tokens, owners = [], []
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["sets"], np.int64)
                if row["doc_ids"] is not None:
                    yield common.batch_of(COUNTS, ids, row["doc_ids"], row["sizes"], pa.nulls(len(ids), pa.int64()))
                else:
                    tokens.append(np.frombuffer(row["tokens"], np.uint64))
                    owners.append(ids[np.frombuffer(row["owners"], "<u4")])
        if not tokens:
            return
        tokens, owners = np.concatenate(tokens), np.concatenate(owners)
        order = np.lexsort((owners, tokens))
        tokens, owners = tokens[order], owners[order]
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (owners[1:] != owners[:-1])
        tokens, owners = tokens[new], owners[new]
        same = tokens[1:] == tokens[:-1]
        shared = np.zeros(len(tokens), bool)
        shared[1:] |= same
        shared[:-1] |= same
        ids, counts = np.unique(owners[shared], return_counts=True)
        for i in range(0, len(ids), 10_000):
            part = ids[i:i + 10_000]
            yield common.batch_of(COUNTS, part, pa.nulls(len(part), pa.int64()), pa.nulls(len(part), pa.int64()),
                                  counts[i:i + 10_000])

    return common.map_arrow(fronts, count, "set_id long, doc_id long, n long, shared long")


def _sets(docs: DataFrame, size: int) -> DataFrame:
    kinds = [("node", pa.int64()), ("n", pa.int64()), ("tokens", pa.list_(pa.int64()))]

    def make(batches):
        for batch in batches:
            for low, high, hashes, bounds in shingle_sets(batch.column(1), size):
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(hashes.view(np.int64)))
                yield common.batch_of(kinds, batch.column(0).slice(low, high - low), np.diff(bounds), lists)

    return common.map_arrow(docs, make, "node long, n long, tokens array<long>")


def _may_link(n: str, k: str, m: str, l: str, percent: int):
    """Whether sets of n and m tokens, k and l of them known to others, can link at all."""
    return F.least(F.col(k), F.col(l)) * (100 + percent) >= (F.col(n) + F.col(m)) * percent


def _near_pairs(prefixes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that connect most of a group of near copies: each document with the few most
    typical ones of its most widespread tokens. Typical is whose tokens are known to others."""
    some = prefixes.select("node", "n", "k", F.explode(F.slice("prefix", -F.least(F.size("prefix"), F.lit(STAR_TOKENS)),
                                                               STAR_TOKENS)).alias("token"))
    # Any document with the token in its prefix may be the one to meet: a typical one has a long prefix.
    every = prefixes.select("node", "n", "k", F.explode("prefix").alias("token"))
    order = Window.partitionBy("token").orderBy((F.col("n") - F.col("k")) / F.col("n"), "node")
    hubs = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= HUBS).select(
        "token", F.col("node").alias("hub"), F.col("n").alias("m"), F.col("k").alias("l"))
    return some.join(hubs, "token").where("node <> hub").where(_may_link("n", "k", "m", "l", percent)).select(
        F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link: the third order's prefixes first, then the whole sets."""
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x"), F.col("third").alias("u"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"), F.col("third").alias("v"))
    found = pairs.join(left, "a").where(F.size("x") > 0).join(right, "b").where(F.arrays_overlap("u", "v"))
    common_tokens = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - common_tokens
    return found.where(common_tokens * 100 >= union * percent).select("a", "b")


def similar_sets(docs: DataFrame, size: int = common.SHINGLE_WORDS, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id, text).

    Words are runs of bytes other than the six ASCII spaces, A-Z as a-z; a text
    of fewer than ``size`` words has its whole sequence as one shingle. A null
    or empty text has no shingle and links with nothing: its component is its
    own doc_id. Sets link when 100 * intersection >= percent * union, for
    ``percent`` from 50 to 100. Shingles are told apart by 64-bit hashes. Rows
    of an equal doc_id are one document's rows if their texts are equal; other
    columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    common.prepare(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), common.text_bytes(docs) // PARTITION_BYTES + 1)
    fronts = _fronts(docs, size, percent, parts).repartition(parts, "bucket")
    counted = common.stored(_shared(fronts), "jaccard-counts")
    members = counted.where("n is not null").select("doc_id", "n", "set_id")
    classes = counted.groupBy("set_id").agg(
        F.min("doc_id").alias("node"), F.max("n").alias("n"), F.coalesce(F.sum("shared"), F.lit(0)).alias("shared"))
    classes = common.stored(classes, "jaccard-classes")
    need = F.floor(F.ceil(F.col("n") * percent / 100) / 4) + 1
    chosen = classes.where(F.col("n") > 0).where(F.col("shared") >= need).select(F.col("node").alias("doc_id"))
    sets = _sets(docs.join(chosen, "doc_id", "left_semi").dropDuplicates(["doc_id"]), size)
    third = F.slice(F.array_sort(F.transform("tokens", lambda t: F.xxhash64(t, F.lit(THIRD)))), F.lit(1),
                    (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int"))
    sets = common.stored(sets.withColumn("third", third), "jaccard-sets")

    each = sets.select("node", "n", F.explode("tokens").alias("token"))
    often = each.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    ranked = each.join(often, "token").groupBy("node", "n").agg(
        F.array_sort(F.collect_list(F.struct("df", "token"))).alias("known"))
    # Tokens of no other document come first under this order and take up places of the prefix.
    places = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - (F.col("n") - F.size("known"))
    prefixes = ranked.where(places > 0).select(
        "node", "n", F.size("known").alias("k"), F.slice("known", F.lit(1), places.cast("int"))["token"].alias("prefix"))
    prefixes = common.stored(prefixes, "jaccard-prefixes")

    near = common.stored(_near_pairs(prefixes, percent), "jaccard-near")
    links = common.stored(_links(near, sets, percent), "jaccard-links")
    first = smallest_reachable(links)

    # A token's place counts the document's own tokens, which come first.
    placed = prefixes.join(first, "node", "left").select(
        F.posexplode("prefix").alias("at", "token"), "node", "n", "k", F.coalesce("component", "node").alias("component"))
    placed = placed.withColumn("at", F.col("at") + 1 + F.col("n") - F.col("k"))
    mixed = placed.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    placed = placed.join(mixed.where("low <> high").select("token"), "token")
    other = placed.select("token", F.col("node").alias("b"), F.col("n").alias("m"), F.col("k").alias("l"),
                          F.col("at").alias("there"), F.col("component").alias("other"))
    # At their first common token two sets can share no more than that one and what comes behind it.
    left = F.least(F.col("n") - F.col("at"), F.col("m") - F.col("there")) + 1
    rest = placed.withColumnRenamed("node", "a").join(other, "token").where("a < b and component <> other").where(
        _may_link("n", "k", "m", "l", percent)).where(
        left * (100 + percent) >= (F.col("n") + F.col("m")) * percent).select("a", "b").distinct()
    rest = rest.join(near, ["a", "b"], "left_anti")
    more = common.stored(_links(rest, sets, percent), "jaccard-links")
    component = smallest_reachable(links.union(more)) if not more.isEmpty() else first

    classes = classes.join(component, "node", "left").select(
        "set_id", F.coalesce("component", "node").alias("component_id"))
    return members.join(classes, "set_id").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, size: int = common.SHINGLE_WORDS, percent: int = 75) -> DataFrame:
    """The rows of ``docs`` whose document has the smallest doc_id of its component."""
    groups = similar_sets(docs, size, percent)
    gone = common.stored(groups.where("doc_id <> component_id").select("doc_id").distinct(), "jaccard-gone")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
