"""Operator 5: how often to draw each document so that domains meet target weights.

Membership is soft. A naive Bayes classifier, learned from a table of labelled
documents, gives each document a posterior over domains, and a document counts
towards each domain by it. Rates r >= 0, one for each document, then minimise

    sum over domains (expected tokens - target)^2 / target

by projected gradient steps from r = 1. The gradient for one document is the sum over
domains of posterior times residual; the domains' residuals are preconditioned by the
second moments of the posteriors, so a step is one aggregation over all documents (a few
numbers come back) and one expression per document, cut at its bounds. Steps go on until
the expected tokens of every domain are at its target. Plain steps, with a ridge
sum over documents w (r - 1)^2, w being a document's share of all tokens, can be asked for.
Nothing but DataFrame functions is used, and no text is shuffled.
"""

from __future__ import annotations

import math
import warnings
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from rivermart.llm import common

#: Labelled documents that marking words are looked for in, about.
FIT_DOCUMENTS = 4000
#: Words that speak for a domain: so many, each in so many labelled documents at least.
WORDS, LEAST_DOCUMENTS = 48, 8
BINS = 12
#: Expected tokens of a domain are this near its target, as a share of the target.
TOLERANCE = 0.001
#: A step is halved at most to this share; aggregations at most, halved steps included.
LEAST_STEP, MOST_STEPS = 1 / 64, 200
#: Steps that are taken before the rates are written to the shared folder.
STEPS_AT_ONCE = 10
#: Domains of the labels table and their share of tokens.
TARGETS = {"high": 0.90, "low": 0.08, "toxic": 0.02}
DOMAIN = "CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 1 THEN 'high' WHEN quality = 0 THEN 'low' END"
MEASURES = ("length", "upper", "marks", "distinct", "word_length", "marking")


def labelled(labels: DataFrame, domain: str = DOMAIN) -> DataFrame:
    """doc_id and domain; of a doc_id's several labels the first by name counts."""
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.expr(domain).alias("domain")).where(
        "doc_id is not null and domain is not null").groupBy("doc_id").agg(F.min("domain").alias("domain"))


def words_of(text: Column) -> Column:
    return F.split(F.lower(text), r"[\s\p{Punct}]+")


def marking_words(docs: DataFrame, labels: DataFrame, domains: list[str], fit_documents: int, words: int) -> list[str]:
    """The words whose presence speaks most for one domain, from a sample of labelled documents.

    The sample is drawn by a hash of doc_id within each domain, so a rare
    domain is seen as well as a common one.
    """
    counts = {row["domain"]: row["count"] for row in labels.groupBy("domain").count().collect()}
    each = max(1, fit_documents // max(1, len(domains)))
    share = F.create_map(*[F.lit(x) for d in domains for x in (d, min(1.0, each / counts.get(d, 1)))])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40)
    sample = labels.where(draw < share[F.col("domain")])
    pairs = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select(
        "domain", F.explode(F.array_distinct(words_of(F.col("text")))).alias("word")).where(F.length("word") > 1)
    seen = pairs.groupBy("word").pivot("domain", domains).count().na.fill(0)
    n = {d: min(each, counts.get(d, 0)) + 1.0 for d in domains}
    # How much more often a domain's documents have the word than the others' together.
    total, all_n = sum_of(F.col(d) for d in domains), sum(n.values())
    speaks = F.greatest(*[F.when(total >= LEAST_DOCUMENTS, (F.col(d) / n[d]) * (F.col(d) / n[d])
                                 / ((total - F.col(d) + 1.0) / (all_n - n[d] + 1.0))) for d in domains], F.lit(-1.0))
    ranked = seen.select("word", speaks.alias("speaks")).where("speaks > 0.5").orderBy(F.desc("speaks"), "word").limit(words)
    return [row["word"] for row in ranked.collect()]


def sum_of(columns) -> Column:
    return reduce(lambda a, b: a + b, columns)


def measured(docs: DataFrame, marking: list[str]) -> DataFrame:
    """doc_id, tokens (words) and the measures that the classifier looks at."""
    rows = docs.select("row_id", "doc_id", "text").withColumn("words", words_of(F.col("text")))
    n, size = F.greatest(F.length("text"), F.lit(1)), F.greatest(F.size("words"), F.lit(1))
    marked = F.size(F.array_intersect("words", F.array(*map(F.lit, marking)))) if marking else F.lit(0)
    return rows.select(
        "row_id", "doc_id", F.size("words").cast("long").alias("tokens"),
        F.log1p(n.cast("double")).alias("length"), (F.regexp_count("text", F.lit(r"\p{Lu}")) / n).alias("upper"),
        (F.regexp_count("text", F.lit(r"[^\p{L}\p{N}\s]")) / n).alias("marks"),
        (F.size(F.array_distinct("words")) / size).alias("distinct"), (n / size).alias("word_length"),
        marked.cast("double").alias("marking"))


def binned(rows: DataFrame, bins: int) -> tuple[DataFrame, dict[str, list[float]]]:
    """Each measure replaced by the number of its quantile bin among all documents."""
    marks = [i / bins for i in range(1, bins)]
    found = rows.agg(*[F.percentile_approx(m, marks, 1000).alias(m) for m in MEASURES]).first()
    edges = {m: sorted(set(found[m] or [])) for m in MEASURES}
    edges["marking"] = [0.0, 1.0, 2.0, 4.0]
    number = {m: sum_of([F.lit(0), *((F.col(m) > e).cast("int") for e in edges[m])]) for m in MEASURES}
    return rows.select("row_id", "doc_id", "tokens", *[number[m].alias(m) for m in MEASURES]), edges


def posteriors(rows: DataFrame, labels: DataFrame, domains: list[str], bins: int) -> DataFrame:
    """Adds p_<domain>: naive Bayes over the bins, with counts of all labelled documents."""
    pairs = rows.join(labels, "doc_id").select("domain", F.explode(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(m).alias("bin")) for m in MEASURES])).alias("at"))
    counts: dict[tuple[str, str, int], int] = {}
    sizes = dict.fromkeys(domains, 0)
    for row in pairs.groupBy("domain", "at.measure", "at.bin").count().collect():  # domains x measures x bins at most
        counts[row["domain"], row["measure"], row["bin"]] = row["count"]
        if row["measure"] == MEASURES[0]:
            sizes[row["domain"]] += row["count"]
    total = sum(sizes.values())
    logs = {}
    for d in domains:
        score = F.lit(math.log((sizes[d] + 1) / (total + len(domains))))
        for m in MEASURES:
            table = [F.lit(math.log((counts.get((d, m, b), 0) + 0.5) / (sizes[d] + 0.5 * (bins + 1)))) for b in range(bins + 1)]
            score = score + F.get(F.array(*table), F.col(m))
        logs[d] = score
    rows = rows.select("row_id", "doc_id", "tokens", *[logs[d].alias(f"l_{d}") for d in domains])
    top = F.greatest(*[F.col(f"l_{d}") for d in domains]) if len(domains) > 1 else F.col(f"l_{domains[0]}")
    rows = rows.select("row_id", "doc_id", "tokens", *[F.exp(F.col(f"l_{d}") - top).alias(f"e_{d}") for d in domains])
    whole = sum_of(F.col(f"e_{d}") for d in domains)
    return rows.select("row_id", "doc_id", "tokens", *[(F.col(f"e_{d}") / whole).alias(f"p_{d}") for d in domains])


def with_plain_rate(rows: DataFrame, held: dict[str, float], goal: dict[str, float], steps: int, ridge: float) -> DataFrame:
    """Adds the rate after so many plain steps, or fewer if they arrive before."""
    step, every, rate = 1 / (1 + ridge), sum(goal.values()), F.lit(1.0)
    for number in range(steps):
        if number and number % STEPS_AT_ONCE == 0:
            rows, rate = common.stored(rows.withColumn("rate", rate), "rates"), F.col("rate")
        got = rows.agg(*[F.sum(F.col("tokens") * F.col(f"p_{d}") * rate).alias(d) for d in goal]).first()
        pull = sum_of(F.col(f"p_{d}") * F.lit((got[d] - goal[d]) / held[d]) for d in goal)
        # Each step's expression holds the one before; every so often the rates are written out.
        rate = F.greatest(F.lit(0.0), rate * (1 - step * ridge) - (pull - ridge) * step)
        if max(abs(got[d] - goal[d]) for d in goal) < 1e-9 * every:
            break
    return rows.withColumn("rate", rate)


def with_met_rate(rows: DataFrame, wanted: dict[str, float], every: float, keep: str | None,
                  most: float | None = None) -> DataFrame:
    """Adds the rate that brings each domain's expected tokens within ``TOLERANCE`` of its target.

    Each step takes every document's rate against its gradient and projects it on its bounds.
    The gradient is preconditioned by the second moments of the posteriors of documents that
    it does not press against a bound, and a step that does not lessen the sum of squares is
    halved. The lower bound is zero, and one for rows that ``keep`` is the likeliest domain of; then
    the total is free, and what a row adds to the domains counts less its share of the targets.
    ``most`` is the upper bound, by default none. Targets that no rates reach are warned of with what
    was reached: where steps lessen the sum of squares no more.
    """
    names = sorted(wanted)
    n = len(names)
    target = np.array([wanted[d] for d in names])
    p, floor, aim = [F.col(f"p_{d}") for d in names], F.lit(0.0), target
    if keep:
        floor = (F.col(f"p_{keep}") >= F.greatest(*p, F.lit(0.0))).cast("double")
        p, aim = [x - F.lit(float(t)) for x, t in zip(p, target)], np.zeros(n)

    def pull(by: np.ndarray) -> Column:
        return sum_of(x * F.lit(float(b)) for x, b in zip(p, by))

    def measure(rate: Column, before: np.ndarray):
        """Residuals, all expected tokens, sum of squares, and moments of what ``before`` leaves free."""
        share, slope = F.col("tokens") / F.lit(every), pull(before / target)
        free = (F.col("rate") > floor) | (slope < 0)
        if most is not None:
            free = free & ((F.col("rate") < most) | (slope > 0))
        above = share * free.cast("double")
        found = rows.withColumn("rate", rate).agg(
            F.sum(share * F.col("rate")), *[F.sum(share * F.col("rate") * x) for x in p], *[
                F.sum(above * p[i] * p[j]) for i in range(n) for j in range(i + 1)]).first()
        left, moments = np.array(found[1:1 + n]) - aim, np.zeros((n, n))
        moments[np.tril_indices(n)] = found[1 + n:]
        return left, found[0] if keep else 1.0, (left * left / target).sum(), moments + np.tril(moments, -1).T

    # The start is within all bounds, so the first step needs no residuals to tell what is free.
    rate, taken = F.lit(1.0), 0
    left, total, squares, moments = measure(rate, np.zeros(n))
    for _ in range(MOST_STEPS):
        near = TOLERANCE * target * total
        if (np.abs(left) <= near).all():
            return rows.withColumn("rate", rate)
        moments = moments + np.eye(n) * 1e-6 * max(np.trace(moments), 1e-12)
        by, step = np.linalg.solve(moments, left), 1.0
        while True:
            after = F.greatest(floor, rate - pull(by * step))
            if most is not None:
                after = F.least(F.lit(float(most)), after)
            found = measure(after, left)
            if found[2] < squares * (1 - 1e-4 * step) or step <= LEAST_STEP:
                break
            step /= 2
        if found[2] >= squares * (1 - 1e-6):
            break
        rate, (left, total, squares, moments) = after, found
        taken += 1
        if taken % STEPS_AT_ONCE == 0:
            rows, rate = common.stored(rows.withColumn("rate", rate), "rates"), F.col("rate")
    reached = {d: round(float(x / (t * total) + 1), 4) for d, x, t in zip(names, left, target)}
    warnings.warn(f"no rates meet the targets; expected tokens over target by domain: {reached}", stacklevel=2)
    return rows.withColumn("rate", rate)


def fit_rates(rows: DataFrame, targets: dict[str, float], steps: int | None, ridge: float | None, keep: str | None,
              most: float | None = None) -> DataFrame:
    """Adds rate. ``keep`` names a domain that loses no document: rows that it is the likeliest of have
    a rate of at least one, and the total follows. Plain steps choose the total by the domain's tokens instead."""
    domains = sorted(targets)
    now = rows.agg(F.sum("tokens").alias("all"), *[F.sum(F.col("tokens") * F.col(f"p_{d}")).alias(d) for d in domains]).first()
    every = float(now["all"] or 0)
    if not every:
        return rows.withColumn("rate", F.lit(1.0))
    held = {d: max(now[d], 1e-9 * every) for d in domains}
    whole = sum(targets.values())
    wanted = {d: targets[d] / whole for d in domains}
    if steps is None:
        return with_met_rate(rows, wanted, every, keep, most)
    total = held[keep] / wanted[keep] if keep else every
    goal = {d: total * wanted[d] for d in domains}
    return with_plain_rate(rows, held, goal, steps, ridge or 0.0)


def mixing_rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, domain: str = DOMAIN,
                 fit_documents: int = FIT_DOCUMENTS, words: int = WORDS, bins: int = BINS, steps: int | None = None,
                 ridge: float | None = None, keep: str | None = None, most: float | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): tokens (words), p_<domain> of each target, and rate.

    ``targets`` gives each domain's share of all tokens; ``domain`` is a SQL
    expression over ``labels`` (doc_id, ...). A null text is empty and counts
    one token. A label without a doc_id, or whose domain is not a target, is
    not used; without labels every posterior is the same. Rows of an equal
    doc_id are rated each by their text. With equal texts come equal rates.
    Steps go on until each domain's expected tokens are within ``TOLERANCE`` of
    its target, or as near as rates of ``most`` at the most (one or more) can bring it, which is
    warned of and told by ``expected_shares``; ``steps`` and ``ridge`` ask for so many plain steps
    instead, without ``most``.
    Other columns are ignored; an empty table gives no row.
    """
    targets = dict(TARGETS if targets is None else targets)
    if not targets or min(targets.values()) <= 0:
        raise ValueError("targets are positive shares")
    if most is not None and (most < 1 or steps is not None):
        raise ValueError("the largest rate is one or more, and not for plain steps")
    domains = sorted(targets)
    known = labelled(labels, domain).where(F.col("domain").isin(domains))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn(
        "row_id", F.xxhash64("text"))
    marking = marking_words(docs, known, domains, fit_documents, words)
    rows = common.stored(measured(docs, marking), "mixing-measures")
    rows, _ = binned(rows, bins)
    rows = common.stored(posteriors(rows, known, domains, bins), "mixing-posteriors")
    return fit_rates(rows, targets, steps, ridge, keep, most)


def expected_shares(rates: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """Per domain of ``targets``: its target, the expected share of the tokens before and after
    the rates, and the residual (after less target). Without rows or tokens the shares are null."""
    targets = dict(TARGETS if targets is None else targets)
    whole = sum(targets.values())
    names = sorted(targets)
    sums = rates.agg(F.sum("tokens").alias("tokens"), F.sum(F.col("tokens") * F.col("rate")).alias("rated"), *[
        F.struct(F.sum(F.col("tokens") * F.col(f"p_{d}")).alias("before"),
                 F.sum(F.col("tokens") * F.col("rate") * F.col(f"p_{d}")).alias("after")).alias(f"d_{d}") for d in names])
    rows = sums.select(F.explode(F.array(*[F.struct(
        F.lit(d).alias("domain"), F.lit(targets[d] / whole).alias("target"),
        F.try_divide(F.col(f"d_{d}.before"), F.col("tokens")).alias("before"),
        F.try_divide(F.col(f"d_{d}.after"), F.col("rated")).alias("after")) for d in names])).alias("row")).select("row.*")
    return rows.withColumn("residual", F.col("after") - F.col("target"))


def draw(docs: DataFrame, rates: DataFrame, snap: float = 0.05) -> DataFrame:
    """``docs`` with each row as often as its rate says: the whole part, and once more
    with the chance of the rest, decided by a hash of doc_id. A rate within
    ``snap`` of a whole number is taken as that number. Columns stay."""
    rate = F.when(F.abs(F.col("rate") - F.round("rate")) <= snap, F.round("rate")).otherwise(F.col("rate"))
    chance = F.pmod(F.xxhash64("doc_id", F.lit("draw")), F.lit(1 << 40)) / float(1 << 40)
    times = rates.select("doc_id", "row_id", F.floor(rate + chance).cast("int").alias("times"))
    times = times.groupBy("doc_id", "row_id").agg(F.min("times").alias("times")).where("times <> 1")
    times = times.select(F.col("doc_id").alias("__own_id"), F.col("row_id").alias("__own_row"), F.col("times").alias("__times"))
    match = F.col("__id").eqNullSafe(F.col("__own_id")) & (F.col("__row") == F.col("__own_row"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.withColumns({"__row": F.xxhash64(text), "__id": F.col("doc_id").cast("long")}).join(
        common.stored(times, "mixing-times"), match, "left")
    number = F.coalesce("__times", F.lit(1))
    return rows.where(number > 0).withColumn("__copy", F.explode(F.sequence(F.lit(1), number))).select(docs.columns)
