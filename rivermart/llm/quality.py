"""Operator 1: document quality by hierarchical empirical Bayes.

Three kinds of evidence meet: a classifier's view of the document itself, the
record of its host, and that of its path on the host. A path's mean is shrunk
towards its host's and a host's towards the whole corpus, by pseudo-counts that
the spread between hosts (between paths of a host) tells by the method of
moments: a site with few documents, or sites that hardly differ, say little.
A document's posterior odds are the classifier's, times the odds of its path,
over the odds of the corpus. Means are grouped aggregations of one number per
document; no text is shuffled.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rivermart.llm import common

#: Labelled documents that the classifier is fitted on, about half from either class.
FIT_DOCUMENTS = 4000
#: Words that the classifier knows, each in so many of those documents at least.
WORDS, LEAST_DOCUMENTS = 300, 6
#: Strength of the classifier's ridge, and Newton steps.
RIDGE, STEPS = 1.0, 25
WORD = re.compile(r"[^\W\d_]+")
GOOD = "CASE WHEN quality = 1 AND coalesce(toxic, 0) = 0 THEN 1 WHEN quality IS NULL AND toxic IS NULL THEN NULL ELSE 0 END"
MEASURES = 9


def measures(text: str, words: list[str]) -> list[float]:
    """Shape of a text: length, letter case, marks, digits, words, lines."""
    n, m = max(1, len(text)), max(1, len(words))
    raw = text.encode("utf-8", "replace")
    ascii_marks = n - len(text.translate(MARKS))
    upper = n - len(text.translate(UPPER))
    digits = n - len(text.translate(DIGITS))
    lines = text.split("\n")
    return [np.log1p(len(text)), upper / n, ascii_marks / n, digits / n, len(set(words)) / m, n / m / 8,
            len(set(lines)) / len(lines), np.log1p(n / len(lines)), len(raw) / n - 1]


MARKS = str.maketrans("", "", "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
UPPER = str.maketrans("", "", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
DIGITS = str.maketrans("", "", "0123456789")


def features(texts: list[str | None], known: dict[str, int], squares: bool = True) -> np.ndarray:
    """Measures, their squares, and which of the known words each text has."""
    out = np.zeros((len(texts), 2 * MEASURES + len(known)))
    for i, text in enumerate(texts):
        words = WORD.findall((text or "").lower())
        out[i, :MEASURES] = measures(text or "", words)
        for word in known.keys() & set(words):
            out[i, 2 * MEASURES + known[word]] = 1
    out[:, MEASURES:2 * MEASURES] = out[:, :MEASURES] ** 2
    return out


def telling_words(sample: DataFrame, words: int, least: int) -> list[str]:
    """Words of the sample (text, good) whose presence speaks most for either class."""
    kinds = [("word", pa.string()), ("good", pa.int64()), ("bad", pa.int64())]

    def count(batches):
        seen: dict[str, list[int]] = {}
        for batch in batches:
            for text, good in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for word in set(WORD.findall((text or "").lower())):
                    seen.setdefault(word, [0, 0])[0 if good else 1] += 1
        if seen:
            yield common.batch_of(kinds, list(seen), *zip(*seen.values()))

    counted = common.map_arrow(sample, count, "word string, good long, bad long").groupBy("word").agg(
        F.sum("good").alias("good"), F.sum("bad").alias("bad")).where(F.col("good") + F.col("bad") >= least)
    odds = F.abs(F.log((F.col("good") + 1.0) / (F.col("bad") + 1.0))) * F.sqrt(F.col("good") + F.col("bad"))
    return [row["word"] for row in counted.orderBy(odds.desc(), "word").limit(words).collect()]


def fit_classifier(sample: DataFrame, words: int = WORDS, least: int = LEAST_DOCUMENTS) -> dict | None:
    """Ridge logistic regression; the driver gets the features of the bounded sample. None without both classes."""
    known = {word: i for i, word in enumerate(telling_words(sample, words, least))}
    width = 2 * MEASURES + len(known)
    kinds = [("x", pa.binary()), ("good", pa.int32())]

    def rows(batches):
        for batch in batches:
            x = features(batch.column(0).to_pylist(), known).astype("<f4")
            yield common.batch_of(kinds, [r.tobytes() for r in x], batch.column(1))

    got = common.map_arrow(sample, rows, "x binary, good int").collect()
    y = np.array([row["good"] for row in got], float)
    if not len(y) or y.min() == y.max():
        return None
    x = np.frombuffer(b"".join(row["x"] for row in got), "<f4").reshape(len(y), width).astype(float)
    middle, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    middle[2 * MEASURES:], spread[2 * MEASURES:] = 0, 1
    x = np.hstack([(x - middle) / spread, np.ones((len(y), 1))])
    beta, ridge = np.zeros(width + 1), np.append(np.full(width, RIDGE), 1e-6)
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (y - p) - ridge * beta
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        beta += step
        if np.abs(step).max() < 1e-6:
            break
    return {"known": known, "middle": middle, "spread": spread, "beta": beta, "share": float(y.mean())}


def scored(rows: DataFrame, model: dict | None, share: float) -> DataFrame:
    """``rows`` (doc_id, host, path, text) with evidence, the classifier's probability, instead of text.

    The sample's classes are balanced; ``share`` is the share of good labels,
    which the odds are put back to.
    """
    kinds = [("doc_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("evidence", pa.float64())]
    if model is None:
        return rows.select("doc_id", "host", "path", F.lit(share).cast("double").alias("evidence"))
    known = rows.sparkSession.sparkContext.broadcast(model)
    shift = logit(share) - logit(model["share"])

    def judge(batches):
        m = known.value
        for batch in batches:
            _, bounds = common.utf8(batch.column(3))
            for low, high in common.chunks(bounds):
                part = batch.slice(low, high - low)
                x = (features(part.column(3).to_pylist(), m["known"]) - m["middle"]) / m["spread"]
                z = np.clip(x @ m["beta"][:-1] + m["beta"][-1] + shift, -12, 12)
                yield common.batch_of(kinds, part.column(0), part.column(1), part.column(2), 1 / (1 + np.exp(-z)))

    return common.map_arrow(rows.select("doc_id", "host", "path", "text"), judge,
                            "doc_id long, host string, path string, evidence double")


def logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return float(np.log(p / (1 - p)))


def pseudo_count(mean: Column, n: Column, parent: Column) -> list[Column]:
    """Sums from which the spread between groups follows; see ``strength``."""
    return [F.sum(n).alias("n"), F.sum(n * n).alias("nn"), F.count("*").alias("groups"),
            F.sum(n * (mean - parent) * (mean - parent)).alias("between"), F.sum(n * parent * (1 - parent)).alias("within")]


def strength(sums) -> float:
    """Pseudo-count of a Beta prior by moments: how many documents the parent's mean is worth.

    The mean squares of group means about their parent exceed what chance within
    groups explains by the spread between groups; the less, the stronger the prior.
    """
    n, nn, groups = float(sums["n"] or 0), float(sums["nn"] or 0), int(sums["groups"] or 0)
    if groups < 2 or n <= 0:
        return 1e6
    variance = float(sums["within"]) / n
    spread = (float(sums["between"]) - variance * (groups - 1)) / max(n - nn / n, 1e-9)
    return float(np.clip(variance / spread - 1, 1.0, 1e6)) if spread > 0 else 1e6


def site_posteriors(evidence: DataFrame) -> tuple[DataFrame, float]:
    """host, path, host_mean, path_mean, n_path of every path, and the corpus mean."""
    paths = common.stored(evidence.groupBy("host", "path").agg(
        F.count("*").cast("double").alias("n"), F.sum("evidence").alias("s")), "quality-paths")
    hosts = common.stored(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s")), "quality-hosts")
    whole = hosts.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    corpus = float(whole["s"] / whole["n"]) if whole["n"] else 0.5
    weight = strength(hosts.agg(*pseudo_count(F.col("s") / F.col("n"), F.col("n"), F.lit(corpus))).first())
    hosts = hosts.select("host", ((F.col("s") + weight * corpus) / (F.col("n") + weight)).alias("host_mean"))
    joined = paths.join(hosts, "host")
    own = strength(joined.agg(*pseudo_count(F.col("s") / F.col("n"), F.col("n"), F.col("host_mean"))).first())
    return joined.select(
        "host", "path", "host_mean", ((F.col("s") + own * F.col("host_mean")) / (F.col("n") + own)).alias("path_mean"),
        F.col("n").cast("long").alias("n_path")), corpus


def judge_quality(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", good: str = GOOD,
                  fit_documents: int = FIT_DOCUMENTS, least: float = 0.5) -> DataFrame:
    """Per row of ``docs``: evidence, host_mean, path_mean, quality (the posterior) and keep.

    ``host`` and ``path`` are SQL expressions over ``docs`` (for pages, parts of
    the url); null counts as ''. ``good`` is one over ``labels`` (doc_id, ...)
    with 1, 0 or null; of a doc_id's several labels the worst counts, and one
    without doc_id is not used. A null text is empty. Without labels of both
    classes the classifier says the same of all, and all are kept if that is
    ``least`` or more. Rows of an equal doc_id are judged each; other columns
    are ignored; an empty table gives no row.
    """
    common.prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.expr(host).cast("string"), F.lit("")).alias("host"),
                       F.coalesce(F.expr(path).cast("string"), F.lit("")).alias("path"),
                       F.col("text").cast("string").alias("text"))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.expr(good).cast("int").alias("good")).where(
        "doc_id is not null and good is not null").groupBy("doc_id").agg(F.min("good").alias("good"))
    counts = {row["good"]: row["count"] for row in known.groupBy("good").count().collect()}
    share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40)
    limit = F.when(F.col("good") == 1, fit_documents / 2 / max(1, counts.get(1, 0))).otherwise(
        fit_documents / 2 / max(1, counts.get(0, 0)))
    chosen = F.broadcast(known.where(part < limit))  # bounded by fit_documents
    sample = common.stored(rows.select("doc_id", "text").join(chosen, "doc_id").select("text", "good"), "quality-sample")
    evidence = common.stored(scored(rows, fit_classifier(sample), share), "quality-evidence")
    sites, corpus = site_posteriors(evidence)

    def log_odds(p: Column) -> Column:
        safe = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
        return F.log(safe / (1 - safe))

    z = log_odds(F.col("evidence")) + log_odds(F.col("path_mean")) - F.lit(logit(corpus))
    joined = evidence.join(sites, ["host", "path"]).withColumn("quality", 1 / (1 + F.exp(-z)))
    return joined.select("doc_id", "host", "path", "evidence", "host_mean", "path_mean", "n_path", "quality",
                         (F.col("quality") >= least).alias("keep"))
