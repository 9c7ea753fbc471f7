"""Soft-membership mixing."""

import math
import re
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import prose
from rivermart.llm import mixing, queries


@pytest.fixture(scope="module")
def rows():
    out = [(i, prose(i, 40 + i % 50) + (" scum trash moron" if i % 10 == 3 else "")) for i in range(300)]
    return out + [(i, " | ".join(["MENU THE"] * 60)) for i in range(300, 340)] + [
        (400, None), (401, ""), (402, prose(402, 20_000)), (None, prose(1, 50)), (5, out[5][1])]


@pytest.fixture(scope="module")
def labels(spark, rows):
    made = [(k, 0 if k >= 300 else 1, int(k % 10 == 3 and k < 300)) for k, _ in rows if k is not None and k % 2 and k < 390]
    return spark.createDataFrame(made + [(None, 1, 0), (7, 1, 0), (11, None, None)], "doc_id long, quality int, toxic int")


def shares(found, weight=True):
    tokens = found["tokens"] * (found["rate"] if weight else 1)
    total = sum((tokens * found[f"p_{d}"]).sum() for d in ("high", "low", "toxic"))
    return {d: (tokens * found[f"p_{d}"]).sum() / total for d in ("high", "low", "toxic")}


def test_expected_tokens_meet_the_targets(frame, rows, labels):
    targets = {"high": 0.6, "low": 0.3, "toxic": 0.1}
    found = mixing.mixing_rates(frame(rows), labels, targets, steps=200, ridge=1e-4).toPandas()
    assert len(found) == len(rows) and (found["rate"] >= 0).all()
    assert np.allclose(found[["p_high", "p_low", "p_toxic"]].sum(axis=1), 1)
    got = shares(found)
    assert all(abs(got[d] - targets[d]) < 0.01 for d in targets)
    assert abs((found["tokens"] * found["rate"]).sum() / found["tokens"].sum() - 1) < 0.02
    sure = found[found["doc_id"].between(300, 339)]
    assert (sure["p_low"] > 0.5).all()


def test_production_parameters_meet_every_target(spark):
    found = queries.op5_soft_mixing(spark, "/root/testdata/sf0.01").toPandas()
    got = shares(found)
    assert all(abs(got[d] / mixing.TARGETS[d] - 1) <= 2 * mixing.TOLERANCE for d in mixing.TARGETS), got
    assert (found["rate"] >= 0).all()


@pytest.mark.parametrize("keep", [None, "high"])
def test_defaults_meet_every_target(frame, rows, labels, keep):
    found = mixing.mixing_rates(frame(rows), labels, keep=keep).toPandas()
    got = shares(found)
    assert all(abs(got[d] / mixing.TARGETS[d] - 1) <= 2 * mixing.TOLERANCE for d in mixing.TARGETS), got
    if keep:
        clean = found["p_high"] >= found[["p_low", "p_toxic"]].max(axis=1)
        assert clean.sum() > 100 and (found["rate"][clean] >= 1).all()
    else:
        assert abs((found["tokens"] * found["rate"]).sum() / found["tokens"].sum() - 1) <= 2 * mixing.TOLERANCE


def test_largest_rate(frame, rows, labels):
    free = mixing.mixing_rates(frame(rows), labels, keep="high").toPandas()["rate"].max()
    docs = frame(rows)
    loose = mixing.mixing_rates(docs, labels, keep="high", most=free * 1.01).toPandas()
    assert all(abs(shares(loose)[d] / mixing.TARGETS[d] - 1) <= 2 * mixing.TOLERANCE for d in mixing.TARGETS)
    most = max(1.0, 1 + (free - 1) / 4)
    with pytest.warns(UserWarning, match="no rates meet the targets"):
        rates = mixing.mixing_rates(docs, labels, keep="high", most=most)
    found = rates.toPandas()
    clean = found["p_high"] >= found[["p_low", "p_toxic"]].max(axis=1)
    assert found["rate"].max() <= most and (found["rate"][clean] >= 1).all() and (found["rate"] >= 0).all()
    told = {r["domain"]: r for r in mixing.expected_shares(rates).collect()}
    for d, share in shares(found).items():
        assert told[d]["after"] == pytest.approx(share) and told[d]["residual"] == pytest.approx(share - mixing.TARGETS[d])
        assert told[d]["before"] == pytest.approx(shares(found, False)[d])
    assert abs(told["toxic"]["residual"]) <= abs(told["toxic"]["before"] - 0.02)  # nearer than before
    with pytest.raises(ValueError):
        mixing.mixing_rates(docs, labels, most=0.5)


def test_targets_out_of_reach_are_told(frame, rows, labels):
    with pytest.warns(UserWarning, match="no rates meet the targets"):
        mixing.mixing_rates(frame(rows), labels.where("false")).count()


def test_steps_equal_plain_projected_gradient(frame, rows, labels):
    targets = {"high": 0.7, "low": 0.2, "toxic": 0.1}
    found = mixing.mixing_rates(frame(rows), labels, targets, steps=12, ridge=0.01).toPandas()
    p, w = found[["p_high", "p_low", "p_toxic"]].to_numpy(), found["tokens"].to_numpy(float)
    goal, now, rate, step = w.sum() * np.array([0.7, 0.2, 0.1]), w @ p, np.ones(len(w)), 1 / 1.01
    for _ in range(12):
        pull = p @ (((w * rate) @ p - goal) / now)
        rate = np.maximum(0, rate - step * (pull + 0.01 * (rate - 1)))
    assert np.allclose(found["rate"], rate, atol=1e-9)


def test_rates_equal_projected_steps_on_documents(frame, rows, labels):
    """The production path in numpy, with every row's rate in an array."""
    found = mixing.mixing_rates(frame(rows), labels).toPandas()
    p, w = found[["p_high", "p_low", "p_toxic"]].to_numpy(), found["tokens"].to_numpy(float)
    w, goal, rate = w / w.sum(), np.array([0.9, 0.08, 0.02]), np.ones(len(w))
    left = w @ p - goal
    free = np.ones(len(w), bool)
    steps = 0
    while (np.abs(left) > mixing.TOLERANCE * goal).any():
        moments = (p * (w * free)[:, None]).T @ p
        by = np.linalg.solve(moments + np.eye(3) * 1e-6 * np.trace(moments), left)
        for halved in range(7):
            after = np.maximum(0, rate - p @ by / 2 ** halved)
            now = (w * after) @ p - goal
            if (now ** 2 / goal).sum() < (left ** 2 / goal).sum() * (1 - 1e-4 / 2 ** halved):
                break
        free = (after > 0) | (p @ (left / goal) < 0)
        rate, left, steps = after, now, steps + 1
    assert steps > 1 and np.allclose(found["rate"], rate, atol=1e-6)


def test_posteriors_equal_brute_force(spark, frame, rows, labels):
    docs = frame(rows).selectExpr("doc_id", "coalesce(text, '') AS text").withColumn("row_id", F.xxhash64("text"))
    known, domains = mixing.labelled(labels), sorted(mixing.TARGETS)
    marking = mixing.marking_words(docs, known, domains, 4000, 48)
    assert {"scum", "trash", "moron"} <= set(marking)
    binned, edges = mixing.binned(mixing.measured(docs, marking), mixing.BINS)
    got = mixing.posteriors(binned, known, domains, mixing.BINS).toPandas()
    label = {r["doc_id"]: r["domain"] for r in known.collect()}
    placed = []
    for key, text in rows:
        text = text or ""
        words = re.split(r"[\s!-/:-@\[-`{-~]+", text.lower(), flags=re.ASCII)
        kinds = [unicodedata.category(c) for c in text]
        n = max(len(text), 1)
        marks = sum(k[0] not in "LN" and c not in " \t\n\x0b\f\r" for k, c in zip(kinds, text))
        measure = {"length": math.log1p(n), "upper": kinds.count("Lu") / n, "marks": marks / n,
                   "distinct": len(set(words)) / len(words), "word_length": n / len(words),
                   "marking": len(set(words) & set(marking))}
        placed.append((key, len(words), {m: sum(x > e for e in edges[m]) for m, x in measure.items()}))
    learnt = [(label[k], bins) for k, _, bins in placed if k in label]
    want = []
    for key, tokens, bins in placed:
        odds = []
        for d in domains:
            own = [b for name, b in learnt if name == d]
            odds.append((len(own) + 1) / (len(learnt) + 3) * math.prod(
                (sum(b[m] == bins[m] for b in own) + 0.5) / (len(own) + 0.5 * (mixing.BINS + 1)) for m in mixing.MEASURES))
        want.append((-1 if key is None else key, tokens, *[x / sum(odds) for x in odds]))
    got = got.assign(doc_id=got["doc_id"].fillna(-1))[["doc_id", "tokens", *[f"p_{d}" for d in domains]]]
    assert np.allclose(sorted(map(tuple, got.to_numpy().tolist())), sorted(want), atol=1e-9)


def test_drawn_rows(frame, rows, labels):
    docs = frame(rows).withColumnRenamed("times", "rate")
    rates = mixing.mixing_rates(docs, labels, keep="high").cache()
    got = mixing.draw(docs, rates)
    assert got.columns == docs.columns
    rate = {(r["doc_id"], r["row_id"]): r["rate"] for r in rates.collect()}
    counts = got.groupBy("doc_id").count().toPandas().set_index("doc_id")["count"]
    clean = [k for k, _ in rows if k is not None and k < 300 and k % 10 != 3 and k != 5]
    assert (counts.reindex(clean).fillna(0) >= 1).mean() > 0.97
    assert abs(got.count() - sum(rate.values())) < 0.15 * len(rows)
    twice = mixing.draw(docs, rates.selectExpr("doc_id", "row_id", "2.0 AS rate"))
    assert twice.count() == 2 * len(rows)


def test_without_labels_or_rows(frame, rows, labels):
    plain = mixing.mixing_rates(frame(rows), labels.where("false")).toPandas()
    assert len(plain) == len(rows) and plain["p_high"].nunique() == 1
    assert mixing.mixing_rates(frame([]), labels).count() == 0
    with pytest.raises(ValueError):
        mixing.mixing_rates(frame(rows), labels, {"high": 0.0})


def test_whole_table(spark):
    found = queries.op5_soft_mixing(spark, "/root/testdata/sf0.001").toPandas()
    got = shares(found)
    assert len(found) == 200 and abs(got["high"] - 0.9) < 0.02


def test_plan_has_no_python(spark, frame, rows, labels):
    plan = mixing.mixing_rates(frame(rows), labels)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
