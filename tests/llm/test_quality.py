"""Hierarchical empirical Bayes over hosts and paths."""

import numpy as np
import pytest

from conftest import prose
from rivermart.llm import quality, queries


@pytest.fixture(scope="module")
def rows():
    """Good prose on good.org, repeated menus and insults on bad.org; short neutral texts on both."""
    out = []
    for i in range(240):
        host = "bad.org" if i % 3 == 0 else "good.org"
        text = f"{'MENU | ' * 30} scum {prose(i, 20)}" if host == "bad.org" and i % 6 else prose(i, 60 + i % 40)
        out.append((i, text, host, f"/p{i % 4}"))
    return out + [(900, None, "good.org", None), (901, "", None, "/x"), (902, prose(3, 15_000), "one.org", "/"),
                  (None, "no id", "good.org", "/"), (0, out[0][1], "bad.org", "/p0")]


@pytest.fixture(scope="module")
def labels(spark, rows):
    made = [(k, int("MENU" not in (t or "")), 0) for k, t, _, _ in rows if k is not None and k % 2 and k < 240]
    return spark.createDataFrame(made + [(None, 1, 0), (5, None, None), (7, 1, 1)], "doc_id long, quality int, toxic int")


SCHEMA = "doc_id long, text string, host string, path string"


def test_posteriors_follow_the_formula(frame, rows, labels):
    docs = frame(rows, SCHEMA)
    got = quality.judge_quality(docs, labels, "host", "path").toPandas()
    assert len(got) == len(rows)
    clear = got[got["doc_id"].between(0, 239)].merge(docs.toPandas()[["doc_id", "text"]].drop_duplicates(), on="doc_id")
    assert (clear["keep"] == ~clear["text"].str.contains("MENU")).mean() > 0.95

    def odds(p):
        return np.log(p / (1 - p))
    corpus = got["evidence"].mean()
    assert np.allclose(odds(got["quality"]), odds(got["evidence"]) + odds(got["path_mean"]) - odds(corpus), atol=1e-6)
    means = got.groupby("host")["host_mean"].first()
    assert means["bad.org"] < corpus < means["good.org"]
    raw = got.groupby(["host", "path"])["evidence"].mean()
    for (host, path), own in got.groupby(["host", "path"]):
        low, high = sorted((raw[host, path], own["host_mean"].iloc[0]))
        assert low - 1e-9 <= own["path_mean"].iloc[0] <= high + 1e-9  # shrunk between its own and its host's


def test_sparse_sites_shrink_more(spark):
    random = np.random.default_rng(2)
    rows = []
    for i in range(60):
        true, n = random.beta(2, 2), 3 if i < 30 else 300
        rows += [(f"h{i}", "/", float(x)) for x in np.clip(random.normal(true, 0.05, n), 0, 1)]
    evidence = spark.createDataFrame(rows, "host string, path string, evidence double")
    sites, corpus = quality.site_posteriors(evidence)
    found = sites.toPandas()
    raw = evidence.toPandas().groupby("host")["evidence"].mean()
    found["moved"] = [abs(m - raw[h]) / max(1e-9, abs(corpus - raw[h])) for h, m in zip(found["host"], found["host_mean"])]
    assert found[found["n_path"] == 3]["moved"].mean() > 3 * found[found["n_path"] == 300]["moved"].mean()


def test_strength_by_moments():
    random = np.random.default_rng(1)
    sizes = random.integers(2, 200, 4000)
    means = random.binomial(sizes, random.beta(6, 14, 4000)) / sizes
    n, parent = sizes.astype(float), 0.3
    sums = {"n": n.sum(), "nn": (n * n).sum(), "groups": 4000, "between": (n * (means - parent) ** 2).sum(),
            "within": (n * parent * (1 - parent)).sum()}
    assert 15 < quality.strength(sums) < 26  # Beta(6, 14) has 20 pseudo-counts
    assert quality.strength(dict(sums, groups=1)) == 1e6 and quality.strength(dict(sums, between=0.0)) == 1e6


def test_without_labels_or_rows(frame, rows, labels):
    got = quality.judge_quality(frame(rows, SCHEMA), labels.where("false"), "host", "path").toPandas()
    assert len(got) == len(rows) and got["evidence"].nunique() == 1 and got["keep"].all()
    assert quality.judge_quality(frame([], SCHEMA), labels, "host", "path").count() == 0


def test_whole_table(spark):
    got = {r["doc_id"]: r["keep"] for r in queries.op1_site_quality(spark, "/root/testdata/sf0.001").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").collect()
    clean = [got[r["doc_id"]] for r in labels if r["quality"] == 1 and r["toxic"] == 0]
    assert len(got) == 200 and np.mean(clean) > 0.95
