"""Scaled sketches and the edited texts."""

import hashlib
import sys
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
from conftest import prose  # noqa: E402

from rivermart.llm import queries, sketch  # noqa: E402


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for i, (key, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        out.append((key, len(text), hashlib.sha256((text[:len(text) - half] + after[:half]).encode()).hexdigest()))
    return sorted(out, key=str)


def test_edited_texts(frame, odd_texts):
    rows = odd_texts + [(None, "no id"), odd_texts[0], odd_texts[4]]
    got = sketch.fingerprints(frame(rows).repartition(3)).collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=str) == expected(rows)
    assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next", "contained_edited", "contained_next"))
    prints = {}
    for row in got:
        prints.setdefault(dict(rows)[row["doc_id"]] or "", set()).add(row["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())


def test_one_row_and_none(frame):
    got = sketch.fingerprints(frame([(4, "abcdef")])).first()
    assert got["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest() and got["near_next"] == 1
    assert sketch.fingerprints(frame([])).count() == 0


def test_estimates_and_merging():
    parts = [prose(i, 4000) for i in range(3)]
    small, large = parts[0], " ".join(parts)
    one, two = (sketch.read(sketch.written(s)) for s in sketch.sketches([small, large]))
    assert abs(sketch.likeness(one, two)[1] - 1) < 0.02
    truth = len(brute.shingles(small) & brute.shingles(large)) / len(brute.shingles(small) | brute.shingles(large))
    assert abs(sketch.likeness(one, two)[0] - truth) < 0.05
    a, b = (sketch.written(s) for s in sketch.sketches([parts[1], parts[2]]))
    union = sketch.read(sketch.merged(a, b))[1]
    assert set(union.tolist()) == set(sketch.read(a)[1].tolist()) | set(sketch.read(b)[1].tolist())
    share = len(two[1]) / len(brute.shingles(large))
    assert abs(share - 1 / sketch.KEEP_ONE_IN) < 0.02


def test_texts_without_kept_hashes():
    a, b, c = sketch.sketches(["", "", "x"], keep_one_in=1 << 40)
    assert sketch.likeness(a, b) == (1.0, 1.0) and sketch.likeness(a, c) == (0.0, 0.0)
    assert sketch.written(c) == sketch.written((c[0], np.zeros(0, np.uint64)))


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op4_scaled_sketch(spark, "/root/testdata/sf0.001").collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=str) == expected(rows)
    assert np.mean([r["near_edited"] for r in got]) > 0.25 > 0.02 > np.mean([r["near_next"] for r in got])
