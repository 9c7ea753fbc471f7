import hashlib
import random
import re

import numpy as np
import pytest

from rivermart.llm import fim


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plainly(doc_id, text):
    """n, form, lengths and output, by slices of the list of tokens."""
    text = text or ""
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(tokens)
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(part) for part in (tokens[:a], tokens[a:b], tokens[b:]))
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def check(frame, docs):
    rows = fim.restore(fim.rearrange(frame(docs))).collect()
    got = sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["restored"]) for r in rows), key=str)
    assert got == sorted(((key, *plainly(key, text), text or "") for key, text in docs), key=str)
    return got


def test_rotations():
    draw = random.Random(1)
    for _ in range(200):
        raw = bytes(draw.randrange(256) for _ in range(draw.randint(0, 40)))
        low, middle, high = sorted(draw.randint(0, len(raw)) for _ in range(3))
        buffer = bytearray(raw)
        fim.rotate(buffer, low, middle, high)
        assert bytes(buffer) == raw[:low] + raw[middle:high] + raw[low:middle] + raw[high:]


def test_reversal_in_blocks(monkeypatch):
    monkeypatch.setattr(fim, "BLOCK", 7)
    for n in range(40):
        view = np.arange(n, dtype=np.uint8)
        fim.reverse(view, 0, n)
        assert view.tolist() == list(range(n))[::-1]


@pytest.mark.parametrize("form", ["plain", "psm", "spm"])
def test_every_cut_comes_back(form):
    text = "<a<Pb<S é<".encode()
    for first in range(len(text) + 1):
        for second in range(first, len(text) + 1):
            output = fim.arrange(text, first, second, form)
            assert fim.restore_text(output, form) == text
            assert len(output) == len(text) + (0 if form == "plain" else 9)


def test_odd_texts(frame, odd_texts):
    check(frame, odd_texts + [(200 + i, t) for i, t in enumerate(["<P>", "a <M> b", "<S", "<", "A1b2", "\n\n", "é" * 30, "<S>" * 3])])


def test_many_texts_take_every_form(frame):
    draw = random.Random(3)
    docs = [(i, "".join(draw.choice("ab <PSM>é日1\n") for _ in range(draw.randint(0, 60)))) for i in range(400)]
    assert {row[2] for row in check(frame, docs)} == {"plain", "psm", "spm"}


def test_null_and_repeated_ids(frame):
    check(frame, [(None, "some text here"), (None, None), (7, "the same"), (7, "the same")])


def test_a_very_long_text(frame):
    check(frame, [(i, "word, " * 400_000 + str(i)) for i in range(2)])


def test_empty_table_and_shares(frame):
    assert fim.rearrange(frame([])).collect() == []
    docs = frame([(i, "some words of text") for i in range(50)])
    assert {r["form"] for r in fim.rearrange(docs, rearranged=0).collect()} == {"plain"}
    assert {r["form"] for r in fim.rearrange(docs, rearranged=100, suffix_first=100).collect()} == {"spm"}
    assert fim.rearrange(docs, seed=2).select("output").collect() != fim.rearrange(docs).select("output").collect()


def test_the_query(spark, sf_dir):
    from rivermart.llm.queries import op12_fill_in_middle
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op12_fill_in_middle(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        *lengths, output = plainly(r["doc_id"], docs[r["doc_id"]])
        assert [r["n"], r["form"], r["prefix_chars"], r["middle_chars"]] == lengths
        assert (r["output_sha256"], r["restored_sha256"]) == (sha(output), sha(docs[r["doc_id"]] or ""))


def test_nothing_is_shuffled(frame):
    plan = fim.restore(fim.rearrange(frame([(1, "a")])))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
