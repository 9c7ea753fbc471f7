"""Language by segmentation-marginalised unigrams."""

import zlib
from decimal import Decimal
from functools import lru_cache

import numpy as np
import pytest

from conftest import prose
from rivermart.llm import langid, tokens

MODEL = tokens.vocabulary("piece_bpe_32k.model")


def test_forward_sums_all_segmentations():
    pieces = ["a", "b", "ab", "ba", "aba", "abbaabbaabba", langid.MARK]
    chances = np.random.default_rng(1).random((len(pieces), 2)) / 4
    scorer = langid.Scorer(pieces, chances)
    table = dict(zip(pieces, chances))

    @lru_cache(None)
    def total(word, t):
        if t == 0:
            return (Decimal(1), Decimal(1))
        sums = [Decimal(0), Decimal(0)]
        for n in range(1, min(12, t) + 1):
            p = table.get(word[t - n:t], (1e-6, 1e-6) if n == 1 else (0.0, 0.0))
            sums = [s + u * Decimal(float(x)) for s, u, x in zip(sums, total(word, t - n), p)]
        return tuple(sums)

    def logs_of(values):
        return np.array([float(x.ln()) for x in values])

    texts = ["abba", "aba ba", "zab", "b" * 30, "abba" * 5, "abba" * 50 + "z", "abba" * 11 + "abb", "z" * 90, "ab" * 700]
    logs, counts = scorer.score(texts)
    want = []
    for text in texts:
        sums = np.zeros(2)
        for word in text.split():
            total.cache_clear()
            for t in range(0, len(word) + 2, 200):  # keeps the recursion shallow
                total(langid.MARK + word, t)
            sums += logs_of(total(langid.MARK + word, len(word) + 1))
        want.append(sums)
    assert np.allclose(logs, want, rtol=1e-9) and counts.tolist() == [1, 2] + [1] * 7
    again, _ = scorer.score(texts)
    assert np.allclose(again, want)


def test_expected_uses_spell_the_word():
    pieces = ["a", "b", "ab", langid.MARK, langid.MARK + "a"]
    finder = langid.Pieces(pieces)
    table = finder.lifted(np.full((len(pieces), 1), 0.2))
    for letters in ("abab", "ab" * 40, "ab" * 1500):
        uses = langid.expected(finder, [langid.MARK + letters], table, np.array([3.0]))
        assert np.isclose((uses[:5] * [len(p) for p in pieces]).sum(), 3 * (1 + len(letters)))


def test_long_words_are_counted_as_short_ones(monkeypatch):
    pieces = ["a", "b", "ab", "bab", "ababababab", langid.MARK, langid.MARK + "a"]
    finder = langid.Pieces(pieces)
    table = finder.lifted(np.random.default_rng(2).random((len(pieces), 1)) / 4)
    words = [langid.MARK + w for w in ("ababababababbabzab", "bbbabababababababa")]
    short = langid.expected(finder, words, table, np.array([3.0, 1.0]))
    monkeypatch.setattr(langid, "LONG_WORD", 4)
    monkeypatch.setattr(langid, "BLOCK", 7)
    assert np.allclose(langid.expected(finder, words, table, np.array([3.0, 1.0])), short)


def test_every_letter_piece_takes_part():
    found = langid.pieces_of(MODEL)
    assert max(map(len, found)) > 12 and langid.MARK + "information" in found


def test_words_without_letters_do_not_count():
    scorer = langid.Scorer(["a", langid.MARK], np.full((2, 1), 0.5))
    _, counts = scorer.score(["²½ 12 _", None, "", "a²", "a" * 500, "日本"])
    assert counts.tolist() == [0, 0, 0, 1, 1, 1]


@pytest.fixture(scope="module")
def rows():
    made = [(i, prose(i, 5 + i % 60, lang), lang) for i, lang in enumerate(("en", "de", "es") * 60)]
    return made + [(500, None, "en"), (501, "", "de"), (502, "123 456 !?", None), (503, "the andingion", None),
                   (None, prose(7, 30, "de"), "xx"), (503, "the andingion", None)]


def test_held_out_languages(frame, rows):
    got = langid.identify(frame(rows, "doc_id long, text string, lang string"), MODEL).collect()
    assert len(got) == len(rows)
    truth = {k: lang for k, _, lang in rows}
    for row in got:
        if row["doc_id"] is not None:
            assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2)
        if row["doc_id"] in (500, 501, 502):
            assert (row["lang_pred"], row["score"]) == ("und", 0.0)
        else:
            assert row["lang_pred"] in ("en", "de", "es") and 0 <= row["score"] <= 1
    held = [r["lang_pred"] == truth[r["doc_id"]] for r in got if r["held_out"] and truth[r["doc_id"]] and r["doc_id"] < 200]
    assert len(held) > 20 and sum(held) >= 0.95 * len(held)


def test_held_out_labels_are_never_read(frame, rows):
    schema = "doc_id long, text string, lang string"
    changed = [(k, t, "zz" if k is not None and zlib.crc32(str(k).encode()) % 4 == 2 else lang) for k, t, lang in rows]
    one = langid.identify(frame(rows, schema), MODEL).collect()
    two = langid.identify(frame(changed, schema), MODEL).collect()
    assert sorted(map(str, one)) == sorted(map(str, two))


def test_kept_rows_and_tables_without_languages(frame, rows):
    docs = frame(rows, "doc_id long, text string, lang string")
    kept = langid.keep_identified(docs, MODEL)
    assert kept.columns == docs.columns
    assert {500, 501, 502}.isdisjoint(r["doc_id"] for r in kept.collect()) and kept.count() == len(rows) - 3
    none = frame([(1, "text", None)], "doc_id long, text string, lang string")
    assert langid.identify(none, MODEL).first()["lang_pred"] == "und"
    assert langid.identify(none.where("false"), MODEL).count() == 0


def test_whole_table_held_out_accuracy(spark):
    from rivermart.llm import queries
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = queries.op9_language(spark, "/root/testdata/sf0.001").collect()
    held = [r["lang_pred"] == truth[r["doc_id"]] for r in got if r["held_out"]]
    assert len(got) == len(truth) and sum(held) >= 0.95 * len(held)
