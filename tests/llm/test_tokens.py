"""Encoder, bit packing and sequence packing."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from rivermart.llm import bitpack, packing, tokens

NAMES = ("byte_bpe_50k.json", "word_bpe_49k.json")
ODD = ["", "  ", " a  b\n\n c\t", "it's we'll don't' x's' 'tis <|endoftext|> x", "naïve x　y\x1cz", "日本語 テスト、ÀÉİ İx",
       "a\n b\r\n", "é, á́. ́ a", "x²² ½, ab² a_b_ _ a__ ǅ ſſ ẞ ΣΑΣ, Привет! ñ'd ﬁ, Å K",
       " " * 50 + "x", "\n", "the###, the$$$ THE!! THE!!", "<|startoftext|>a"]


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("kept", [3, 100_000])
def test_encoder_equals_the_library(name, kept, odd_texts):
    path = tokens.vocabulary(name)
    library, encoder = Tokenizer.from_file(path), tokens.Encoder(path, kept)
    texts = ODD + [t for _, t in odd_texts if t]
    for text in texts + texts:
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", NAMES)
def test_every_letter_before_marks(name):
    path = tokens.vocabulary(name)
    library, encoder = Tokenizer.from_file(path), tokens.Encoder(path)
    letters = [c for c in map(chr, range(0x10000)) if c.isalpha()]
    texts = ["SERG\u0130.", "\u0130Y\u0130!"] + [t for c in letters for t in (c, c + ".", "a" + c + "!?", " " + c + "x,")]
    own = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]
    theirs = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [t for t, a, b in zip(texts, own, theirs) if a != b] == []


@pytest.mark.parametrize("width", range(1, 33))
def test_bits_round_trip_and_random_access(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 1000, dtype=np.uint64)
    packed = bitpack.pack(ids, width)
    assert len(packed) == 16 * 8 * width
    assert (bitpack.unpack(packed, width, 0, 1000) == ids).all()
    assert (bitpack.unpack(packed, width, 130, 517) == ids[130:517]).all()
    assert len(bitpack.unpack(packed, width, 5, 5)) == 0 and bitpack.pack(ids[:0], width) == b""


def test_widths_and_too_large_ids():
    assert [bitpack.width_of(n) for n in (1, 2, 3, 49_408, 65_536, 65_537)] == [1, 1, 2, 16, 16, 17]
    with pytest.raises(ValueError):
        bitpack.pack(np.array([8]), 3)


def library_ids(name, texts, end):
    library = Tokenizer.from_file(tokens.vocabulary(name))
    return [library.encode(t or "", add_special_tokens=False).ids + [end] for t in texts]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_files_hold_the_ids_in_order(frame, odd_texts, tmp_path):
    docs = frame(odd_texts + [(None, "no id"), odd_texts[0]]).repartition(3)
    got = bitpack.encode_and_read(docs, str(tmp_path / "ids"), tokens.vocabulary(NAMES[1]), 2).collect()
    rows = sorted(odd_texts + [(None, "no id"), odd_texts[0]], key=lambda r: (r[0] is not None, r[0] or 0))
    start, want = 0, []
    for (key, _), ids in zip(rows, library_ids(NAMES[1], [t for _, t in rows], 2)):
        want.append((key, start, len(ids), crc(ids)))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_small_shards(frame, odd_texts, tmp_path, spark):
    path = str(tmp_path / "small")
    bitpack.write_shards(frame(odd_texts), path, tokens.vocabulary(NAMES[1]), 2, shard_ids=100)
    shards = spark.read.parquet(path)
    assert shards.count() > 8
    got = bitpack.read_documents(shards).orderBy("start").collect()
    ids = library_ids(NAMES[1], [t for _, t in odd_texts], 2)
    assert [r["ids_crc32"] for r in got] == [crc(x) for x in ids]
    assert [r["start"] for r in got] == np.cumsum([0] + [len(x) for x in ids])[:-1].tolist()


def test_empty_table_has_no_ids(frame, tmp_path):
    assert bitpack.encode_and_read(frame([]), str(tmp_path / "none"), tokens.vocabulary(NAMES[1]), 2).count() == 0


def test_cuts_fill_every_place_once():
    draw = random.Random(5)
    for _ in range(200):
        length, sequences = draw.choice([4, 8, 16]), draw.randint(1, 4)
        window = length * sequences
        sizes = [draw.randint(1, 400) for _ in range(draw.randint(1, 5))]
        total = sum(sizes)
        if any(size * window < total for size in sizes):
            continue
        filled, below = {}, 0
        for queue, size in enumerate(sizes):
            begin = 0
            while begin < size:
                end = min(size, begin + draw.randint(1, 60))
                found = packing.cuts(begin, end, below, size, total, window, length)
                ends = [at for at, _, _ in found[1:]] + [end]
                for (at, sequence, offset), stop in zip(found, ends):
                    assert offset + stop - at <= length
                    for i in range(stop - at):
                        assert (sequence, offset + i) not in filled
                        filled[sequence, offset + i] = queue
                begin = end
            below += size
        assert sorted(s * length + o for s, o in filled) == list(range(total))
        for k in range(total // window):  # every window has each queue's share, to a token
            for queue, size in enumerate(sizes):
                upto = sum(1 for (s, _), q in filled.items() if q == queue and s < (k + 1) * sequences)
                assert abs(upto - (k + 1) * window * size / total) < 1


def test_packed_documents(frame, odd_texts):
    many = [(1000 + i, "w " * 40, "tiny" if i == 0 else "big") for i in range(60)]
    rows = [(k, t, None if k == 4 else f"s{k % 3}") for k, t in odd_texts] + many
    docs = frame(rows, "doc_id long, text string, source string").repartition(4)
    got = packing.pack_documents(docs, tokens.vocabulary(NAMES[0]), 1, length=64, window_sequences=2).collect()
    ids = dict(zip([r[0] for r in rows], library_ids(NAMES[0], [r[1] for r in rows], 1)))
    pieces = {}
    for row in got:
        pieces.setdefault(row["doc_id"], []).append(row)
        part = ids[row["doc_id"]][row["start"]:row["start"] + row["length"]]
        assert len(part) == row["length"] and crc(part) == row["ids_crc32"] and row["doc_tokens"] == len(ids[row["doc_id"]])
    for key, own in pieces.items():
        own.sort(key=lambda r: r["start"])
        assert [r["start"] for r in own] == np.cumsum([0] + [r["length"] for r in own])[:-1].tolist()
        assert sum(r["length"] for r in own) == len(ids[key])
    assert set(pieces) == set(ids)
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in got)
    at = 0
    for sequence, offset, length in places:
        assert (sequence, offset) == divmod(at, 64)
        at += length
    assert at == sum(map(len, ids.values()))


def test_targets_hold_until_a_queue_runs_dry():
    draw = random.Random(6)
    for _ in range(200):
        length, sequences = draw.choice([4, 8, 16]), draw.randint(1, 4)
        window = length * sequences
        n = draw.randint(1, 5)
        sizes, weights = [draw.randint(1, 300) for _ in range(n)], [draw.randint(1, 9) for _ in range(n)]
        if min(weights) * window < sum(weights):
            continue
        total, filled = sum(sizes), {}
        for queue, size in enumerate(sizes):
            parts, begin = packing.phases(sizes, weights, queue), 0
            while begin < size:
                end = min(size, begin + draw.randint(1, 60))
                found, _ = packing.cuts_of(begin, end, parts, total, window, length)
                ends = [at for at, _, _ in found[1:]] + [end]
                for (at, sequence, offset), stop in zip(found, ends):
                    for i in range(stop - at):
                        assert (sequence, offset + i) not in filled
                        filled[sequence, offset + i] = queue
                begin = end
        assert sorted(s * length + o for s, o in filled) == list(range(total))
        given, left = [0.0] * n, list(range(n))  # plain renormalisation, a window at a time
        for k in range(total // window):
            need = float(window)
            while need > 1e-9:
                whole = sum(weights[q] for q in left)
                step = min([need / whole] + [(sizes[q] - given[q]) / weights[q] for q in left])
                need -= step * whole
                for q in left:
                    given[q] += step * weights[q]
                left = [q for q in left if sizes[q] - given[q] > 1e-9]
            for queue in range(n):
                upto = sum(1 for (s, _), q in filled.items() if q == queue and s < (k + 1) * sequences)
                assert abs(upto - given[queue]) < 1 + 1e-6


def test_target_shares_and_small_sources(frame):
    rows = [(i, "w " * 30, f"s{i % 2}") for i in range(300)] + [(1000 + i, "w " * 12, f"h{i % 60}") for i in range(240)]
    docs = frame(rows, "doc_id long, text string, source string").repartition(3)
    pack = lambda **more: packing.pack_documents(
        docs, tokens.vocabulary(NAMES[0]), 1, length=16, window_sequences=2, **more).toPandas()
    got = pack(targets={"s0": 0.6, "s1": 0.3})
    size = got.groupby("source")["length"].sum()
    assert size.sum() == got.drop_duplicates("doc_id")["doc_tokens"].sum() and got["doc_id"].nunique() == len(rows)
    head = got[got["sequence_id"] < 200]
    assert abs(head[head["source"] == "s0"]["length"].sum() - 0.6 * 3200) <= 1
    assert abs(head[head["source"] == "s1"]["length"].sum() - 0.3 * 3200) <= 1
    small = pack()
    small = small[small["source"].str.startswith("h")]
    half = small[small["sequence_id"] < small["sequence_id"].max() / 2]
    assert half["source"].nunique() == 60 and half.groupby("source")["doc_id"].nunique().max() <= 3
    with pytest.raises(ValueError):
        pack(targets={"s0": 0.6, "s1": 0.4})


def test_empty_table_packs_nothing(frame):
    docs = frame([], "doc_id long, text string, source string")
    assert packing.pack_documents(docs, tokens.vocabulary(NAMES[0])).count() == 0
