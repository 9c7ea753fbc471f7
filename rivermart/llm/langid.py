"""Operator 9: language by unigram pieces, summed over all segmentations.

The pieces are a public vocabulary's; each language has its own probabilities
of them. A word's probability is the sum over every way to cut it into pieces,
by the forward algorithm, and a text's is the product over its words (runs of
letters, in lower case, with the vocabulary's word mark in front). The
probabilities are learned by expectation-maximisation: the forward-backward
algorithm spreads each word over its segmentations. Every piece of the vocabulary
takes part, and no word is cut: beyond ``LONG_WORD`` characters the forward values
are rescaled and carried from block to block.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rivermart.llm import common

#: Documents per language that the model is fitted on, about: the documented bound of the sample.
FIT_DOCUMENTS = 1500
ROUNDS = 2
#: Weight of the pooled probabilities in a language's own, in pieces.
PRIOR_PIECES = 200.0
#: Words kept with their scores per worker, in numbers stored, and in characters.
KEPT_NUMBERS, KEPT_CHARACTERS = 1_500_000, 4_000_000
#: Multiplies a piece's probability per character, so that long words stay in range.
LIFT = 32.0
#: Longer words are worked out in blocks of places, rescaled every so many places.
LONG_WORD, BLOCK, RESCALE = 48, 1024, 32
MARK = "▁"
LETTERS = re.compile(r"[^\W\d_]+")
PREDICTED = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())]


def pieces_of(vocabulary_path: str) -> list[str]:
    """The vocabulary's pieces of letters, with or without the word mark in front."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path)
    found = set()
    for i in range(library.get_piece_size()):
        piece = library.id_to_piece(i)
        body = piece.removeprefix(MARK)
        if not library.is_control(i) and not library.is_byte(i) and not library.is_unknown(i) \
                and piece and (body == "" or body.isalpha()):
            found.add(piece.lower())
    return sorted(found | {MARK})


def substring_hashes(points: np.ndarray, longest: int) -> list[np.ndarray]:
    """For each length 1..longest the hash of the substring at every position."""
    sums = common.prefix_sums(common.mix(points.astype(np.uint64) + np.uint64(1)))
    _, down = common.power_tables(len(points) + 1)
    return [common.mix((sums[n:] - sums[:-n]) * down[:len(points) - n + 1] + np.uint64(n))
            if n <= len(points) else np.zeros(0, np.uint64) for n in range(1, longest + 1)]


class Pieces:
    """Finds the pieces at every place of many words at once."""

    def __init__(self, pieces: list[str]):
        self.longest = max(map(len, pieces))
        hashes = np.array([substring_hashes(points_of(p), len(p))[-1][0] for p in pieces], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.numbers, self.n = hashes[order], order, len(pieces)
        self.lift = LIFT ** np.array([*map(len, pieces), 0, 1], float)

    def lattice(self, words: list[str]) -> np.ndarray:
        """Numbers of the pieces at [word, place, length - 1], words of one length; n where there is none.

        A character that is no piece itself gets n + 1, the unknown piece.
        """
        width = len(words[0])
        points = points_of("".join(words))
        out = np.full((len(words), width, self.longest), self.n, np.int64)
        for i, hashes in enumerate(substring_hashes(points, self.longest)):
            if i >= width:
                break
            inside = np.full(len(points), 0, np.uint64)
            inside[:len(hashes)] = hashes
            inside = inside.reshape(len(words), width)[:, :width - i]
            at = np.minimum(np.searchsorted(self.hashes, inside), len(self.hashes) - 1)
            out[:, :width - i, i] = np.where(self.hashes[at] == inside, self.numbers[at], self.n)
        out[:, :, 0] = np.where(out[:, :, 0] == self.n, self.n + 1, out[:, :, 0])
        return out

    def lifted(self, chances: np.ndarray, unknown: float = 1e-6) -> np.ndarray:
        """Lifted rows for the pieces, for none and for the unknown piece."""
        rest = np.zeros((2, chances.shape[1]))
        rest[1] = unknown
        return np.vstack([chances, rest]) * self.lift[:, None]

    def blocks(self, words: list[str]):
        """The lattice of words of one length by blocks of places: first place and [word, place, length - 1]."""
        for first in range(0, len(words[0]), BLOCK):
            some = self.lattice([w[first:first + BLOCK + self.longest - 1] for w in words])
            yield first, some[:, :BLOCK]


def points_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def forward(lattice: np.ndarray, table: np.ndarray, none: int) -> np.ndarray:
    """Lifted probability of the first t characters: [word, t, column of table]."""
    n, width, longest = lattice.shape
    out = np.zeros((n, width + 1, table.shape[1]))
    out[:, 0] = 1
    for t in range(1, width + 1):
        for i in range(1, min(longest, t) + 1):
            piece = lattice[:, t - i, i - 1]
            at = np.flatnonzero(piece != none)
            if len(at):
                out[at, t] += out[at, t - i] * table[piece[at]]
    return out


def log_forward(finder: Pieces, words: list[str], table: np.ndarray, every: bool = False) -> np.ndarray:
    """Logs of the lifted probabilities of words of one length, however long: [word, column].

    ``every`` gives those of all beginnings instead: [word, t, column].
    """
    n, width = len(words), len(words[0])
    ahead = np.zeros((n, finder.longest + 1, table.shape[1]))  # of the next places, as far as they are summed
    ahead[:, 0] = 1
    logs = np.zeros((n, table.shape[1]))
    kept = np.zeros((n, width + 1, table.shape[1])) if every else None
    for first, lattice in finder.blocks(words):
        for t in range(lattice.shape[1]):
            ahead[:, 1:] += ahead[:, :1] * table[lattice[:, t]]
            ahead[:, :-1] = ahead[:, 1:]
            ahead[:, -1] = 0
            if t % RESCALE == 0:
                top = ahead.max(axis=1)
                ahead /= top[:, None]
                logs += np.log(top)
            if every:
                kept[:, first + t + 1] = logs + np.log(ahead[:, 0])
    return kept if every else logs + np.log(ahead[:, 0])


def expected(finder: Pieces, words: list[str], table: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations of words of one length, with table's one column."""
    if len(words[0]) > LONG_WORD:
        return _expected_long(finder, words, table, counts)
    lattice = finder.lattice(words)
    ahead = forward(lattice, table, finder.n)[:, :, 0]
    n, width, longest = lattice.shape
    behind = np.zeros((n, width + 1))
    behind[:, width] = 1
    for t in range(width - 1, -1, -1):
        for i in range(1, min(longest, width - t) + 1):
            behind[:, t] += behind[:, t + i] * table[lattice[:, t, i - 1], 0]
    out = np.zeros(len(table))
    scale = counts / np.maximum(ahead[:, width], 1e-300)
    for i in range(1, min(longest, width) + 1):
        use = ahead[:, :width - i + 1] * table[lattice[:, :width - i + 1, i - 1], 0] * behind[:, i:]
        out += np.bincount(lattice[:, :width - i + 1, i - 1].ravel(), (use * scale[:, None]).ravel(), len(table))
    return out


def _expected_long(finder: Pieces, words: list[str], table: np.ndarray, counts: np.ndarray) -> np.ndarray:
    ahead = log_forward(finder, words, table, every=True)[:, :, 0]
    n, width, longest = len(words), len(words[0]), finder.longest
    out = np.zeros(len(table))
    behind, log = np.zeros((n, longest)), np.zeros(n)  # of the places after this one
    behind[:, 0] = 1
    for first in range((width - 1) // BLOCK * BLOCK, -1, -BLOCK):
        lattice = finder.lattice([w[first:first + BLOCK + longest - 1] for w in words])[:, :BLOCK]
        uses = np.zeros(lattice.shape)
        for t in range(lattice.shape[1] - 1, -1, -1):
            part = table[lattice[:, t], 0] * behind
            uses[:, t] = part * np.exp(ahead[:, first + t] + log - ahead[:, width])[:, None]
            behind[:, 1:] = behind[:, :-1]
            behind[:, 0] = part.sum(axis=1)
            if t % RESCALE == 0:
                top = behind.max(axis=1)
                behind /= top[:, None]
                log += np.log(top)
        out += np.bincount(lattice.ravel(), (uses * counts[:, None, None]).ravel(), len(table))
    return out


def by_length(words: list[str], limit: int = 20_000):
    """Positions of words of one length, at most so many characters together."""
    lengths = np.array([len(w) for w in words])
    order = np.argsort(lengths, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(words) else ():
        step = max(1, limit // len(words[part[0]]))
        for i in range(0, len(part), step):
            yield part[i:i + step]


def letter_words(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


class Scorer:
    """Log probability of a text in each language; each distinct word is worked out once."""

    def __init__(self, pieces: list[str], chances: np.ndarray):
        self.pieces = Pieces(pieces)
        self.table = self.pieces.lifted(chances)
        self.languages = chances.shape[1]
        self.known: dict[str, int] = {}
        self.values = np.zeros((0, self.languages))
        self.characters = 0

    def learn(self, words: list[str]) -> None:
        # A run without a letter scores nothing and is marked by -1.
        real = np.array([any(map(str.isalpha, w)) for w in words])
        owner = np.flatnonzero(real)
        marked = [MARK + words[i] for i in owner]
        scores = np.zeros((len(words), self.languages))
        for at in by_length(marked):
            some = [marked[i] for i in at]
            if len(some[0]) > LONG_WORD:
                logs = log_forward(self.pieces, some, self.table)
            else:
                logs = np.log(np.maximum(forward(self.pieces.lattice(some), self.table, self.pieces.n)[:, -1], 1e-300))
            scores[owner[at]] = logs - len(some[0]) * np.log(LIFT)
        first = len(self.values)
        self.known.update((w, first + i if r else -1) for i, (w, r) in enumerate(zip(words, real.tolist())))
        self.values = np.vstack([self.values, scores])
        self.characters += sum(map(len, words))

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Log probabilities [text, language] and the number of words with a letter."""
        found = [letter_words(t) for t in texts]
        if len(self.values) * self.languages > KEPT_NUMBERS or self.characters > KEPT_CHARACTERS:
            self.known.clear()
            self.characters = 0
            self.values = np.zeros((0, self.languages))
        new = set().union(*found) - self.known.keys() if found else set()
        if new:
            self.learn(sorted(new))
        logs, counts = np.zeros((len(texts), self.languages)), np.zeros(len(texts), np.int64)
        get = self.known.__getitem__
        for i, words in enumerate(found):
            at = np.fromiter(map(get, words), np.int64, len(words))
            at = at[at >= 0]
            counts[i] = len(at)
            logs[i] = self.values[at].sum(axis=0)
        return logs, counts


def _pooled(counts: np.ndarray) -> np.ndarray:
    """Each language's counts, smoothed towards the pooled probabilities."""
    pool = counts.sum(axis=1) + 0.5
    pool = pool / pool.sum()
    return (counts + PRIOR_PIECES * pool[:, None]) / (counts.sum(axis=0) + PRIOR_PIECES)


def fit(docs: DataFrame, vocabulary_path: str, fit_documents: int = FIT_DOCUMENTS, rounds: int = ROUNDS
        ) -> tuple[list[str], list[str], np.ndarray]:
    """Languages, pieces and their probabilities [piece, language], from rows (doc_id, text, lang).

    A language with more than about ``fit_documents`` documents is represented
    by so many, chosen by a hash of doc_id. The driver gets one number for each
    piece and language, whatever the number of documents.
    """
    spark = docs.sparkSession
    counts = {row["lang"]: row["count"] for row in docs.where("lang is not null").groupBy("lang").count().collect()}
    languages, pieces = sorted(counts), pieces_of(vocabulary_path)
    if not languages:
        return [], pieces, np.zeros((len(pieces), 0))
    shares = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, fit_documents / counts[lang]))])
    draw = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(0))), F.lit(1 << 40)) / float(1 << 40)
    sample = common.stored(docs.where("lang is not null").where(draw < shares[F.col("lang")]).select("text", "lang"),
                           "language-sample")
    number = {lang: i for i, lang in enumerate(languages)}
    kinds = [("lang", pa.int32()), ("piece", pa.int32()), ("uses", pa.float64())]
    chances = None
    for step in range(rounds + 1):
        known = spark.sparkContext.broadcast((pieces, chances))

        def spread(batches):
            names, now = known.value
            finder = Pieces(names)
            words: dict[int, dict[str, int]] = {}
            for batch in batches:
                for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    own = words.setdefault(number[lang], {})
                    for word in letter_words(text):
                        own[word] = own.get(word, 0) + 1
            for lang, own in words.items():
                marked, weights = [MARK + word for word in own], np.array(list(own.values()), float)
                if now is None:  # at first every piece of a length is as likely
                    table = finder.lifted(np.array([[len(p) ** 2 * 0.1 / len(names)] for p in names]))
                else:
                    table = finder.lifted(now[:, lang:lang + 1])
                uses = np.zeros(len(table))
                for at in by_length(marked):
                    uses += expected(finder, [marked[i] for i in at], table, weights[at])
                some = np.flatnonzero(uses[:len(names)] > 1e-6)
                yield common.batch_of(kinds, np.full(len(some), lang, np.int32), some.astype(np.int32), uses[some])

        made = common.map_arrow(sample, spread, "lang int, piece int, uses double")
        got = made.groupBy("lang", "piece").agg(F.sum("uses").alias("uses")).toPandas()
        counted = np.zeros((len(pieces), len(languages)))
        counted[got["piece"].to_numpy(), got["lang"].to_numpy()] = got["uses"].to_numpy()
        chances = _pooled(counted)
    return languages, pieces, chances


_SCORERS: dict[str, Scorer] = {}


class _Judge:
    """Language and score of batches of texts, on a worker."""

    def __init__(self, docs: DataFrame, model: tuple[list[str], list[str], np.ndarray]):
        self.known = docs.sparkSession.sparkContext.broadcast(model)
        self.key = uuid.uuid4().hex

    def __call__(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        languages, pieces, chances = self.known.value
        common.claim("language", _SCORERS.clear)
        if self.key not in _SCORERS:  # one scorer is kept, with the words it has met
            _SCORERS.clear()
            _SCORERS[self.key] = Scorer(pieces, chances)
        names, scores = ["und"] * len(texts), np.zeros(len(texts))
        _, bounds = common.utf8(texts)
        for low, high in common.chunks(bounds) if languages else ():
            logs, counts = _SCORERS[self.key].score(texts.slice(low, high - low).to_pylist())
            best = logs.argmax(axis=1)
            odds = np.exp(logs - logs.max(axis=1, keepdims=True))
            scores[low:high] = np.where(counts > 0, 1 / odds.sum(axis=1), 0.0)
            names[low:high] = [languages[b] if n else "und" for b, n in zip(best, counts)]
        return names, scores


def identify(docs: DataFrame, vocabulary_path: str, fit_documents: int = FIT_DOCUMENTS) -> DataFrame:
    """Predict the language of every row of ``docs`` (doc_id, text, lang).

    Only rows whose crc32(doc_id) modulo 4 is not 2 are learned from; a row
    without doc_id is neither held out nor learned from. The score is the
    prediction's posterior among the languages; ties go to the first by name.
    A null text or one without letters is 'und' with score 0, as is every text
    if no row has a language. Other columns are ignored.
    """
    rows, judge = _fitted(docs, vocabulary_path, fit_documents)

    def predict(batches):
        for batch in batches:
            yield common.batch_of(PREDICTED, batch.column(0), batch.column(2), *judge(batch.column(1)))

    return common.map_arrow(rows.select("doc_id", "text", "held_out"), predict,
                            "doc_id long, held_out boolean, lang_pred string, score double")


def _fitted(docs: DataFrame, vocabulary_path: str, fit_documents: int) -> tuple[DataFrame, _Judge]:
    """The rows as (doc_id, text, lang, held_out), and what judges them."""
    common.prepare(docs.sparkSession)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"), F.coalesce(held, F.lit(False)).alias("held_out"))
    model = fit(rows.where(~F.col("held_out") & F.col("doc_id").isNotNull()), vocabulary_path, fit_documents)
    return rows, _Judge(docs, model)


def keep_identified(docs: DataFrame, vocabulary_path: str, fit_documents: int = FIT_DOCUMENTS, least: float = 0.5
                    ) -> DataFrame:
    """The rows of ``docs`` whose text has a language with at least that posterior; all columns stay."""
    _, judge = _fitted(docs, vocabulary_path, fit_documents)
    at = docs.columns.index("text")

    def keep(batches):
        for batch in batches:
            names, scores = judge(batch.column(at))
            yield batch.filter(pa.array((scores >= least) & (np.array(names) != "und")))

    return docs.mapInArrow(keep, docs.schema)
