"""Token ids by the tokenizers library, each distinct piece of text encoded once."""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Callable

import numpy as np

from rivermart.llm import common

#: Distinct pieces kept per worker; the store is emptied when it is full.
KEPT_PIECES = 700_000
#: Texts with these are encoded whole: the two sides may disagree about what a space is.
ODD_SPACES = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
SPACED = re.compile(r" ?[^ \t-\r]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+")


#: A word and the marks after it: the vocabularies split there if the word stays one of letters.
MARKED = re.compile(r"( ?[^\W\d_]+)([!-/:-@[-^`{-~]+)")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    bytes for themselves, the others by the next letters from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {**{b: chr(b) for b in printable}, **{b: chr(256 + i) for i, b in enumerate(others)}}


LETTERS = byte_letters()


def spaced_pieces(text: str) -> list[str]:
    """Words with the one space before them, and other runs of spaces: the
    points between them are bounds of byte-level BPE's own first split."""
    return SPACED.findall(text)


def bare_words(text: str) -> list[str]:
    """Words alone, for vocabularies that drop white space."""
    return text.split()


def stays_letters(word: str) -> bool:
    """Whether a word is of letters only, also when composed and in lower case.

    Some letters are not: a capital I with a dot, or Indic letters with a nukta,
    come apart into a letter and a mark, which joins the marks that follow.
    """
    return word.isalpha() and unicodedata.normalize("NFC", word).lower().isalpha()


class Pieces(dict):
    """Ids of pieces of text, worked out when first asked for."""

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.merges = self.library.model
        #: Whether the vocabulary drops white space (and lowers letters).
        self.drops = self.library.encode(" \n ", add_special_tokens=False).ids == []

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def word(self, piece: str) -> bytes | None:
        """Ids of a plain word, straight from the library's merges; None if it is none."""
        if self.drops:
            piece = piece.lower()
            plain = piece.isalpha() and max(piece) < "\u0250"
        else:
            plain = piece.removeprefix(" ").isalpha()
        if not plain:
            return None
        made = self.merges.tokenize(piece.encode().decode("latin-1").translate(LETTERS))
        return np.array([t.id for t in made], "<u4").tobytes()

    def __missing__(self, piece: str) -> bytes:
        """A word by itself, a word with marks in two parts, all else by the library's whole procedure."""
        ids = self.word(piece)
        if ids is None:
            match = MARKED.fullmatch(piece)
            parts = match and stays_letters(match[1].removeprefix(" "))
            ids = self[match[1]] + self[match[2]] if parts else self.whole(piece)
        self[piece] = ids
        return ids


class Encoder:
    """Equal to ``Tokenizer.encode(text, add_special_tokens=False).ids`` for every text.

    Both kinds of vocabulary split a text at spaces before they merge, so the
    ids of a text are those of its pieces. Texts that hold a special token's
    string or an unusual space are given to the library whole.
    """

    def __init__(self, path: str, kept: int = KEPT_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.kept, self.known = kept, Pieces(path)
        library = self.known.library
        self.special = [t.content for t in library.get_added_tokens_decoder().values()]
        self.split: Callable[[str], list[str]] = bare_words if self.known.drops else spaced_pieces
        self.size = library.get_vocab_size()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text; give about a megabyte at a time."""
        if len(self.known) > self.kept:
            self.known.clear()
        get = self.known.__getitem__
        return [self.known.whole(t) if ODD_SPACES.search(t) or any(s in t for s in self.special)
                else b"".join(map(get, self.split(t))) for t in texts]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary."""
    common.claim("tokens", _ENCODERS.clear)
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
