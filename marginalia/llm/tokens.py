"""Whole-text token ids by word pieces, equal to encoding the text in one call.

The byte-level pre-tokeniser of ``byte_bpe_50k.json`` always cuts where white
space follows a character that isn't white space, and looks at nothing before
the cut. So a text's ids are the ids of the pieces between those cuts, and
pieces repeat: a bounded memo per Python worker holds their ids.
"""

from __future__ import annotations

import re
import struct

from .common import Remembered, held

VOCABULARY = "byte_bpe_50k.json"
# Cut only at a blank or newline after a character that no Unicode version
# calls white space: both sides of such a cut are independent.
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
# Texts with two white-space characters in a row, or any but blank and newline, take the general cut.
_UNUSUAL = ("  ", " \n", "\n ", "\n\n", *(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"))
# Perhaps a newline, letters of every Unicode version, one run of marks: each a pre-token, a blank before letters included.
_PLAIN = re.compile(r"(\n?)([A-Za-zÀ-ÖØ-öø-ɏ]+)([.,;:!?]*)")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the other bytes follow from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class WordEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        letters = _byte_letters()
        self.blank = letters[32]
        self.letters = str.maketrans({chr(b): c for b, c in letters.items()})
        self.first = Remembered(self._encode, 50_000)
        self.later = Remembered(self._later, 500_000)

    def _encode(self, piece: str) -> bytes:
        ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _stem(self, letters: str) -> bytes:
        """One pre-token in the byte-level alphabet."""
        ids = [t.id for t in self.tokenize(letters)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _later(self, piece: str) -> bytes:
        """A piece after the first; a leading newline is kept in the key, a leading blank is not."""
        if piece.isascii() and piece.isalpha():
            return self._stem(self.blank + piece)
        plain = _PLAIN.fullmatch(piece)
        if plain is None:
            return self._encode(piece if piece[:1] == "\n" else " " + piece)
        newline, stem, marks = plain.groups()
        if newline:
            ids = self.first["\n"] + self.first[stem]
        elif marks:
            ids = self.later[stem]
        else:
            return self._stem(self.blank + stem.encode().decode("latin-1").translate(self.letters))
        return ids + self.first[marks] if marks else ids

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(map(text.__contains__, _UNUSUAL)):
            return b"".join(map(self.first.__getitem__, _CUT.split(text)))
        pieces = text.replace("\n", " \n").split(" ")
        return self.first[pieces[0]] + b"".join(map(self.later.__getitem__, pieces[1:]))


def word_encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker, kept between tasks."""
    return held(("tokens", path), lambda: WordEncoder(path))
