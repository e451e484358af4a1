"""Token ids of whole texts by the tokenizers library, at corpus speed.

Plain Latin text is cut into the pieces of the byte-level pre-tokenizer, whose
ids are remembered (bounded). The text's other pieces go to the library's BPE
model together, with a character between them that none of its merges has.

The pre-tokenizer never joins text across a single space that has a non-space
on both sides, so any other text is cut there and each chunk's ids are
remembered (bounded). Its chunks of plain Latin text go piece by piece to the
model, the others whole through the library's encode; such a text with white
space next to a space is encoded whole by the library.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np

MEMO_CHUNKS, MEMO_PIECES = 60_000, 200_000
MEMO_LENGTH = 32  # characters of what is remembered at most: a worker outlives its tasks, and what it remembers too
PORTION = 64  # pieces that go to the model together
SEPARATOR = 0  # a byte that plain text hasn't

_LATIN = "A-Za-zÀ-ÖØ-öø-ſ"
_PLAIN = re.compile(f"[\\n\\x20-\\x7e{_LATIN}]*")
_PIECES = re.compile(f"'(?:s|t|re|ve|m|ll|d)| ?[{_LATIN}]+| ?[0-9]+| ?[^\\s0-9{_LATIN}]+|\\s+(?!\\S)|\\s+")
_WORD = re.compile(f"[{_LATIN}]+")


def byte_alphabet() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable bytes stand for themselves, the rest follow from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in set(printable) else chr(next(rest)) for b in range(256)]


class Irregular(Exception):
    """White space beside a space: the text is not cut."""


class Chunks(dict):
    """Remembered ids of ' ' + chunk. A word before a comma or a full stop is remembered without it."""

    def __init__(self, word, other, limit: int):
        super().__init__()
        self.word, self.other, self.limit = word, other, limit
        self.ends = {c: other(c) for c in ",."}

    def __missing__(self, chunk: str) -> bytes:
        end = self.ends.get(chunk[-1:])
        if end is not None:
            word = chunk[:-1]
            if word.isalpha() and (word.isascii() or _WORD.fullmatch(word)):
                return self[word] + end
        if _WORD.fullmatch(chunk):
            ids = self.word(" " + chunk)
        else:
            if not chunk or chunk[0].isspace() or chunk[-1].isspace():
                raise Irregular
            ids = self.other(" " + chunk)
        if len(self) < self.limit and len(chunk) <= MEMO_LENGTH:
            self[chunk] = ids
        return ids


class Pieces(dict):
    """Remembered ids of pieces. What isn't there gets an empty place in `missed`, to be filled in together."""

    def __init__(self):
        super().__init__()
        self.missed: dict[str, bytearray] = {}

    def __missing__(self, piece: str) -> bytearray:
        return self.missed.setdefault(piece, bytearray())


class TokenIds:
    """text -> ids as little-endian uint32 bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenize = self.tokenizer.model.tokenize
        self.letters = {i: c for i, c in enumerate(byte_alphabet())}
        self.symbols = np.array(list(map(ord, byte_alphabet())), "<u2")
        self.bare = Tokenizer(self.tokenizer.model)  # the model alone
        self.end = self._separator_id()
        self.pieces = Pieces()
        self.chunks = Chunks(self._piece, self._chunk, MEMO_CHUNKS)

    def _separator_id(self) -> int | None:
        """The separator's id; None if the model may treat joined pieces otherwise than each alone."""
        letter, vocab = self.letters[SEPARATOR], self.tokenizer.get_vocab(with_added_tokens=False)
        if self.tokenizer.model.ignore_merges or any(letter in token for token in vocab if token != letter):
            return None
        return vocab.get(letter)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _model(self, piece: str) -> bytes:
        symbols = piece.encode().decode("latin-1").translate(self.letters)
        return b"".join([t.id.to_bytes(4, "little") for t in self.tokenize(symbols)])

    def _models(self, pieces: list[str]) -> Iterator[bytes]:
        """The ids of each piece of plain text."""
        if self.end is None:
            yield from map(self._model, pieces)
            return
        for i in range(0, len(pieces), PORTION):
            joined = chr(SEPARATOR).join(pieces[i:i + PORTION]).encode()
            symbols = self.symbols[np.frombuffer(joined, "u1")].tobytes().decode("utf-16-le")
            ids = np.array(self.bare.encode_batch_fast([symbols], add_special_tokens=False)[0].ids, "<u4")
            data, at = ids.tobytes(), 0
            for end in (4 * np.flatnonzero(ids == self.end)).tolist():
                yield data[at:end]
                at = end + 4
            yield data[at:]

    def _plain(self, text: str) -> bytes:
        known = self.pieces
        found = list(map(known.__getitem__, _PIECES.findall(text)))
        new, known.missed = known.missed, {}
        for (piece, place), ids in zip(new.items(), self._models(list(new))):
            place += ids
            if len(known) < MEMO_PIECES and len(piece) <= MEMO_LENGTH:
                known[piece] = ids
        return b"".join(found)

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = self._model(piece)
            if len(self.pieces) < MEMO_PIECES and len(piece) <= MEMO_LENGTH:
                self.pieces[piece] = ids
        return ids

    def _chunk(self, chunk: str) -> bytes:
        if "<|" in chunk or not _PLAIN.fullmatch(chunk):
            return self._whole(chunk)
        return b"".join(map(self._piece, _PIECES.findall(chunk)))

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if "<|" not in text and _PLAIN.fullmatch(text):
            return self._plain(text)
        first, *rest = text.split(" ")
        try:
            if not first or first[-1].isspace():
                raise Irregular
            return self._chunk(first) + b"".join(map(self.chunks.__getitem__, rest))
        except Irregular:
            return self._whole(text)


_LOADED: dict[str, TokenIds] = {}


def token_ids(path: str) -> TokenIds:
    """One encoder per Python worker and vocabulary file."""
    if path not in _LOADED:
        _LOADED[path] = TokenIds(path)
    return _LOADED[path]
