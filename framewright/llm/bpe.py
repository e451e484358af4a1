"""Byte-level BPE encoding and decoding.

A piece of text becomes a doubly linked list of symbols (two index arrays). A
priority queue holds (merge rank, position) of the adjacent pairs; the lowest
rank, leftmost first, is merged; an entry is stale, and skipped, if its left
symbol is gone or the pair there has changed since. Decoding concatenates the
vocabulary's byte strings. Pieces recur, so their ids are remembered, in a
bounded table per Python worker.

Defined cases: null and empty texts have no ids and decode to the empty text;
repeated rows and null ids are kept as they are; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from framewright.llm import common
from framewright.llm.tokens import _PIECES, _PLAIN, Chunks, Irregular, byte_alphabet

#: Fixed value: the pre-tokenizer's pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEMO_CHUNKS, MEMO_PIECES = 600_000, 200_000


class BytePairEncoder:
    """Reads vocabulary, merge ranks and special tokens from a tokenizer's JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        raw = lambda s: bytes(byte_of[c] for c in s)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocabulary = {raw(s): i for s, i in spec["model"]["vocab"].items() if s not in self.special}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.rank_of: dict[tuple[int, int], int] = {}
        self.left, self.right, self.merged = [], [], []  # by rank
        for rank, (a, b) in enumerate(pairs):
            a, b = raw(a), raw(b)
            self.rank_of.setdefault((vocabulary[a], vocabulary[b]), rank)
            for by_rank, s in ((self.left, a), (self.right, b), (self.merged, a + b)):
                by_rank.append(vocabulary[s])
        self.of_byte = [vocabulary[bytes([b])] for b in range(256)]
        self.strings = [b""] * (1 + max([*vocabulary.values(), *self.special.values()]))
        for s, i in vocabulary.items():
            self.strings[i] = s
        for s, i in self.special.items():
            self.strings[i] = s.encode()
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pattern = regex.compile(PATTERN)
        self.known: dict[str, tuple[int, ...]] = {}
        self.chunks = Chunks(self._piece, self._pieces, MEMO_CHUNKS)

    def merge(self, data: bytes) -> list[int]:
        """Ids of one piece. Queue entries are rank * size + position."""
        of, rank_of, left, right = self.of_byte, self.rank_of, self.left, self.right
        symbol = [of[b] for b in data]
        n = len(symbol)
        if n < 2:
            return symbol
        queue = [rank_of[pair] * n + i for i, pair in enumerate(zip(symbol, symbol[1:])) if pair in rank_of]
        if not queue:
            return symbol
        after, before = list(range(1, n + 1)), list(range(-1, n))
        heapq.heapify(queue)
        while queue:
            rank, i = divmod(heapq.heappop(queue), n)
            j = after[i]
            if symbol[i] != left[rank] or j >= n or symbol[j] != right[rank]:
                continue  # stale
            symbol[i] = merged = self.merged[rank]
            symbol[j] = -1
            k = after[i] = after[j]
            before[k] = i
            if k < n and (found := rank_of.get((merged, symbol[k]))) is not None:
                heapq.heappush(queue, found * n + i)
            h = before[i]
            if h >= 0 and (found := rank_of.get((symbol[h], merged))) is not None:
                heapq.heappush(queue, found * n + h)
        return [s for s in symbol if s >= 0]

    def _piece(self, piece: str) -> tuple[int, ...]:
        return tuple(self.merge(piece.encode()))

    def _pieces(self, text: str) -> tuple[int, ...]:
        pieces, ids = _PIECES.findall(text) if _PLAIN.fullmatch(text) else self.pattern.findall(text), []
        for piece in pieces:
            got = self.known.get(piece)
            if got is None:
                got = self._piece(piece)
                if len(self.known) < MEMO_PIECES:
                    self.known[piece] = got
            ids += got
        return tuple(ids)

    def _part(self, text: str) -> Iterable[int]:
        """The pattern never joins text across a single space between two words, so a text is cut there."""
        first, *rest = text.split(" ")
        try:
            if not first or first[-1].isspace():
                raise Irregular
            return chain(self._pieces(first), chain.from_iterable(list(map(self.chunks.__getitem__, rest))))
        except Irregular:
            return self._pieces(text)

    def encode(self, text: str | None) -> list[int]:
        ids: list[int] = []
        for part in self.cut.split(text) if text and self.cut else [text or ""]:
            if part in self.special:
                ids.append(self.special[part])
            elif part:
                ids += self._part(part)
        return ids

    def decode(self, ids: list[int]) -> str:
        """Bytes that are no UTF-8 become the replacement character."""
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


_LOADED: dict[str, BytePairEncoder] = {}


def encoder(path: str) -> BytePairEncoder:
    if path not in _LOADED:
        _LOADED[path] = BytePairEncoder(path)
    return _LOADED[path]


def encode_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids array<int>) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary)
        for batch in batches:
            ids = pa.array([bpe.encode(t.as_py()) for t in batch.column(1)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    common.ship(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Encodes every text, decodes the ids, and returns digests of both: (doc_id, n_tokens, ids_sha256, decoded_sha256)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(vocabulary)
        decimal = [str(i) for i in range(len(bpe.strings))]
        for batch in batches:
            count, of_ids, of_text = [], [], []
            for text in batch.column(1):
                ids = bpe.encode(text.as_py())
                count.append(len(ids))
                of_ids.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                of_text.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    common.ship(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
