"""Spelling variants: words at one edit, found by Gram matrices of letter counts.

An inserted or deleted letter moves one letter count by one, a replaced letter two: the squared distance of the
counts of two words at one edit is 1 or 2. Words are put in order by length and by how often they have letters of
six groups, and cut into blocks. Two blocks of one length, or of adjacent lengths, meet where the boxes of
their group counts come as near as one edit allows; a task multiplies the two matrices of letter counts (90 letters), keeps
pairs at a squared distance of two at most, and verifies each by its letters. What leaves a task is one row for each word
with near words: how many, and the most frequent of them.

Which blocks meet is found by joins on the length and the first group's count. Work grows with the square of the words
whose group counts are alike, not of all words.

Defined cases: a null text has no words; rows with a null id lose no letters (there is no id to hash); repeated rows count
again; ties of frequency go to the smallest word in code-point order; a text of any length is read in parts; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.llm import common

MIN_LETTERS, MIN_COUNT, RATIO, DIVISOR = 6, 5, 5, 199
RUN = re.compile("[A-Za-zÀ-ÿ]{%d,}" % MIN_LETTERS)  # shorter ones can't make a word
BLOCK = 1024
HELD = 200_000  # words counted in a task before they are sent on
PART = 1 << 20  # code points of a text that are searched at once
CHECKED = 1 << 17  # pairs verified at once
#: Letters of each group (the rest are the last one's): about equally frequent in European languages.
GROUPS = ("eé", "aàisí", "nrcç", "toöbdh", "lmupfg")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_LETTERS = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
LETTER = np.zeros(256, dtype=np.int64)
LETTER[_LETTERS] = range(len(_LETTERS))
GROUP = np.full(256, len(GROUPS), dtype=np.int64)
for _g, _letters in enumerate(GROUPS):
    GROUP[list(_letters.encode("latin-1"))] = _g


def runs_of(text: str) -> Counter:
    """How often the lower-cased runs of a text occur; long texts are cut between runs."""
    met: Counter = Counter()
    start = 0
    while start < len(text):
        end = min(len(text), start + PART)
        while end < len(text) and (text[end].isalpha() or text[end] in "×÷"):
            end += 1
        met.update(RUN.findall(text, start, end))
        start = end
    found: Counter = Counter()
    for run, n in met.items():
        found[run.translate(_LOWER)] += n
    return found


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, int] = {}

    def sent() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
        held.clear()
        return out

    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            runs = runs_of(text.as_py() or "")
            begun = zlib.crc32(f"{key}:".encode())
            for word, n in runs.items():
                if key is not None:
                    h = zlib.crc32(word.encode(), begun)
                    if h % DIVISOR == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < MIN_LETTERS:
                            continue
                held[word] = held.get(word, 0) + n
            if len(held) >= HELD:
                yield sent()
    if held:
        yield sent()


def frequent_words(docs: DataFrame) -> DataFrame:
    """(word, n) of the words of all texts that are long and frequent enough."""
    counted = docs.select("doc_id", "text").mapInArrow(_count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= MIN_COUNT)


def _codes(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(-1, length)


def counts_of(codes: np.ndarray, kinds: np.ndarray, n: int) -> np.ndarray:
    """How often each word has each kind of letter."""
    at = np.arange(len(codes))[:, None] * n + kinds[codes]
    return np.bincount(at.ravel(), minlength=len(codes) * n).reshape(-1, n)


PLACED = "word string, n long, length int, groups array<int>"
BLOCKS = "block long, length int, low array<int>, high array<int>, words array<string>, counts array<long>"


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column(0).to_pylist()
        whole = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)
        lengths = np.array([len(w) for w in words])
        at = np.repeat(np.arange(len(words)), lengths) * (len(GROUPS) + 1) + GROUP[whole]
        groups = np.bincount(at, minlength=len(words) * (len(GROUPS) + 1)).reshape(len(words), -1)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lengths, pa.int32()), pa.array(groups.tolist(), pa.list_(pa.int32()))], [c.split()[0] for c in PLACED.split(", ")])


def _cut(block_rows: int):
    """Blocks of neighbours in the order, each of one length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            nonlocal number
            words, counts, lengths, groups = zip(*held)
            groups = np.array(groups)
            row = (number, lengths[0], groups.min(0).tolist(), groups.max(0).tolist(), list(words), list(counts))
            number += 1
            held.clear()
            types = [pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], [c.split()[0] for c in BLOCKS.split(", ")])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and (len(held) == block_rows or held[0][2] != row[2]):
                    yield block()
                held.append(row)
        if held:
            yield block()

    return run


def near_blocks(blocks: DataFrame) -> DataFrame:
    """(a, b) of blocks, of one length or b's one longer, that may hold words at one edit: boxes at most two counts apart (one, where the lengths differ)."""
    box = ["block", "length", "low", "high"]
    b = blocks.select(*[F.col(c).alias(f"b_{c}") for c in box], F.explode(F.array("length", F.col("length") - 1)).alias("at"))
    a = blocks.select(*[F.col(c).alias(f"a_{c}") for c in box], F.col("length").alias("at"))
    cells = lambda side, more: F.explode(F.sequence(F.col(f"{side}_low")[0] - more, F.col(f"{side}_high")[0] + more)).alias("cell")
    less = lambda x, y: F.zip_with(x, y, lambda p, q: p - q)
    gap = F.zip_with(less(F.col("a_low"), F.col("b_high")), less(F.col("b_low"), F.col("a_high")), lambda p, q: F.greatest(p, q, F.lit(0)))
    apart = F.aggregate(gap, F.lit(0), lambda s, g: s + g)
    met = a.select("*", cells("a", 1)).join(b.select("*", cells("b", 0)), ["at", "cell"])
    met = met.filter((F.col("a_length") < F.col("b_length")) | (F.col("a_block") <= F.col("b_block")))
    return met.filter(apart <= F.when(F.col("a_length") < F.col("b_length"), 1).otherwise(2)).select(F.col("a_block").alias("a"), F.col("b_block").alias("b")).distinct()


def one_edit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether words, row by row, differ by one replaced letter, or y's by one inserted."""
    if x.shape[1] == y.shape[1]:
        return (x != y).sum(1) == 1
    front = np.cumprod(x == y[:, :-1], axis=1, dtype=np.int8).sum(1)
    back = np.cumprod((x == y[:, 1:])[:, ::-1], axis=1, dtype=np.int8).sum(1)
    return front + back >= x.shape[1]


def near_pairs(x: np.ndarray, y: np.ndarray, own: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the words of two blocks at one edit (own: of one block, each pair once)."""
    p, q = (counts_of(codes, LETTER, len(_LETTERS)).astype(np.float32) for codes in (x, y))
    square = (p * p).sum(1)[:, None] + (q * q).sum(1)[None, :] - 2 * (p @ q.T)
    i, j = np.nonzero(square <= 2)
    if own:
        i, j = i[i < j], j[i < j]
    right = [one_edit(x[i[k:k + CHECKED]], y[j[k:k + CHECKED]]) for k in range(0, len(i), CHECKED)]
    right = np.concatenate(right) if right else np.zeros(0, bool)
    return i[right], j[right]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for own, a_words, a_counts, b_words, b_counts in zip(*(c.to_pylist() for c in batch.columns)):
            i, j = near_pairs(_codes(a_words, len(a_words[0])), _codes(b_words, len(b_words[0])), own)
            if not len(i):
                continue
            # places in both blocks together (in one block, they are the same words)
            words, counts = (a_words, a_counts) if own else (a_words + b_words, a_counts + b_counts)
            j = j if own else j + len(a_words)
            rank = np.empty(len(words), dtype=np.int64)
            order = sorted(range(len(words)), key=lambda k: (-counts[k], words[k]))
            rank[order] = range(len(words))
            near, best = np.bincount(np.concatenate((i, j)), minlength=len(words)), np.full(len(words), len(words))
            np.minimum.at(best, i, rank[j])
            np.minimum.at(best, j, rank[i])
            some = np.flatnonzero(near).tolist()
            first = [order[k] for k in best[some]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([words[k] for k in some], pa.string()), pa.array(near[some], pa.int64()), pa.array([words[k] for k in first], pa.string()), pa.array([counts[k] for k in first], pa.int64())],
                ["word", "near", "best", "best_n"],
            )


def near_words(words: DataFrame, block_rows: int = BLOCK) -> DataFrame:
    """(word, n_near, best, best_n) of the words of `words` (word, n) that have near words."""
    spark = words.sparkSession
    order = ("length", "groups", "word")
    placed = words.mapInArrow(_place, PLACED)
    ordered = placed.repartitionByRange(common.shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    blocks = common.checkpoint(ordered.mapInArrow(_cut(block_rows), BLOCKS))
    met = common.checkpoint(near_blocks(blocks))
    side = lambda s: blocks.select(F.col("block").alias(s), F.col("words").alias(f"{s}_words"), F.col("counts").alias(f"{s}_counts"))
    # a row stands for a product of two matrices: the number of tasks is given
    both = met.join(side("a"), "a").join(side("b"), "b").select((F.col("a") == F.col("b")).alias("own"), "a_words", "a_counts", "b_words", "b_counts", "a", "b")
    both = both.repartition(2 * common.shuffle_partitions(spark), "a", "b").drop("a", "b")
    found = both.mapInArrow(_compare, "word string, near long, best string, best_n long")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min_by(F.struct("best", "best_n"), F.struct(-F.col("best_n"), F.col("best"))).alias("x")).select("word", "n_near", "x.best", "x.best_n")


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root) of `forms` (word, form): forms followed to the last; each round doubles the steps."""
    roots = common.checkpoint(forms.select("word", F.col("form").alias("root")))
    while True:
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = common.checkpoint(roots.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if moved.filter("moved").isEmpty():
            return roots
        roots = moved.select("word", "root")


def spelling_variants(docs: DataFrame, block_rows: int = BLOCK) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the frequent words of `docs` (doc_id, text)."""
    common.ship(docs.sparkSession)
    with common.temporary_tables():
        words = common.keep(common.checkpoint(frequent_words(docs)))
        near = common.checkpoint(near_words(words, block_rows))
        has: Column = F.col("best_n") >= RATIO * F.col("n")
        state = common.keep(common.checkpoint(
            words.join(near, "word", "left")
            .select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n"))
        ))
        roots = common.keep(common.checkpoint(last_forms(state.filter("form is not null"))))
    return state.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
