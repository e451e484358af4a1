"""Quality rules: counted base rules and a calibrated n-gram classifier.

Features are hashed word 1- and 2-grams and character 2- and 4-grams of the whole
text, as shares of the text's n-grams; so a text's score is a mean of weights and is
summed in Arrow batches without a vector per document. The logistic regression is
fitted on a bounded sample of labelled rows (`MAX_TRAIN`, the rows with the lowest hash
of each class), calibrated by Platt scaling on rows held out from the fit, and
shifted to the class ratio of all labels. Verdicts use fixed thresholds.

Defined cases: a null or empty text has no words and fails the base rules; without
labels of both classes there is no model, the probability is null and the base rules
alone decide; labels that are null or repeat a document count once, the lower quality
first; of documents that repeat a sampled id one text is learned from; repeated rows are judged one by one; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framewright.llm import common

MIN_WORDS, MAX_REPEAT_PERCENT, KEEP_PROBABILITY = 20, 30, 0.5
MAX_TRAIN = 2000
BITS = 13  # of a feature block
WORD_GRAMS, CHAR_GRAMS = (1, 2), (2, 4)
WINDOW = 8
SPACES, SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
_B = np.uint64(0x9E3779B97F4A7C15)
_B_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_C = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F], dtype=np.uint64)
BATCH_CHARS = 200_000  # at some 100 bytes of memory each
RESULT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, probability double"


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _C[1]
    return h ^ (h >> np.uint64(32))


@dataclass
class TextBatch:
    """Some texts as one array of code points, each text followed by a line feed."""

    points: np.ndarray
    bounds: np.ndarray  # of the texts with their line feed
    words: np.ndarray  # hashes
    word_bounds: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> "TextBatch":
        points = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        bounds = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
        space = (points == 32) | ((points >= 9) & (points <= 13))
        edge = np.diff(space.astype(np.int8), prepend=1)
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        power = np.cumprod(np.full(len(points), _B))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((points.astype(np.uint64) + np.uint64(1)) * power)))
        inverse = np.cumprod(np.full(len(points), _B_INVERSE))
        return cls(points, bounds, _mix((total[ends] - total[starts]) * inverse[starts]), np.searchsorted(starts, bounds))

    def grams(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(block, buckets, first gram of each text, last + 1) of every n-gram kind."""
        for block, units, bounds, less, sizes in ((0, self.words, self.word_bounds, 0, WORD_GRAMS), (1, self.points.astype(np.uint64), self.bounds, 1, CHAR_GRAMS)):
            for n in sizes:
                count = max(0, len(units) - n + 1)
                h = np.full(count, np.uint64(n))
                for i in range(n):
                    h += units[i:i + count] * _C[i]
                buckets = (_mix(h) >> np.uint64(64 - BITS)).astype(np.int64)
                first = np.minimum(bounds[:-1], count)
                yield block, buckets, first, np.maximum(first, np.minimum(bounds[1:] - less - n + 1, count))

    def repeated_windows(self) -> list[bool]:
        """Whether a text may hold a window of words twice (equal windows have equal hashes)."""
        w, n = self.words, max(0, len(self.words) - WINDOW + 1)
        h = np.zeros(n, np.uint64)
        for i in range(WINDOW):
            h += w[i:i + n] * _C[i]
        out = []
        for a, b in zip(self.word_bounds[:-1], self.word_bounds[1:]):
            own = np.sort(h[a:max(a, b - WINDOW + 1)])
            out.append(bool((own[1:] == own[:-1]).any()))
        return out


def repeat_words(words: list[bytes]) -> int:
    """Words in windows of 8 that occur twice or more."""
    windows = list(zip(*(words[i:] for i in range(WINDOW))))
    count, covered, until = Counter(windows), 0, 0
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered += i + WINDOW - max(i, until)
            until = i + WINDOW
    return covered


def base_counts(text: str, may_repeat: bool) -> tuple[int, int, int, int, int]:
    words = text.encode("utf-8", "surrogatepass").split()
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            repeated += line in seen
            seen.add(line)
    return (
        len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), repeated,
        repeat_words(words) if may_repeat else 0,
    )


@dataclass
class QualityModel:
    """P(quality) = sigmoid(scale * score + shift); score: bias and mean weights of the n-grams of each kind."""

    weights: np.ndarray  # [kind of block, bucket]
    bias: float
    scale: float
    shift: float

    def probabilities(self, batch: TextBatch) -> np.ndarray:
        score = np.full(len(batch.bounds) - 1, self.bias)
        for block, buckets, first, last in batch.grams():
            # each text's own sum: its neighbours in the batch don't matter
            total = [float(self.weights[block][buckets[a:b]].sum()) for a, b in zip(first.tolist(), last.tolist())]
            score += np.array(total) / np.maximum(last - first, 1)
        return 1 / (1 + np.exp(-np.clip(self.scale * score + self.shift, -50, 50)))


def shares(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sparse feature vector: buckets of both blocks, and their shares (summed over the n-gram sizes of a block)."""
    vector = np.zeros(2 << BITS)
    for block, buckets, first, last in TextBatch.of([text]).grams():
        own = buckets[first[0]:last[0]]
        vector[block << BITS:(block + 1) << BITS] += np.bincount(own, minlength=1 << BITS) / max(1, len(own))
    index = np.flatnonzero(vector)
    return index, vector[index]


def train_sample(docs: DataFrame, labels: DataFrame, max_train: int) -> tuple[list, dict[int, int]]:
    """At most `max_train` rows (quality, buckets, shares), half of each class, and the number of labels of each class."""
    clean = labels.filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    counts = {r["quality"]: r["count"] for r in clean.groupBy("quality").count().collect()}
    one = lambda q: clean.filter(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train // 2)
    ids = F.broadcast(one(0).unionByName(one(1)))  # max_train rows
    # an id's rows are one row before anything leaves Spark: the text with the lowest hash
    texts = docs.select("doc_id", "text").join(ids, "doc_id").groupBy("doc_id", "quality").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    texts = texts.select("doc_id", "text", "quality")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [shares(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2).cast(pa.int32()), pa.array([g[0].astype("<i4").tobytes() for g in got], pa.binary()), pa.array([g[1].astype("<f4").tobytes() for g in got], pa.binary())],
                ["doc_id", "quality", "buckets", "shares"],
            )

    rows = texts.mapInArrow(run, "doc_id long, quality int, buckets binary, shares binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["shares"])))
    return [(r["quality"], np.frombuffer(r["buckets"], "<i4"), np.frombuffer(r["shares"], "<f4")) for r in rows], counts


def _dense(rows: list) -> np.ndarray:
    x = np.zeros((len(rows), 2 << BITS), dtype=np.float32)
    for i, (_, index, value) in enumerate(rows):
        x[i, index] = value
    return x


def fit(rows: list, counts: dict[int, int], steps: int = 300, ridge: float = 1e-3) -> QualityModel | None:
    """Accelerated gradient descent on every row but each fourth, Platt scaling on those."""
    y = np.array([r[0] for r in rows], dtype=np.float32)
    held = np.arange(len(rows)) % 4 == 3
    if len({*y[held]}) < 2 or len({*y[~held]}) < 2:
        return None
    a, of_held = (_dense([r for r, out in zip(rows, where) if out]) for where in (~held, held))  # the driver's largest arrays: no copies are made
    target = y[~held]
    size = 1 / np.sqrt(a.mean(0) + 1e-4)  # frequent n-grams don't drown the rest
    a *= size
    of_held *= size
    lipschitz = 0.25 * float(np.einsum("ij,ij->i", a, a).max()) + ridge
    w = v = np.zeros(a.shape[1], dtype=np.float32)
    b = c = 0.0
    for k in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ v + c, -50, 50)))
        g = (p - target) / len(target)
        w_next = v - (a.T @ g + ridge * v) / lipschitz
        b_next = c - float(g.sum()) / max(lipschitz, 0.25)
        m = k / (k + 3)
        v, c, w, b = w_next + m * (w_next - w), b_next + m * (b_next - b), w_next, b_next
    s, t = of_held @ w + b, y[held]
    # Platt: targets are smoothed, Newton steps on (scale, shift)
    up, down = float(t.sum()), float(len(t) - t.sum())
    smooth = np.where(t == 1, (up + 1) / (up + 2), 1 / (down + 2))
    scale, shift = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(scale * s + shift, -50, 50)))
        g, h = p - smooth, np.maximum(p * (1 - p), 1e-9)
        grad = np.array([g @ s + 1e-3 * scale, g.sum()])
        hess = np.array([[(h * s) @ s + 1e-3, h @ s], [h @ s, h.sum() + 1e-6]])
        step = np.linalg.solve(hess, grad)
        step *= min(1.0, 2.0 / max(1e-9, float(np.abs(step).max())))
        scale, shift = scale - float(step[0]), shift - float(step[1])
    # from the sample's class ratio to that of all labels
    shift += float(np.log(counts[1] / counts[0]) - np.log(y.sum() / (len(y) - y.sum())))
    return QualityModel((w * size).reshape(2, -1).astype(np.float64), b, scale, shift)


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> QualityModel | None:
    common.ship(docs.sparkSession)
    return fit(*train_sample(docs, labels, max_train))


def judge_documents(docs: DataFrame, model: QualityModel | None, keep_probability: float = KEEP_PROBABILITY, carry: tuple[str, ...] = ()) -> DataFrame:
    """Counts, base rules, probability and verdict of every row of `docs` (doc_id, text); the columns to be carried pass through."""
    spark = docs.sparkSession
    common.ship(spark)
    sent = spark.sparkContext.broadcast(model)  # a fixed number of weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        names = [*(x.split()[0] for x in RESULT.split(", ")), *carry]
        types = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.float64()]

        def judged(keys: list, texts: list[str], carried: list[pa.RecordBatch]) -> pa.RecordBatch:
            batch = TextBatch.of(texts)
            p = model.probabilities(batch).tolist() if model else [None] * len(texts)
            rows = []
            for key, text, may_repeat, chance in zip(keys, texts, batch.repeated_windows(), p):
                counted = base_counts(text, may_repeat)
                failed = counted[0] < MIN_WORDS or 100 * counted[4] > MAX_REPEAT_PERCENT * counted[0]
                rows.append((key, *counted, failed, not failed and (chance is None or chance >= keep_probability), chance))
            more = pa.Table.from_batches(carried).combine_chunks().columns if carry else []
            return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(zip(*rows), types)), *(c.combine_chunks() for c in more)], names)

        keys, texts, carried, size = [], [], [], 0
        for batch in batches:
            first = 0
            for i, (key, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1))):
                keys.append(key)
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= BATCH_CHARS:
                    carried.append(batch.select(list(carry)).slice(first, i + 1 - first))
                    yield judged(keys, texts, carried)
                    keys, texts, carried, size, first = [], [], [], 0, i + 1
            if first < batch.num_rows:
                carried.append(batch.select(list(carry)).slice(first))
        if keys:
            yield judged(keys, texts, carried)

    rows = docs.select("doc_id", "text", *[F.col(c) for c in carry if c not in ("doc_id", "text")])
    schema = RESULT + "".join(f", {c} {dict(rows.dtypes)[c]}" for c in carry)
    return rows.mapInArrow(run, schema)
