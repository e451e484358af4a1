"""MinHash near-duplicates: one-permutation hashing, optimal densification, bands, star edges.

One hash per shingle fills the bins of a signature; an empty bin borrows from the
bin that a fixed hash of (bin, attempt) names first that isn't empty. Bands of
bins are buckets. Documents with equal shingle sets are one class from the start.

Candidates are stars: first each bucket's members with its smallest member; then, once
the links found so far have made components, each member outside its bucket's largest
component with the members it isn't connected to, where these pairs are no more than the bucket's members have shingles.
In other buckets (a template gives many documents a similarity below the threshold) that would grow with the square of the bucket, and
members meet only where they share one of their rarest shingles: two sets that are similar enough share one of the first few in any order, and
in the order of frequency among these members (shingles of one component first) those are not the template's.
So no link between components is missed, and a group of copies or of a template's documents costs pairs in proportion to its shingles.
A pair becomes a candidate only if its set sizes and
parity bitmaps allow the similarity: a bitmap holds the parity of the number of shingles in each of 512
bins, and two bitmaps differ in no more bits than the sets differ in shingles, so this drops no link.
Every link is confirmed on the full shingle sets, whose shingles are 64-bit hashes of five hashed words (two shingles of a pair of documents with
10^5 shingles each are taken for one with probability 5e-10; classes of equal sets go by 128 bits).

With 42 bands of 6 bins a pair at similarity 0.85 shares no bucket with probability 2e-9, one at 0.80 with 3e-6.

Defined cases: a null text or one without words has an empty set and links with nothing; rows with
a null id are in no link of their own (component null, kept); rows that share an id
count as one document; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framewright.llm import common, graph

SHINGLE, BINS, BANDS, ROWS = 5, 256, 42, 6
PARITY_WORDS = 8  # of 64 bins
BATCH_BYTES = 400_000  # at some 60 bytes of memory each
LONG_WORD = 256  # bytes
_B = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], dtype=np.uint64)
PARITY = [f"p{i}" for i in range(PARITY_WORDS)]
SIGNATURE = "doc_id long, n_shingles long, class binary, bands array<long>, " + ", ".join(f"{p} long" for p in PARITY)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _ODD[0]
    h = (h ^ (h >> np.uint64(27))) * _ODD[1]
    return h ^ (h >> np.uint64(31))


def _scalar(n: int) -> np.uint64:
    return np.uint64(n & 0xFFFFFFFFFFFFFFFF)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each word: eight bytes after eight are taken in and mixed, long words by a digest of the standard library."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    left = ends - starts
    out = _mix(left.astype(np.uint64) * _B + _ODD[5])
    at, active = starts.copy(), np.flatnonzero(left <= LONG_WORD)
    while len(active):
        lane = np.zeros(len(active), np.uint64)
        for k in range(8):
            byte = np.where(left[active] > k, padded[at[active] + k], 0)
            lane |= byte.astype(np.uint64) << np.uint64(8 * k)
        out[active] = _mix((out[active] ^ lane) * _ODD[1] + _ODD[4])
        at[active] += 8
        left[active] -= 8
        active = active[left[active] > 0]
    for i in np.flatnonzero(ends - starts > LONG_WORD).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8).digest(), "little")
    return out


def shingle_sets(texts: list[bytes], width: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text (lower-cased A-Z, words between ASCII white space)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    data = np.where((data >= 65) & (data <= 90), data + 32, data)
    bounds = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(space.astype(np.int8), prepend=1)
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    words = word_hashes(data, starts, ends)
    at = np.searchsorted(starts, bounds)
    n = max(0, len(words) - width + 1)
    grams = np.full(n, np.uint64(width))
    for i in range(width):
        grams += _mix(words[i:i + n] + _ODD[2]) * _scalar(int(_ODD[3]) * (2 * i + 1) + 2 * i)
    grams = _mix(grams)
    out = []
    for a, b in zip(at[:-1], at[1:]):
        if b - a >= width:
            out.append(np.unique(grams[a:b - width + 1]))
        elif b > a:  # too short: all its words are one shingle
            whole = np.full(1, b - a, np.uint64)
            for w in words[a:b]:
                whole = _mix(whole * _ODD[4] + w)
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of BINS values per non-empty set."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    sig = np.full((len(sets), BINS), empty)
    shift = np.uint64(64 - BINS.bit_length() + 1)
    for row, s in zip(sig, sets):
        bins = (s >> shift).astype(np.int64)
        first = np.flatnonzero(np.diff(bins, prepend=-1))  # sorted: the first of a bin is its least
        row[bins[first]] = s[first]
    full = sig != empty
    r, c = np.nonzero(~full)
    attempt = 0
    while len(r):
        source = (_mix(c.astype(np.uint64) * _ODD[5] + _scalar(int(_ODD[3]) * attempt + 1)) >> shift).astype(np.int64)
        hit = full[r, source]
        sig[r[hit], c[hit]] = sig[r[hit], source[hit]]
        r, c, attempt = r[~hit], c[~hit], attempt + 1
    return sig


def band_hashes(sig: np.ndarray) -> np.ndarray:
    out = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64) * _ODD[2], (len(sig), 1))
    for i in range(ROWS):
        out = _mix(out * _ODD[4] + sig[:, i:BANDS * ROWS:ROWS])
    return out.view(np.int64)


def parities(s: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles in each of the bins, as PARITY_WORDS integers."""
    bins = np.bincount(((s >> np.uint64(20)) % np.uint64(64 * PARITY_WORDS)).astype(np.int64), minlength=64 * PARITY_WORDS)
    return np.packbits((bins & 1).astype(np.uint8)).view("<i8")


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    keys, texts, size = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
            keys.append(key)
            texts.append(text.as_py() or b"")
            size += len(texts[-1])
            if size >= BATCH_BYTES:
                yield keys, texts
                keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for keys, texts in _text_batches(batches):
        sets = shingle_sets(texts)
        some = [i for i, s in enumerate(sets) if len(s)]
        bands = dict(zip(some, band_hashes(signatures([sets[i] for i in some])))) if some else {}
        parity = np.array([parities(s) for s in sets])
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()), pa.array([bands.get(i) for i in range(len(sets))], pa.list_(pa.int64())), *map(pa.array, parity.T)],
            ["doc_id", "n_shingles", "class", "bands", *PARITY],
        )


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for keys, texts in _text_batches(batches):
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([s.tobytes() for s in shingle_sets(texts)], pa.binary())], ["node", "shingles"])


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                least, most = sorted((len(p), len(q)))
                if 100 * least < percent * most:
                    linked.append(False)
                    continue
                both = np.sort(np.concatenate((p, q)), kind="stable")
                same = int((both[1:] == both[:-1]).sum())
                linked.append(100 * same >= percent * (len(p) + len(q) - same))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    return run


def confirm_links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, linked) of the pairs; joined on one side after the other, so a frequent centre's side may be split. Without pairs no set is read."""
    pairs = common.checkpoint(pairs)
    if pairs.isEmpty():
        return pairs.withColumn("linked", F.lit(True))
    x = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    y = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    both = pairs.join(x, "b").join(y, "a").select("a", "b", "of_a", "of_b")
    return common.checkpoint(both.mapInArrow(_confirm(percent), "a long, b long, linked boolean"))


def may_link(x: str, y: str, percent: int) -> Column:
    """Whether sizes and parities of the aliased rows allow the similarity: at most (1 - t) / (1 + t) of both sizes may differ."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    differ = F.lit(0)
    for p in PARITY:
        differ = differ + F.bit_count(F.col(f"{x}.{p}").bitwiseXOR(F.col(f"{y}.{p}")))
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * differ <= (100 - percent) * (n + m))


def _pairs(x: str, y: str, rows: DataFrame) -> DataFrame:
    a, b = F.col(f"{x}.node"), F.col(f"{y}.node")
    return rows.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def star_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that make the components, from buckets (bucket, node, n, parities)."""
    facts = ["node", "n", *PARITY]
    centre = members.groupBy("bucket").agg(F.min_by(F.struct(*facts), "node").alias("c")).select("bucket", "c.*")
    x, y = members.alias("x"), centre.alias("y")
    stars = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.node") != F.col("y.node")) & may_link("x", "y", percent))
    first = confirm_links(_pairs("x", "y", stars), sets, percent).filter("linked").select("a", "b")
    roots = graph.contract(first)
    if roots is None:
        known = members.withColumn("comp", F.col("node"))
    else:
        known = members.join(roots, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")
    known = common.checkpoint(known)
    inside = known.groupBy("bucket", "comp").agg(F.count("*").alias("size"), F.sum("n").alias("shingles"))
    largest = inside.groupBy("bucket").agg(F.max_by("comp", F.struct("size", "comp")).alias("largest"), F.count("*").alias("comps"), (F.sum("size") - F.max("size")).alias("outside"), F.sum("size").alias("members"), F.sum("shingles").alias("shingles"))
    cheap = F.col("outside") * F.col("members") <= F.col("shingles")
    open_ = common.checkpoint(known.join(largest.filter("comps > 1").withColumn("cheap", cheap).drop("comps", "outside", "members", "shingles"), "bucket"))
    second = confirm_links(outside_pairs(open_.filter("cheap"), percent), sets, percent).filter("linked").select("a", "b")
    third = confirm_links(rare_pairs(open_.filter("not cheap"), sets, percent), sets, percent).filter("linked").select("a", "b")
    return first.union(second).union(third)


def outside_pairs(open_: DataFrame, percent: int) -> DataFrame:
    """In each bucket: the members outside the largest component with all members of other components."""
    x, y = open_.filter("comp <> largest").alias("x"), open_.alias("y")
    return _pairs("x", "y", x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.comp") != F.col("y.comp")) & may_link("x", "y", percent)))


def _explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for node, comp, raw in zip(*batch.columns):
            own = np.frombuffer(raw.as_buffer(), "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), node.as_py())), pa.array(np.full(len(own), comp.as_py())), pa.array(own)], ["node", "comp", "token"])


def rare_pairs(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """In buckets with many pairs: members that share one of their rarest shingles.

    Of sets of n >= m shingles and the similarity t, one of the first n - t n + 1 of the larger is one of the first
    m - 2 t m / (1 + t) + 1 of the smaller, in any order of all shingles. Here those of one component, which give no pair, come first;
    then the others by frequency. So a set's places behind the first kind follow from its size, and only rows of the second are joined.
    """
    members = common.checkpoint(open_.select("node", "n", "comp", *PARITY).distinct())
    if members.isEmpty():
        return members.selectExpr("node as a", "node as b")
    tokens = sets.join(members.select("node", "comp"), "node").select("node", "comp", "shingles").mapInArrow(_explode, "node long, comp long, token long")
    often = tokens.groupBy("token").agg(F.count("*").alias("often"), F.min("comp").alias("low"), F.max("comp").alias("high"))
    often = common.checkpoint(often.filter("low <> high").select("token", "often"))
    of_node = Window.partitionBy("node")
    ranked = tokens.select("node", "token").join(often, "token").select(
        "node", "token", F.row_number().over(of_node.orderBy("often", "token")).alias("rank"), F.count("*").over(of_node).alias("ranks")
    )
    n, place = F.col("n"), F.col("place")
    ranked = ranked.join(members, "node").withColumn("place", n - F.col("ranks") + F.col("rank") - 1).drop("rank", "ranks")
    first = common.checkpoint(ranked.filter(place < n - F.ceil(percent * n / 100) + 1))
    x, y = first.alias("x"), first.filter(place < n - F.ceil(2 * percent * n / (100 + percent)) + 1).alias("y")
    larger = F.struct("x.n", "x.node") > F.struct("y.n", "y.node")
    return _pairs("x", "y", x.join(y, (F.col("x.token") == F.col("y.token")) & larger & (F.col("x.comp") != F.col("y.comp")) & may_link("x", "y", percent)))


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of `docs` (doc_id, text)."""
    common.ship(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    with common.temporary_tables():
        signed = common.keep(common.checkpoint(docs.mapInArrow(_sign, SIGNATURE)))
        # equal sets are one class; its node is its smallest id
        facts = [F.first("bands").alias("bands"), F.first("n_shingles").alias("n"), *[F.first(p).alias(p) for p in PARITY]]
        classes = common.checkpoint(signed.filter("doc_id is not null and n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("node"), *facts).drop("class"))
        bands = classes.select("node", F.explode("bands").alias("bucket"))
        shared = bands.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter("low <> high").select("bucket")
        members = common.checkpoint(bands.join(shared, "bucket").join(classes.drop("bands"), "node"))
        nodes = members.select(F.col("node").alias("doc_id")).distinct().hint("merge")  # grows with the documents: never broadcast
        sets = common.checkpoint(docs.join(nodes, "doc_id", "left_semi").mapInArrow(_gather, "node long, shingles binary").dropDuplicates(["node"]))
        joined = graph.components(star_links(members, sets, percent))
        if joined is not None:
            common.keep(joined)
    of_class = signed.filter("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("node"))
    if joined is None:
        of_class = of_class.withColumn("component", F.col("node"))
    else:
        of_class = of_class.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    # written first, so that a class with a third of all rows may be split in the join
    of_class = common.checkpoint(of_class.select("class", "component"))
    out = signed.select("doc_id", "n_shingles", "class").join(of_class, "class", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("doc_id").isNull()))
