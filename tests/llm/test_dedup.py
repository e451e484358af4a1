"""Near-duplicates, repeated passages, links and components."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from framewright.llm import embed, graph, minhash, suffix


def union_find(links, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = union_find(links, {x for p in links for x in p if p[0] != p[1]})
    assert got == {n: want[n] for n in got} and set(got) == set(want)
    assert graph.components(spark.createDataFrame([(1, 1)], "a long, b long")) is None


def shingles(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(words)} if 0 < len(words) < 5 else {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def near_copies(seed, families=12):
    rng, rows = random.Random(seed), []
    for f in range(families):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([6, 30, 120]))]
        for k in range(rng.randint(1, 9)):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            rows.append((f * 100 + k, " ".join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_as_brute_force(docs, edges, seed):
    rows = near_copies(seed) + edges[2:]
    sets = [(i, shingles(t)) for i, t in rows]
    links = [(a, b) for x, (a, s) in enumerate(sets) for b, t in sets[x + 1:] if s and t and 100 * len(s & t) >= 85 * len(s | t)]
    want = union_find(links, {i for i, _ in rows})
    got = minhash.near_duplicates(docs(rows)).collect()
    assert sorted(map(tuple, got)) == sorted((i, len(s), want[i], want[i] == i) for i, s in sets)


def test_pipeline_stage_links_from_080_as_brute_force(spark):
    rng, rows = random.Random(3), []
    for f in range(30):
        base = [f"w{rng.randrange(10**6)}" for _ in range(100)]
        copy = list(base)
        for at in rng.sample((10, 25, 40, 55, 70, 85), 1 + f % 3):  # similarity 0.90, 0.81 and 0.73
            copy[at] = f"x{rng.randrange(10**6)}"
        rows += [(2 * f, " ".join(base)), (2 * f + 1, " ".join(copy))]
    sets = [(i, shingles(t)) for i, t in rows]
    alike = {(a, b): len(s & t) / len(s | t) for x, (a, s) in enumerate(sets) for b, t in sets[x + 1:]}
    assert sum(0.8 <= v < 0.85 for v in alike.values()) == 10
    want = union_find([p for p, v in alike.items() if v >= 0.8], {i for i, _ in rows})
    table = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = [r["doc_id"] for r in corpus_pipeline.near_dedup(spark, table, "").collect()]
    assert sorted(got) == [i for i, _ in rows if want[i] == i]


def test_near_duplicates_without_links_or_rows(docs):
    assert minhash.near_duplicates(docs([])).count() == 0
    got = {r["doc_id"]: r for r in minhash.near_duplicates(docs([(1, "a b c d e f"), (2, None), (None, "q r s t u v")])).collect()}
    assert got[1]["component_id"] == 1 and got[2]["kept"] and got[None]["component_id"] is None and got[None]["kept"]


def passages(rows):
    least = {}
    for i, t in rows:
        raw = (t or "").encode()
        for k in range(len(raw) - 49):
            w = raw[k:k + 50]
            least[w] = min(least.get(w, 1 << 63), 1 << 63 if i is None else i)
    for i, t in rows:
        raw, own = (t or "").encode(), 1 << 63 if i is None else i
        hit = bytearray(len(raw))
        for k in range(len(raw) - 49):
            if least[raw[k:k + 50]] < own:
                hit[k:k + 50] = b"\1" * 50
        kept = bytes(c for c, h in zip(raw, hit) if not h)
        yield i, len(raw), sum(hit), sum(1 for x in range(len(hit)) if hit[x] and (x == 0 or not hit[x - 1])), hashlib.sha256(kept).hexdigest()


def test_repeats_as_brute_force(docs, sample):
    rng = random.Random(5)
    parts = ["".join(rng.choice("ab é") for _ in range(rng.randint(45, 120))) for _ in range(6)]
    rows = sample[:80] + [(1000 + i, "".join(rng.choice(parts) + rng.choice(["", "x", "ab"]) for _ in range(rng.randint(0, 6)))) for i in range(80)]
    rows += [(None, parts[0]), (None, None), (5000, None), (5001, ""), (1003, parts[1] * 3), (2, "a" * 300), (1, "a" * 200), (7000, sample[3][1]), (7001, "b" * 49), (7002, "b" * 50), (7003, "b" * 50)]
    got = sorted(map(tuple, suffix.remove_repeats(docs(rows)).collect()), key=str)
    assert got == sorted(passages(rows), key=str)
    assert suffix.remove_repeats(docs([])).count() == 0


@pytest.mark.parametrize("bits", [6, 10, 24])
def test_anchors_of_slices_as_brute_force(monkeypatch, bits):
    monkeypatch.setattr(suffix, "POSITION_BITS", bits)
    texts = [np.random.default_rng(k).integers(97, 123, n).astype(np.uint8).tobytes() for k, n in enumerate((3000, 49, 50, 0, 700))]
    block = suffix.Block(texts, [[k] for k in range(len(texts))])
    runs, gram = suffix.Runs(block.data, block.bounds), lambda at: int(runs.hashes.of(np.array([at]), suffix.GRAM)[0])
    got = {s + i: (a, t) for s, c, a, t in zip(runs.start, runs.count, runs.anchor, runs.text) for i in range(c)}
    want = {}
    for t, raw in enumerate(texts):
        first = int(block.bounds[t])
        hashes = [gram(first + i) for i in range(max(0, len(raw) - suffix.GRAM + 1))]
        for i in range(len(raw) - suffix.WIDTH + 1):
            want[first + i] = (first + min(range(i, i + suffix.REACH), key=hashes.__getitem__), t)
    assert got == want and [gram(a) for a in runs.anchor] == runs.key.tolist()


def test_repeats_behind_16_mib_of_a_text(docs):
    rng = np.random.default_rng(8)
    long = rng.integers(97, 123, 17_000_000).astype(np.uint8).tobytes().decode()
    passage = long[16_900_000:16_900_400]
    rows = [(1, "A" + passage + "B"), (2, long), (3, "C" + long[16_777_100:16_777_400] + "D")]
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix.remove_repeats(docs(rows)).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {1: (0, 0, sha(rows[0][1])), 2: (400, 1, sha(long[:16_900_000] + long[16_900_400:])), 3: (300, 1, sha("CD"))}


def test_suffix_merge_sort():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    at = rng.integers(0, 2900, 400)
    segment = np.sort(rng.integers(0, 9, 400))
    order = suffix.merge_sort(suffix.PrefixHashes(data), at, segment, 50)
    assert (segment[order] == segment).all()
    cut = [(s, data[a:a + 50].tobytes()) for s, a in zip(segment, at[order])]
    assert cut == sorted(cut) and sorted(order) == list(range(400))


def test_byte_comparison_in_portions():
    data = np.tile(np.arange(97, 107, dtype=np.uint8), 100)
    a = np.arange(45_000) % 500
    equal = suffix.same_bytes(data, a, a + 10 + (np.arange(45_000) % 7 == 0), np.full(45_000, 50))
    assert (equal == (np.arange(45_000) % 7 != 0)).all()


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)


def test_vectors_as_brute_force(spark):
    rng, rows = np.random.default_rng(4), []
    for label in (0, 1):
        centres = rng.normal(size=(20, 16))
        for k in range(150):
            rows.append((len(rows), [float(x) for x in (centres[k % 20] + 0.05 * rng.normal(size=16)).astype("f4")], label))
    rows += [(len(rows) + i, rows[5][1], rows[5][2]) for i in range(30)]
    usable = list(rows)
    odd = [(9000, None, 0), (9001, [0.0] * 16, 0), (9002, [float("nan")] * 16, 0), (9003, [None] * 16, 0), (9004, rows[0][1], None), (9005, [float("inf")] * 16, 1)]
    x = np.array([r[1] for r in usable], dtype=np.float64)
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    label = np.array([r[2] for r in usable])
    near = (x @ x.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    want = union_find(zip(*np.nonzero(near)), range(len(usable)))
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embed.near_vectors(vectors(spark, rows + odd), block_rows=32).collect()}
    assert got == {**{i: (int(near[i].sum()), want[i], want[i] == i) for i in range(len(usable))}, **{r[0]: (0, r[0], True) for r in odd}}
    assert embed.near_vectors(vectors(spark, [])).count() == 0


def test_hot_anchors_and_small_blocks_as_brute_force(docs, sample):
    rng = random.Random(9)
    parts = ["".join(rng.choice("abc é") for _ in range(rng.randint(60, 200))) for _ in range(3)]
    rows = sample[:40] + [(1000 + i, rng.choice(["", "x", "yy"]) + rng.choice(parts) + f"{i:09}" * rng.randint(0, 9) + rng.choice(parts)) for i in range(120)]
    want = sorted(passages(rows), key=str)
    for hot in (1, 3):
        got = suffix.remove_repeats(docs(rows), carry=("kept",), block_bytes=2_000, bucket_bytes=20_000, hot_blocks=hot).collect()
        assert sorted((tuple(r)[:5] for r in got), key=str) == want and {r["kept"] for r in got} == {"a"}
        assert all(hashlib.sha256(r["kept_text"].encode()).hexdigest() == r["kept_sha256"] for r in got if r["n_removed"] == 0)


def test_vectors_of_several_lengths_and_odd_ids(spark, monkeypatch):
    monkeypatch.setattr(embed, "MOMENT", 6)  # in the driver: axes of the first components only
    monkeypatch.setattr(embed, "MOST_LENGTHS", 1)
    rng, rows = np.random.default_rng(6), []
    for size in (8, 3, 1):
        centres = rng.normal(size=(3, size))
        rows += [(len(rows) + k, [float(x) for x in centres[k % 3] + 0.02 * rng.normal(size=size)], 0) for k in range(60)]
    x = [np.array(r[1]) / np.linalg.norm(r[1]) for r in rows]
    near = {(a, b) for a in range(len(x)) for b in range(len(x)) if a != b and len(x[a]) == len(x[b]) and x[a] @ x[b] >= 0.98}
    want = union_find(near, range(len(x)))
    odd = [(rows[0][0], rows[0][1], 0), (None, rows[0][1], 0), (900, [], 0), (901, [1.0, None], 0)]
    wide = [(*r, "a", 1, 2, 3) for r in rows + odd]
    table = spark.createDataFrame(wide, "vec_id long, embedding array<double>, label int, node string, block int, cell int, size int").repartition(3)
    got = sorted(map(tuple, embed.near_vectors(table, block_rows=16).collect()), key=str)
    links = [sum(a == i for a, _ in near) for i in range(len(x))]
    expected = [(i, links[i], want[i], want[i] == i) for i in [*range(len(x)), 0]] + [(i, 0, i, True) for i in (None, 900, 901)]
    assert got == sorted(expected, key=str)


def test_share_of_vectors_compared():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(300, 64))
    for x, most in ((rng.normal(size=(5000, 64)), 0.6), (centres[np.arange(6000) % 300] + 0.05 * rng.normal(size=(6000, 64)), 0.1)):
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        axes = np.linalg.eigh(x.T @ x)[1][:, ::-1][:, :embed.BOX_AXES]
        width = 0.2 / embed.CELLS
        x = x[np.lexsort(np.floor(x @ axes[:, :embed.SORT_AXES] / width).T[::-1])]
        found = embed.IntervalJoin(x, None, axes, 0.98, 0.2)
        near = np.triu(x @ x.T >= 0.98, 1)
        share = found.compared / (len(x) ** 2 / 2)
        print(f"compared: {share:.3f} of the pairs")
        assert set(zip(*(np.concatenate(p).tolist() for p in zip(*found.pairs)))) == set(zip(*(i.tolist() for i in np.nonzero(near)))) and share < most


@pytest.mark.parametrize("apart, linked", [(3, 0), (2, 1)])
def test_template_family_costs_few_pairs(spark, docs, monkeypatch, apart, linked):
    """Documents of one template at a similarity below the threshold: buckets are shared, links are few, pairs are linear in number."""
    rng, rows = random.Random(11), []
    base = [f"w{rng.randrange(10**6)}" for _ in range(104)]
    for k in range(1200):
        words = list(base)
        for at in range(7, 7 + 15 * apart, 15):
            words[at] = f"x{k}_{at}"
        rows.append((k, " ".join(words)))
    for k in range(0, 1200, 100):  # a near copy of some
        rows.append((5000 + k, rows[k][1].rsplit(" ", linked)[0]))
    seen, plain = [], minhash.confirm_links

    def counted(pairs, sets, percent):
        seen.append(pairs.count())
        return plain(pairs, sets, percent)

    monkeypatch.setattr(minhash, "confirm_links", counted)
    monkeypatch.setattr(minhash, "may_link", lambda x, y, percent: F.lit(True))  # count what meets, not what sizes and parities leave
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs(rows), percent=90).collect()}
    assert got == {i: i - 5000 if i >= 5000 else i for i, _ in rows}
    print("pairs", seen)
    assert sum(seen) < minhash.BANDS * len(rows) and sum(seen[1:]) < len(rows)  # all pairs: 720,000


def test_copies_and_outsiders_of_one_bucket_cost_linear_pairs(spark, docs, monkeypatch):
    """5,000 near copies and 900 documents of their template at a similarity of 0.69 to them, one in ten of which has a near copy."""
    rng, rows = random.Random(12), []
    base = [f"w{rng.randrange(10**6)}" for _ in range(104)]
    for k in range(5000):
        rows.append((k, " ".join(base[:-1] + [f"y{k}"])))
    for k in range(900):
        words = list(base)
        for at in range(7, 7 + 15 * 4, 15):
            words[at] = f"x{k}_{at}"
        rows.append((10000 + k, " ".join(words)))
        if k % 10 == 0:
            rows.append((20000 + k, " ".join(words[:-1])))
    seen, plain = [], minhash.confirm_links

    def counted(pairs, sets, percent):
        seen.append(pairs.count())
        return plain(pairs, sets, percent)

    monkeypatch.setattr(minhash, "confirm_links", counted)
    monkeypatch.setattr(minhash, "may_link", lambda x, y, percent: F.lit(True))
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs(rows), percent=90).collect()}
    assert got == {i: 0 if i < 5000 else i - 10000 if i >= 20000 else i for i, _ in rows}
    print("pairs", seen)
    assert sum(seen[1:]) < 100 * len(rows)  # no more than shingles; all pairs: 4,500,000


def test_rare_pairs_find_all_similar_sets(spark):
    """Every pair of different components at the threshold or above, against all pairs."""
    rng, sets = random.Random(13), {}
    for k in range(300):
        family = random.Random(k % 5)
        core = [family.randrange(1 << 40) for _ in range(rng.choice([3, 10, 40]))]
        sets[k] = set(core) | {rng.randrange(1 << 40) for _ in range(rng.randrange(6))}
        if k > 5 and rng.random() < 0.3:
            sets[k] = set(rng.sample(sorted(sets[k - 5]), max(1, len(sets[k - 5]) - rng.randrange(3))))
    comp = {k: k - k % 7 for k in sets}
    facts = ", ".join(f"{p} long" for p in minhash.PARITY)
    rows = [(k, len(s), comp[k], *minhash.parities(np.array(sorted(s), np.uint64)).tolist()) for k, s in sets.items()]
    open_ = spark.createDataFrame(rows, f"node long, n long, comp long, {facts}")
    held = spark.createDataFrame([(k, np.array(sorted(s), np.uint64).tobytes()) for k, s in sets.items()], "node long, shingles binary")
    for percent in (80, 85, 100):
        got = {(r["a"], r["b"]) for r in minhash.rare_pairs(open_, held, percent).collect()}
        want = {(a, b) for a in sets for b in sets if a < b and comp[a] != comp[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}
        assert want and want <= got
    assert minhash.rare_pairs(open_.limit(0), held, 85).count() == 0


def test_common_phrase_in_different_contexts_is_dealt_out(docs, monkeypatch, tmp_path):
    """3,000 texts share 22 bytes and, but for a few, nothing else: no task gets the runs of all."""
    rng = random.Random(14)
    piece = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    phrase, some = piece(22), [piece(30) for _ in range(5)]
    rows = [(k, piece(40) + phrase + piece(40)) for k in range(3000)]
    rows += [(4000 + k, piece(9) + rng.choice(some) + phrase + rng.choice(some) + piece(9)) for k in range(60)]
    rows += [(5000 + k, piece(9) + rows[7 * k][1][k:k + 55] + piece(9)) for k in range(40)]
    plain, folder = suffix._sort_runs, str(tmp_path)

    def spied(buckets):
        sort = plain(buckets)

        def run(rows):
            bucket, part = rows.column("bucket")[0].as_py(), rows.column("part")[0].as_py()
            if bucket >= buckets:
                with open(f"{folder}/{min(part, 1)}-{bucket}-{part}", "w") as out:
                    out.write(str(sum(len(p) for p in rows.column("payload").to_pylist())))
            return sort(rows)

        return run

    monkeypatch.setattr(suffix, "_sort_runs", spied)
    got = sorted(map(tuple, suffix.remove_repeats(docs(rows), block_bytes=20_000, bucket_bytes=20_000, hot_blocks=2).collect()))
    assert got == sorted(passages(rows))
    sizes = [[int(f.read_text()) for f in tmp_path.glob(f"{k}-*")] for k in (1, 0)]
    print("bytes of parts, bytes of contexts", sum(sizes[0]), len(sizes[0]), sum(sizes[1]), max(sizes[1]), len(sizes[1]))
    assert sum(sizes[0]) > 10_000 and max(sizes[1]) < 0.2 * sum(sizes[1])
