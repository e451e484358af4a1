"""Operators on token ids: BPE, record files, packing."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from framewright.llm import bpe, common, packing, records, tokens
from framewright.llm.tokens import TokenIds, token_ids

ALPHABET = list(" \n\t  aàZ9é'sß,.!\x1c\x1f\x85ª²中 ЖĀſ　🙂_-Ⅷ٣") + ["<|endoftext|>", " the", "'re", "\r\n", "  ", " <|", "|>"]


@pytest.fixture(scope="module")
def library(vocabulary):
    t = Tokenizer.from_file(vocabulary)
    t.no_truncation()
    t.no_padding()
    return t


def expected(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(ALPHABET), max_size=14).map("".join))
def test_ids_and_decoding_as_the_library(text):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    own, fast = bpe.encoder(path), token_ids(path)
    library = fast.tokenizer
    ids = library.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == ids
    assert np.frombuffer(fast(text), "<u4").tolist() == ids
    assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_new_pieces_of_a_text_go_to_the_model_together(library, vocabulary, sample):
    encode, alone = TokenIds(vocabulary), []
    tokenize, encode.tokenize = encode.tokenize, lambda piece: alone.append(piece) or tokenize(piece)
    texts = [t for _, t in sample[:80] if t] + [" ".join(f"Wörd{i}y's {i},\n  x-{i}" for i in range(500)), "'s it's 're\n\n  \n", "  " * 50 + "'"]
    for text in texts + texts:
        assert np.frombuffer(encode(text), "<u4").tolist() == expected(library, text)
    assert not alone


def test_pieces_alone_where_joined_ones_could_differ(library, vocabulary, sample):
    encode = TokenIds(vocabulary)
    encode.end = None  # as for a vocabulary whose tokens hold the separator
    for _, text in sample[:20]:
        assert np.frombuffer(encode(text), "<u4").tolist() == expected(library, text)


def test_pieces_that_are_not_remembered(library, vocabulary, sample, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_PIECES", 3)
    encode = TokenIds(vocabulary)
    for _, text in sample[:20] * 2:
        assert np.frombuffer(encode(text), "<u4").tolist() == expected(library, text)
    assert len(encode.pieces) == 3 and not encode.pieces.missed


def test_decoding_of_broken_bytes(library, vocabulary):
    own, rng = bpe.encoder(vocabulary), random.Random(3)
    for _ in range(2000):
        ids = [rng.randrange(50257) for _ in range(rng.randint(0, 6))]
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_round_trip(docs, library, vocabulary, sample, edges):
    rows = sample[:60] + edges
    got = sorted(map(tuple, bpe.round_trip(docs(rows), vocabulary).collect()), key=str)
    want = []
    for i, t in rows:
        ids = expected(library, t)
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe.round_trip(docs([]), vocabulary).count() == 0


def test_frames_detect_damage():
    record = records.frame(b"payload")
    assert records.unframe(record) == b"payload"
    for i in range(len(record)):
        broken = record[:i] + bytes([record[i] ^ 1]) + record[i + 1:]
        with pytest.raises(ValueError):
            records.unframe(broken)
    for wide in (5, 70_000):
        ids = np.array([1, wide], "<u4").tobytes()
        assert records.split_payload(records.payload_of(7, ids)) == (7, ids)
        assert records.split_payload(records.payload_of(None, ids)) == (None, ids)


def test_records(spark, docs, library, vocabulary, sample, edges):
    rows = sample[:60] + edges
    folder = common.shared_dir(spark)
    records.write_records(docs(rows), folder, vocabulary)
    got = sorted(map(tuple, records.with_starts(records.read_records(spark, folder)).collect()), key=lambda r: r[1])
    ids = [[*expected(library, t), 0] for _, t in rows]
    assert sorted((r[0], r[2], r[3]) for r in got if r[0] is not None) == sorted((k, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for (k, _), x in zip(rows, ids) if k is not None)
    at = 0
    for key, start, n, _ in got:
        assert start == at
        at += n
    keys = [r[0] for r in got]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))


def test_records_of_an_empty_table(spark, docs, vocabulary):
    folder = common.shared_dir(spark)
    records.write_records(docs([]), folder, vocabulary)
    assert records.with_starts(records.read_records(spark, folder)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([1, 255, 256, 257, 512, 1023, 1024, 1025, 5000]), st.integers(1, 2500)), max_size=50))
def test_packing_is_a_partition_with_one_open_window(lengths):
    windows, rest = packing.pack(lengths)
    windows = windows + packing.cut_rest(list(rest), packing.TIERS)
    at = {}
    for doc, start, n in sorted(p for _, w in windows for p in w):
        assert at.get(doc, 0) == start and n > 0
        at[doc] = start + n
    assert at == dict(enumerate(lengths))
    sizes = [(tier, sum(p[2] for p in w)) for tier, w in windows]
    assert sum(size != tier for tier, size in sizes) <= 1 and all(size <= tier for tier, size in sizes)


def test_packed_pieces(docs, library, vocabulary, sample, edges):
    rows = [(i, t) for i, t in sample[:60] + edges if i is not None and i != 900007]
    got = packing.pack_documents(docs(rows), vocabulary).collect()
    own = {i: [*expected(library, t), 0] for i, t in rows}
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        ids = own[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes()) and r["doc_tokens"] == len(own[r["doc_id"]])
    for i, ids in own.items():
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            assert r["start"] == at
            at += r["length"]
        assert at == len(ids)
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    assert padding <= 3 * 1024
    steps = {}
    for r in {r["sequence_id"]: r for r in got}.values():
        steps.setdefault(r["step_group"], []).append(r["tier"])
    assert all(len(set(t)) == 1 and len(t) <= packing.STEP_TOKENS // t[0] for t in steps.values())
    assert packing.pack_documents(docs([]), vocabulary).count() == 0


def test_shuffled_reads_and_a_repeated_id(spark, docs, vocabulary, sample):
    rows = sample[:40] + [(7, f"{t} {i}") for i, (_, t) in enumerate(sample[:60])] + [(7, None), (None, "a"), (None, "a")]
    folder = common.shared_dir(spark)
    records.write_records(docs(rows), folder, vocabulary)
    plain, mixed = records.read_records(spark, folder).collect(), records.read_records(spark, folder, seed=5).collect()
    assert sorted(map(tuple, plain), key=str) == sorted(map(tuple, mixed), key=str) and len(plain) == len(rows)
    assert [r["start"] for r in mixed] != sorted(r["start"] for r in mixed)
    assert len({r["file"] for r in plain if r["doc_id"] == 7}) > 1


def test_packing_of_null_and_repeated_ids(docs, library, vocabulary):
    rows = [(None, "a b"), (None, None), (5, "same"), (5, "same"), (5, "other words")]
    got = packing.pack_documents(docs(rows), vocabulary).collect()
    crc = lambda t: zlib.crc32(np.array([*expected(library, t), 0], "<u4").tobytes())
    assert sorted((str(r["doc_id"]), r["ids_crc32"], r["length"]) for r in got) == sorted((str(i), crc(t), len(expected(library, t)) + 1) for i, t in rows)
