"""What a Python worker takes: it serves all steps, so what one step leaves is there in the next."""

import sys
import tracemalloc

import numpy as np
import pyarrow as pa

from framewright.llm import minhash, quality
from framewright.llm.queries import vocabulary
from framewright.llm.tokens import TokenIds


def peak_mb(run) -> float:
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def words(n: int) -> str:
    return " ".join(f"{chr(97 + i % 26)}{i}" for i in range(n))


def test_an_encoder_remembers_no_more_than_some_megabytes():
    encode = TokenIds(vocabulary())
    encode(words(400_000))
    encode("a " + "b7" * 500_000)  # one chunk
    held = sum(sys.getsizeof(memo) + sum(sys.getsizeof(k) + sys.getsizeof(v) for k, v in memo.items()) for memo in (encode.chunks, encode.pieces))
    assert held < 45e6


def test_what_is_not_remembered_gets_the_same_ids():
    text = "x " + words(300) + " " + "Long1" * 20 + " end, " + "y" * 100 + "."
    plain, small = TokenIds(vocabulary()), TokenIds(vocabulary())
    small.chunks.limit = 3
    ids = np.array(plain.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert plain(text) == plain(text) == small(text) == ids


def test_steps_hash_few_texts_at_a_time():
    text = words(3_000)
    n = 4_000_000 // len(text)
    batch = pa.record_batch([pa.array(range(n)), pa.array([text] * n)], ["doc_id", "text"])
    assert peak_mb(lambda: list(minhash._gather(iter([batch])))) < 25
    one = [text] * (1 + quality.BATCH_CHARS // len(text))
    model = quality.QualityModel(np.zeros((2, 1 << quality.BITS)), 0.0, 1.0, 0.0)
    assert peak_mb(lambda: model.probabilities(quality.TextBatch.of(one))) < 25
