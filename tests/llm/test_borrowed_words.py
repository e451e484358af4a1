"""Packed runs that borrow strings of a sample of the texts."""

import numpy as np

from framewright.llm import suffix


def test_packed_runs_borrow_words():
    words = b" ".join(b"word%d of the %d sample" % (i * 7919 % 1000, i) for i in range(2000))
    text = np.frombuffer(words, np.uint8)[5000:9000]
    start = np.arange(0, 3900, 100)
    runs = (start, np.full(39, 51), np.full(39, 3), np.arange(39) * 11, text[:3900])
    packed = {}
    for w in (b"", words):
        suffix._borrow(w)
        packed[w] = suffix.pack_runs(*runs)
        assert all((a == b).all() for a, b in zip(suffix.unpack_runs(packed[w]), runs))
    suffix._borrow(b"")
    assert 2 * len(packed[words]) < len(packed[b""])
