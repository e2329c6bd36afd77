import random

import numpy as np
import pyarrow as pa

from ordertide.llm.words import ALNUM, SPACE, buffer_of, cut, hashes, windows, within
from ordertide.llm.work import pack, unpack
from tests.llm.brute import plain_words, words


def texts():
    r = random.Random(1)
    return ["".join(r.choice(" \t\nab éÉZ.\x0b-9") for _ in range(r.choice([0, 1, 5, 50]))) for _ in range(300)] + [None, "", "x" * 5000]


def test_words_equal_the_expressions():
    for separators, lower, expected in ((SPACE, False, words), (ALNUM, True, plain_words)):
        w = cut(*buffer_of(pa.chunked_array([texts()[:100], texts()[100:]])), separators, lower)
        data = [x.decode() for x in w.arrow().to_pylist()]
        assert [data[a:b] for a, b in zip(w.first[:-1], w.first[1:])] == [expected(t) for t in texts()]


def test_sliced_and_empty_columns():
    assert len(cut(*buffer_of(pa.array(texts()).slice(5, 0)), SPACE)) == 0
    w = cut(*buffer_of(pa.array(["a b", "c", "d e f"]).slice(1, 2)), SPACE)
    assert [x.decode() for x in w.arrow().to_pylist()] == ["c", "d", "e", "f"]


def test_hashes_are_of_the_bytes_and_windows_stay_in_a_text():
    w = cut(*buffer_of(pa.array(["a b a", "a b", ""])), SPACE)
    h = hashes(w.data, w.off)
    assert h[0] == h[2] == h[3] and h[1] == h[4] != h[0]
    two = windows(h, 2)
    assert two[0] == two[3] and within(w.first, 2, len(w)).tolist() == [True, True, False, True]


def test_pack_round_trip():
    a, b = np.arange(5, dtype=np.uint32), np.zeros(0, np.int64)
    x, y = unpack(pack(a, b), np.uint32, np.int64)
    assert x.tolist() == a.tolist() and len(y) == 0
