import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from ordertide.llm import prefixfree, queries
from tests.llm.brute import with_clashing_columns

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def brute(rows, k):
    texts = [(d, (x or "").encode()) for d, x in rows]
    seen = Counter(b[i : i + k] for _, b in texts for i in range(len(b) - k + 1))
    out = Counter()
    for d, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - k + 1):
            if seen[b[i : i + k]] > 1:
                gone[i : i + k] = b"\1" * k
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[(d, len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest())] += 1
    return out


def found(df, **kw):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in prefixfree.remove_repeats(df, **kw).collect())


@pytest.fixture(scope="module")
def rows():
    """Passages of random, periodic and multi-byte text with differing surroundings; nulls, empty texts and repeated rows."""
    r = random.Random(5)
    base = ["".join(r.choice("ab") for _ in range(900)), "a" * 700, "xyz" * 300, "".join(r.choice("abcdefgh ") for _ in range(2000)), "é" * 400]
    out = []
    for i in range(120):
        text = ""
        for _ in range(r.randrange(1, 6)):
            b = r.choice(base)
            x = r.randrange(len(b))
            text += b[x : x + r.randrange(1, 700)] + r.choice(["", "p", "q"])
        out.append((r.choice([None, i]), r.choice([text, text, text, text, None, ""])))
    return out + out[:5]


@pytest.mark.parametrize("kw", [{"k": 200}, {"k": 60, "core": 30}, {"k": 200, "piece": 300}])
def test_against_brute_force(spark, rows, kw):
    df = with_clashing_columns(spark.createDataFrame(rows, SCHEMA))
    assert found(df, **kw) == brute(rows, kw["k"])


def test_the_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.QUERIES["op11_suffix_dedup"](spark, SF).collect())
    assert got == brute(rows, 200)


def test_edges_of_a_window(spark):
    a = "".join(random.Random(1).choice("abcdefghij") for _ in range(400))
    rows = [(1, a[:200]), (2, "x" + a[:200] + "y"), (3, a[201:400]), (4, "z" + a[201:400])]
    got = {k[0]: k[2] for k in found(spark.createDataFrame(rows, SCHEMA))}
    assert got == {1: 200, 2: 200, 3: 0, 4: 0}


def test_a_text_of_many_pieces(spark):
    """2 MB that repeat a passage across the cut between pieces, and one long run of a single byte."""
    r = np.random.default_rng(3)
    noise = r.integers(97, 123, 2_000_000, dtype=np.uint8).tobytes().decode()
    cut = prefixfree.PIECE
    rows = [(1, noise), (2, noise[cut - 300 : cut + 300]), (3, "=" * 1_200_000)]
    got = {k[0]: k[1:4] for k in found(spark.createDataFrame(rows, SCHEMA))}
    assert got == {1: (2_000_000, 600, 1), 2: (600, 600, 1), 3: (1_200_000, 1_200_000, 1)}


def test_suffix_arrays_give_the_corpus_order():
    """Dictionary and parse together order suffixes as sorting them does, on text that repeats itself."""
    r = random.Random(9)
    words = ["".join(r.choice("abc") for _ in range(40)) for _ in range(6)]
    texts = ["".join(r.choice(words) for _ in range(30)).encode() for _ in range(4)]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    off = np.cumsum([0] + [len(t) for t in texts])
    k = 64
    places = np.concatenate([np.arange(a, b - k + 1) for a, b in zip(off[:-1], off[1:])])
    order = prefixfree.corpus_order(raw, off, k, places)
    windows = [raw[p : p + k].tobytes() for p in order]
    assert sorted(order) == sorted(places)
    assert len({w for w in windows}) == 1 + sum(a != b for a, b in zip(windows, windows[1:]))  # equal windows are neighbours


def test_hashes_do_not_depend_on_the_place():
    raw = np.frombuffer(b"abcabcxabc", np.uint8)
    h = prefixfree.Hashes(raw).of(np.array([0, 3, 7, 1]), 3)
    assert h[0] == h[1] == h[2] != h[3]


def test_empty_table(spark):
    assert not found(spark.createDataFrame([], SCHEMA))
