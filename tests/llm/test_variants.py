import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ordertide.llm import queries, variants
from tests.llm.brute import with_clashing_columns

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def words(rows):
    out = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            out[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(n):
    """All pairs of words of neighbouring lengths, compared one by one."""
    by = {}
    for w in n:
        by.setdefault(len(w), []).append(w)
    beside = {w: [x for k in (-1, 0, 1) for x in by.get(len(w) + k, ()) if near(w, x)] for w in n}
    form = {}
    for w, xs in beside.items():
        best = min(xs, key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= 10 * n[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n[w], len(beside[w]), n[form[w]] if w in form else None) for w in n}


def found(df):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_against_all_pairs(spark):
    """Chains of forms, ties, both kinds of letters, insertions at either end and in runs of one letter, a long run, nulls."""
    r = random.Random(4)
    rows = []
    for stem in ("aaaaaaaa", "grüßeXyz", "abcabcabc", "Ωnotaletter", "z" * 300, "ÀÉîõüÿ×÷"):
        for _ in range(60):
            w = list(stem)
            for _ in range(r.choice([0, 0, 1, 1, 2])):
                i = r.randrange(len(w) + 1)
                w[i : i + r.randrange(2)] = r.choice(["", "a", "b", "é"])
            rows.append((r.choice([None, 1, 2, 3]), " ".join(["".join(w)] * r.choice([1, 2, 3, 30, 400]))))
    rows += [(9, None), (10, ""), (11, "short 12 !")] + rows[:4]
    n = words(rows)
    want = expected(n)
    assert any(x[1] and x[2] != x[1] for x in want)  # some chain has two steps
    df = with_clashing_columns(spark.createDataFrame(rows, SCHEMA))
    assert found(variants.variants(df)) == want


def test_the_query_against_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert found(queries.QUERIES["op13_spelling_variants"](spark, SF)) == expected(words(rows))


@pytest.mark.parametrize("rows", [1, 1 << 18])
def test_blocks_are_never_cut(spark, monkeypatch, rows):
    """A block of a hundred words that differ in one place, held row by row or at once."""
    held = variants._tiles
    monkeypatch.setattr(variants, "ROWS", rows)
    assert held is variants._tiles
    data = [("common" + chr(97 + i) + "x" * (j + 1), 1 + i) for i in range(26) for j in range(4)]
    df = spark.createDataFrame(data, "word string, n long").repartition(1)
    assert {(r.word, r.n, r.n_near) for r in variants.grouped(df).collect()} == {(w, n, c) for w, _, _, n, c, _ in expected(dict(data))}


def test_single_edits():
    pairs = [("abcdefg", "abcdefg1"), ("abcdefg", "1abcdefg"), ("abcdefg", "abXdefg"), ("abcdefg", "abXdeXg"), ("aaaa", "aaaaa"), ("abcdefg", "bacdefg"), ("ab", "abcd")]
    flat = np.frombuffer("".join(a + b for a, b in pairs).encode("utf-32-le"), np.uint32)
    off = np.cumsum([0] + [len(w) for p in pairs for w in p])
    rows = np.arange(0, 2 * len(pairs), 2)
    assert variants.single_edits(flat, off, rows, rows + 1)[0].tolist() == [near(a, b) for a, b in pairs]


def test_empty_table(spark):
    assert not found(variants.variants(spark.createDataFrame([], SCHEMA)))
