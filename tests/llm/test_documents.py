"""Operators on documents against brute force, with nulls, ties, repeated rows, clashing columns and empty tables."""

import random

import pytest
from pyspark.sql import functions as F

from ordertide.llm import jaccard, linechunks, mixing, postings, quality, superkmers
from tests.conftest import SF01
from tests.llm import brute

SCHEMA = "doc_id long, text string"


def frame(spark, rows, schema=SCHEMA):
    return brute.with_clashing_columns(spark.createDataFrame(rows, schema))


def got(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return [(r.doc_id, r.text) for r in documents.collect()]


# ------------------------------------------------------ substring dedup ----

REMOVED = ("doc_id", "n_words", "n_removed", "kept_sha256")


def passages(seed, n):
    r = random.Random(seed)
    pieces = [[r.choice("a b c é dd ee ff g h".split()) for _ in range(r.choice([5, 15, 30]))] for _ in range(12)]
    rows = []
    for i in range(n):
        t = [w for _ in range(r.randrange(6)) for w in r.choice(pieces)]
        rows.append((r.choice([i, i, None, 5]), r.choice([" ", "\n", "  "]).join(t) if r.random() < 0.95 else None))
    return rows + [(1000, "a " * 300), (1001, "a " * 200), (1002, ""), (1003, " "), (1004, "b" * 50_000 + " c" * 30), (1005, "b" * 50_000 + " c" * 30)]


def test_repeated_windows(spark):
    rows = passages(3, 120)
    assert got(superkmers.remove_repeats(frame(spark, rows)), *REMOVED) == brute.repeats(rows)


def test_repeated_windows_of_the_given_table(documents, texts):
    assert got(superkmers.remove_repeats(documents), *REMOVED) == brute.repeats(texts)


def test_windows_of_one_hash_are_told_apart(monkeypatch):
    import numpy as np

    ids = np.array([1, 2, 1, 2, 3, 1, 2])
    monkeypatch.setattr(superkmers, "windows", lambda h, k: np.zeros(len(h) - k + 1, np.uint64))
    order, cuts = superkmers.sorted_windows(ids, np.arange(6), 2)
    assert sorted(np.diff(np.append(cuts, 6)).tolist()) == [1, 1, 1, 3]


# ------------------------------------------------------ decontamination ----

HIT = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@pytest.mark.parametrize("block", [1 << 20, 200])
def test_phrases_in_one_block_or_many(spark, block):
    r = random.Random(2)
    vocabulary = "a b c d É ée F 1 2".split()
    items = [(r.choice([i, i, None, 3]), r.choice([None, "", " "]) if r.random() < 0.1 else " ".join(r.choice(vocabulary) for _ in range(r.choice([1, 3, 9, 10, 11, 25])))) for i in range(30)]
    docs = []
    for i in range(120):
        t = []
        for _ in range(r.randrange(5)):
            t += brute.plain_words(r.choice(items)[1]) if r.random() < 0.5 else [r.choice(vocabulary) for _ in range(r.randrange(20))]
        docs.append((r.choice([i, i, None, 7]), r.choice([" ", "-", "\n, "]).join(t).upper() if r.random() < 0.95 else None))
    found = postings.contamination(frame(spark, docs), frame(spark, items, "item_id long, text string"), block=block)
    assert got(found, *HIT) == brute.hits(docs, items)


def test_proximity_matches(spark):
    phrase = "one two three four five six seven eight nine ten"
    docs = [(1, phrase), (2, phrase.replace("five", "five so")), (3, phrase.replace("five", "five a b c d e"))]
    items = frame(spark, [(9, phrase)], "item_id long, text string")
    found = {r.doc_id: r for r in postings.search(postings.build_index(frame(spark, docs)), items).collect()}
    assert [found[i].items for i in (1, 2, 3)] == [["9"], [], []]
    assert [found[i].near for i in (1, 2, 3)] == [[], ["9"], []]
    assert (found[1].starts, found[1].ends) == ([0], [10])


def test_contamination_of_the_given_tables(spark, documents, texts):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    assert got(postings.contamination(documents, items), *HIT) == brute.hits(texts, [(r.item_id, r.text) for r in items.collect()])


# ----------------------------------------------------------- near copies ----


@pytest.mark.parametrize("options", [{}, {"tile": 3}, {"n": 5, "percent": 80}, {"n": 5, "percent": 80, "tile": 2}])
def test_components(spark, options):
    rows = brute.family(random.Random(4), 40)
    found = got(jaccard.near_copies(frame(spark, rows), **options), "doc_id", "n_shingles", "component_id")
    assert found == sorted(brute.groups(rows, options.get("n", 3), options.get("percent", 90)), key=str)


def test_components_of_the_given_table(documents, texts):
    assert got(jaccard.near_copies(documents), "doc_id", "n_shingles", "component_id") == sorted(brute.groups(texts), key=str)


def test_bounds_of_sizes():
    for t in (80, 90):
        first = jaccard.size_classes(500, t)
        for a in range(1, 400):
            for b in range(a, min(a * 100 // t, 400) + 1):
                tags = [{int((first <= n).sum()) - 1 + j for j in (0, 1)} for n in (a, b)]
                assert tags[0] & tags[1]
                tag = max(tags[0] & tags[1])
                assert jaccard.most_apart(a + b, t) <= jaccard.most_apart(2 * int(first[tag + 1] - 1), t)


def test_one_row_of_each_component_stays(spark):
    rows = [(3, "a b c d e f g h"), (1, "a b c d e f g h"), (1, "a b c d e f g h"), (2, "other words are here now"), (4, None), (5, ""), (None, "a b c d e f g h")]
    kept = jaccard.representatives(frame(spark, rows))
    assert got(kept, "doc_id") == [(1,), (2,), (4,), (5,)] and "row" in kept.columns


# ------------------------------------------------------------ line dedup ----


def test_repeated_chunks(spark):
    r = random.Random(1)
    rows = [(i, r.choice(["\n".join(r.choice(["a", "b", "c", "", "a longer line"]) for _ in range(r.randrange(12))), None, ""])) for i in range(200)]
    found = linechunks.deduplicated(frame(spark, rows))
    assert dict(got(found, "doc_id", "text")) == brute.without_repeated_chunks(rows)


def test_only_a_text_of_one_line_is_a_chunk_of_one_line(spark):
    r = random.Random(2)
    texts = ["\n".join(r.choice(["a", "b", "c", "d", ""]) for _ in range(n)) for n in range(1, 40) for _ in range(5)]
    df = spark.createDataFrame([(x,) for x in texts], "text string")
    chunks = df.select("text", linechunks._chunks(F.col("text"), 3).alias("c")).collect()
    for row in chunks:
        want = [len(c) for c in brute.chunks(row.text)]
        assert [c.e - c.s + 1 for c in row.c] == want and (min(want) > 1 or "\n" not in row.text)


def test_a_text_of_a_hundred_thousand_lines(spark):
    """Two texts of 5 MB that share all but a few lines: linear work, so the test ends."""
    lines = [f"line {i} " + "x" * 40 for i in range(100_000)]
    other = [x + "!" if i % 20_000 == 7 else x for i, x in enumerate(lines)]
    out = {r.doc_id: r.text for r in linechunks.deduplicated(frame(spark, [(1, "\n".join(lines)), (2, "\n".join(other))])).collect()}
    assert out[1].count("\n") == 99_999 and 5 <= out[2].count("\n") + 1 < 200


def test_no_python_on_the_main_path_of_line_dedup(spark):
    out = linechunks.report(frame(spark, [(1, "a\nb\nc"), (2, "a\nb\nc")]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_rows_that_share_a_key(spark):
    lines = "\n".join(f"line {i}" for i in range(30))
    rows = [(1, lines), (1, lines), (1, "x\n" + lines), (None, lines), (2, lines)]
    found = sorted((r.doc_id is not None, r.doc_id or 0, len(r.text)) for r in linechunks.deduplicated(frame(spark, rows)).collect())
    assert found[0] == (False, 0, len(lines))  # the null key comes first, so its text is the first occurrence
    assert all(n < len(lines) // 2 for _, _, n in found[1:])


def test_characters_are_counted_again(spark):
    lines = "\n".join(f"line {i}" for i in range(30))
    df = spark.createDataFrame([(1, lines, len(lines)), (2, "x\n" + lines, len(lines) + 2)], "doc_id long, text string, n_chars long")
    out = linechunks.deduplicated(df)
    assert out.columns == df.columns and all(r.n_chars == len(r.text) for r in out.collect())


# --------------------------------------------------------- quality rules ----

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_counts(spark):
    r = random.Random(2)
    rows = [(r.choice([i, None, 3]), r.choice([None, "", " ", "\n\n"]) if r.random() < 0.1 else "".join(r.choice(["a", "b ", "é", "\n", "#", "\n\n", " x y z ", "$"]) for _ in range(r.randrange(200))), r.choice(["en", None, "xx"])) for i in range(150)]
    found = got(quality.judged(frame(spark, rows, "doc_id long, text string, lang string")), "doc_id", *COUNTS)
    assert found == sorted(((d, *brute.quality(t)) for d, t, _ in rows), key=str)


def test_verdicts(documents, texts):
    found = {r.doc_id: r for r in quality.judged(documents).collect()}
    assert all(tuple(found[d][c] for c in COUNTS) == brute.quality(t) for d, t in texts)
    assert not any(r.kept and r.base_failed for r in found.values())
    junk = [r for r in found.values() if not r.base_failed and r.n_symbols * 2 > r.n_words and r.word_chars > 600]
    clean = [r for r in found.values() if not r.base_failed and r.n_symbols == 0]
    assert junk and not any(r.kept for r in junk)
    assert all(r.kept for r in clean)


def test_languages_have_their_own_references(spark):
    r = random.Random(5)

    def prose(letters, n=120):
        return " ".join("".join(r.choice(letters) for _ in range(r.randrange(2, 9))) for _ in range(n))

    latin, cyrillic, junk = "abcdefghijklmnop", "абвгдежзиклмнопр", "#|$%&*<>"
    rows = [(i, prose(cyrillic if i % 2 else latin), "ru" if i % 2 else "pl") for i in range(200)]
    rows += [(200 + i, prose(latin), lang) for i, lang in enumerate([None, "", "und", "ka", "ka"])]
    rows += [(300 + i, prose(junk), lang) for i, lang in enumerate(["ru", "PL", "pl_PL.UTF-8"])]
    found = {x.doc_id: x for x in quality.judged(frame(spark, rows, "doc_id long, text string, lang string")).collect()}
    assert all(found[i].kept and found[i].char_distance < 0.1 for i in range(200))
    assert all(found[i].kept and found[i].char_distance is None for i in range(200, 205))
    assert not any(found[i].kept for i in range(300, 303))


def test_tags_of_one_language(spark):
    from pyspark.sql import functions as F

    tags = ["en", "EN", "en-US", " En_gb", "en-Latn-US", "sr-Cyrl-RS", "sr_latn", "zh-cmn-Hans", "de-1996", "x", "", None, "MUL"]
    rows = spark.createDataFrame([(t,) for t in tags], "lang string").select("lang", quality.reference_of(F.col("lang")).alias("ref")).collect()
    assert [x.ref for x in rows] == ["en"] * 5 + ["sr-cyrl", "sr-latn", "zh-hans", "de", "x", None, None, None]


def test_other_tags_get_word_verdicts(spark, documents):
    from pyspark.sql import functions as F

    as_is = got(quality.judged(documents), "doc_id", "kept", "word_distance")
    assert got(quality.judged(documents.withColumn("lang", F.concat(F.upper("lang"), F.lit("-XX")))), "doc_id", "kept", "word_distance") == as_is


def test_distance_equals_its_definition(spark):
    import math

    from pyspark.sql import functions as F

    p, q = [3, 0, 5, 2], [1, 4, 4, 1]
    a, b = [x / sum(p) for x in p], [x / sum(q) for x in q]
    m = [(x + y) / 2 for x, y in zip(a, b)]
    kl = lambda u: sum(x * math.log2(x / z) for x, z in zip(u, m) if x)
    found = spark.range(1).select(quality.js_distance(F.array(*map(F.lit, p)), F.array(*map(F.lit, q)))).first()[0]
    assert found == pytest.approx(math.sqrt((kl(a) + kl(b)) / 2))


# ---------------------------------------------------------------- mixing ----


def fill(sizes, weights, limit):
    """Shares by weight; what is above a limit is shared again, until none is."""
    total, left, target = sum(sizes), set(range(len(sizes))), {}
    while True:
        rest = total - sum(target.values())
        share = {i: rest * weights[i] / sum(weights[j] for j in left) for i in left}
        over = [i for i in left if share[i] > limit * sizes[i]]
        if not over:
            return [target.get(i, share.get(i)) for i in range(len(sizes))]
        for i in over:
            target[i] = limit * sizes[i]
            left.discard(i)


def test_targets_and_taken_words(spark):
    r = random.Random(6)
    names = ["tiny", "b", "é", "Z", None]
    rows = []
    for i in range(4000):
        s = names[0] if i < 20 else r.choice(names[1:])
        rows.append((i, r.choice([" ".join("w" * r.randrange(60)), None, ""]), s))
    df = frame(spark, rows, "doc_id long, text string, source string")
    found = mixing.mixed(df).collect()
    assert len(found) == len(rows)
    order = sorted([n for n in names if n is not None]) + [None]
    size = {n: sum(len(brute.words(t)) for _, t, s in rows if s == n) for n in order}
    target = dict(zip(order, fill([size[n] for n in order], [(5, 2, 1)[i % 3] for i in range(5)], 3)))
    for n in order:
        mine = [x for x in found if x.source == n]
        assert mine[0].source_size == size[n] and mine[0].target == pytest.approx(target[n])
        assert sum(x.taken for x in mine) == pytest.approx(target[n], rel=0.02, abs=60)
    assert all(x.taken == x.copies * x.size and 0 <= x.copies <= 3 for x in found)
    again = mixing.mixed(df.repartition(5)).collect()
    assert sorted(found) == sorted(again)


def test_limit_shares_again(spark):
    rows = [("a", 10), ("b", 1000), ("c", 1000), ("d", 0)]
    found = {x.name: x.target for x in mixing.targets(spark.createDataFrame(rows, "name string, source_size long")).collect()}
    assert [found[n] for n, _ in rows] == pytest.approx(fill([s for _, s in rows], [5, 2, 1, 5], 3))


def test_mixture_repeats_whole_rows(spark):
    rows = [(i, "a b c", "x" if i < 10 else "y") for i in range(100)]
    out = mixing.mixture(frame(spark, rows, "doc_id long, text string, source string"))
    assert {"doc", "size", "of", "copy"} <= set(out.columns)
    assert sorted({r.copy for r in out.filter("source = 'x'").collect()}) == [1, 2, 3]


# ----------------------------------------------------------- empty tables ----


@pytest.mark.parametrize("operator", [superkmers.remove_repeats, jaccard.near_copies, linechunks.report, quality.judged, mixing.mixed, jaccard.representatives, linechunks.deduplicated, mixing.mixture])
def test_empty_table(documents, operator):
    assert operator(documents.limit(0)).count() == 0


def test_empty_tables_of_the_search(spark, documents):
    items = spark.read.parquet(f"{SF01}/benchmark.parquet")
    assert postings.contamination(documents.limit(0), items).count() == 0
    assert postings.contamination(documents, items.limit(0)).filter("contaminated").count() == 0
