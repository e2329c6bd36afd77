import hashlib
import random
import re
import time

import pytest

from ordertide.llm import pii
from tests.llm.brute import with_clashing_columns

GIVEN = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    return {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in match.split(".")), "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def base(text):
    spans = [(m.start(), i, kind, m.end()) for i, (kind, rule) in enumerate(GIVEN) for m in re.finditer(rule, text or "") if valid(kind, m[0])]
    return [f"{kind}:{a}:{b}" for a, _, kind, b in sorted(spans)]


def expected(rows):
    return sorted(((d, *[sum(x.startswith(k) for x in base(t)) for k, _ in GIVEN], hashlib.sha256(",".join(base(t)).encode()).hexdigest()) for d, t in rows), key=str)


def found(df):
    rows = pii.identifiers(df).collect()
    return sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in rows), key=str), rows


def test_base_spans(spark):
    r = random.Random(5)
    bits = ["a@b.c", "x_y@z-.co.uk", "@", "a@b", ".", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "007.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111111", "1", " ", "-", "  "]
    bits += ["+1 (499) 555-6503", "+4", "é", "😀", "\n", "+12345678901234567", "_", "%", "12", "0.0.0.0", "a@b.com_x@y.org", "a@b.c@d.e"]
    rows = [(r.choice([i, None]), "".join(r.choice(bits) for _ in range(r.randrange(14))) if r.random() < 0.97 else None) for i in range(1000)]
    rows += [(9001, "1 " * 2000), (9002, "1.2.3.4 " * 300), (9003, "a" * 20000 + "@"), (9004, "4111111111111111 x " * 200), (9005, "")]
    got, full = found(with_clashing_columns(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == expected(rows)
    # base spans stay among all spans
    for x in full:
        assert len([s for s in x.spans.split(",") if s]) == x.n_email + x.n_ip + x.n_card + x.n_phone + x.n_added


def test_base_spans_of_the_given_table(spark):
    p = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert found(p)[0] == expected([(r.doc_id, r.text) for r in p.collect()])


def test_contexts_of_seeds_find_other_identifiers(spark):
    rows = [(i, f"please write to mailbox {c}{i}@host{i}.org today thanks") for i, c in enumerate("abcdefghij")]
    rows += [(100, "please write to mailbox joe4(at)host4 today thanks"), (101, "room number 4711 is free"), (102, "say hello 4711x now")]
    _, full = found(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [x.spans for x in sorted(full)][-3:] == ["email:24:37", "", ""]


def test_contexts_reach_as_far_as_their_words(spark):
    gap = " " * 80
    rows = [(i, f"please write to mailbox{gap}{c}{i}@host{i}.org{gap}today thanks") for i, c in enumerate("abcdefghij")]
    rows += [(100, "please write to mailbox joe4(at)host4 today thanks")]
    _, full = found(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [x.spans for x in full if x.doc_id == 100] == ["email:24:37"]


@pytest.mark.parametrize("n", [3, 31, 32, 62, 63, 64, 65, 100, 4095, 4096, 4097, 9000])
def test_patterns_of_long_words_and_gaps(spark, n):
    from pyspark.sql import functions as F

    rows = []
    for left, gap, right in [("a" * n, " ", "b" * n), ("é" * n, " \n", "c"), ("a", " " * n, "b"), ("so " * 5 + "a" * n, " ", "b" * n + " end")]:
        for before in ("", "first ", "w" * n + "\t" * n):
            text = f"{before}{left}{gap}1.2.3.4{gap}{right}"
            at = text.index("1.2")
            words = text[:at].split()
            two = [f"{words[-2]} {words[-1]} _"] if len(words) > 1 else []
            rows.append((text, at, at + 7, [*two, f"{words[-1]} _ {text[at + 7 :].split()[0]}"]))
    df = spark.createDataFrame(rows, "text string, s int, e int, expected array<string>")
    assert all(x.p == x.expected for x in df.select("expected", pii.patterns(F.col("text"), F.col("s"), F.col("e")).alias("p")).collect())


def test_pattern_that_goes_with_other_values_is_not_believed(spark):
    rows = [(i, f"see page {c}{i}@host{i}.org today") for i, c in enumerate("abcd")] + [(50 + i, f"see page {i} today") for i in range(10)]
    _, full = found(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sum(x.n_added for x in full) == 0


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 1000])
def test_starts(spark, n):
    from pyspark.sql import functions as F

    lens = [i % 7 for i in range(n)]
    df = spark.createDataFrame([(lens,)], "a array<int>").select(pii.starts_of(F.col("a")).alias("s"))
    assert n == 0 or df.first().s == [sum(lens[:i]) for i in range(n)]


# ------------------------------------------ brute force of the added spans ----


def norm(word):
    return re.sub("[0-9]", "0", word.lower())


def brute_patterns(text, start, end):
    before, after = text[:start].split(), text[end:].split()
    out = [f"{norm(before[-2])} {norm(before[-1])} _"] if len(before) > 1 else []
    return out + ([f"{norm(before[-1])} _ {norm(after[0])}"] if before and after else [])


def brute_spans(docs):
    """All spans of each text, by the rules of the module's docstring, over plain dictionaries."""
    seen, edges, seeds = [], set(), set()
    for d, text in docs:
        mine = [(*map(int, x.split(":")[1:]), [k for k, _ in GIVEN].index(x.split(":")[0])) for x in base(text)]
        free = [(m.start(), m.end(), None) for m in re.finditer(r"\S+", text) if re.search("[0-9@]", m[0]) and not any(a < m.end() and m.start() < b for a, b, _ in mine)]
        for a, b, kind in mine + free:
            value = text[a:b].lower()
            seen.append((d, a, b, kind, value, brute_patterns(text, a, b)))
            edges |= {(value, p) for p in seen[-1][-1]}
            if kind is not None:
                seeds.add((value, kind))
    values = {x: (1.0, 1) for x in seeds}
    for _ in range(pii.ROUNDS):
        good = {}
        for pattern in {p for _, p in edges}:
            with_it = [v for v, p in edges if p == pattern]
            for kind in range(4):
                known = [values[v, kind] for v in with_it if (v, kind) in values]
                score = sum(s for s, _ in known) / (len(with_it) + 1)
                if sum(n for _, n in known) >= pii.LEAST_SEEDS and score >= pii.LEAST_PATTERN:
                    good[pattern, kind] = score
        values = {x: (1.0, 1) for x in seeds}
        doubt = {}
        for v, p in edges:
            for kind in range(4):
                if (p, kind) in good:
                    doubt[v, kind] = doubt.get((v, kind), 1.0) * (1 - good[p, kind])
        for x, rest in doubt.items():
            values.setdefault(x, (1 - rest, 0))
    out = {d: base(text) for d, text in docs}
    for d, a, b, kind, value, found_patterns in seen:
        if kind is None:
            # the best score, then the first kind
            able = [(-values[value, k][0], k) for k in range(4) for p in found_patterns if (p, k) in good and values.get((value, k), (0,))[0] >= pii.LEAST_VALUE]
            if able:
                out[d].append(f"{GIVEN[min(able)[1]][0]}:{a}:{b}")
    order = [k for k, _ in GIVEN]
    return {d: ",".join(sorted(x, key=lambda s: (int(s.split(":")[1]), order.index(s.split(":")[0])))) for d, x in out.items()}


def test_added_spans_against_brute_force(spark):
    r = random.Random(11)
    lead = ["write to", "mail me at", "host at", "call us on", "charge card", "see page", "write to,"]
    kinds = [lambda i: f"u{i}@h{i}.org", lambda i: f"10.0.{i % 200}.7", lambda i: f"+1 (499) 555-{6000 + i}", lambda i: "4111 1111 1111 1111"]
    odd = [lambda i: f"u{i}(at)h{i}", lambda i: f"10-0-{i}", lambda i: f"{i}", lambda i: f"x{i}@"]
    rows = []
    for d in range(160):
        parts = []
        for _ in range(r.randrange(1, 6)):
            k = r.randrange(4)
            source = kinds[k] if r.random() < 0.8 else odd[k]
            parts.append(f"{lead[k] if r.random() < 0.9 else r.choice(lead)} {source(r.randrange(60))}{r.choice(['', '', '.', ','])} {r.choice(['now', 'today', 'please'])}")
        rows.append((d, r.choice(["  ", " ", "\n"]).join(parts)))
    expected_spans = brute_spans(rows)
    _, full = found(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {x.doc_id: x.spans for x in full} == expected_spans
    # the test means something only where spans are added, and some are not
    assert 10 < sum(x.n_added for x in full) < sum(len(re.findall(r"\S*[0-9@]\S*", t)) for _, t in rows) - 50


def test_candidates_beside_base_spans_of_several_kinds(spark):
    from pyspark.sql import functions as F

    r = random.Random(3)
    rows = []
    for _ in range(200):
        base_spans = []
        for k in range(4):
            at = 0
            while (at := at + r.randrange(1, 12)) < 60:
                end = at + r.randrange(1, 9)
                base_spans += [(at, k, end, "")]
                at = end
        base_spans = sorted(x for x in base_spans if r.random() < 0.3)
        at, words = 0, []
        while at < 60:
            end = at + r.randrange(1, 6)
            words.append((at, end, "v"))
            at = end + r.randrange(1, 4)
        rows.append((words, base_spans, [w for w in words if not any(a < w[1] and w[0] < b for a, _, b, _ in base_spans)]))
    df = spark.createDataFrame(rows, "w array<struct<start:int,end:int,value:string>>, b array<struct<start:int,kind:int,end:int,value:string>>, expected array<struct<start:int,end:int,value:string>>")
    assert all(x.free == x.expected for x in df.select("expected", pii._free(F.col("w"), F.col("b")).alias("free")).collect())


def test_runs_longer_than_a_word_of_a_context(spark):
    from pyspark.sql import functions as F

    n = pii.LONGEST
    rows = []
    for a in (n - 1, n, n + 1, 2 * n, 2 * n + 1):
        word = "a" * a
        one = a <= n
        rows.append((f"so {word} 1.2.3.4 end", f"{word} _ end" if one else None, 3 + a + 1))
        rows.append((f"so it {word}", None if not one else "so it _", 6))
        rows.append((f"x y 1.2.3.4 {word}", "x y _", 4))
    df = spark.createDataFrame(rows, "text string, among string, s int")
    for x in df.select("among", "s", "text", pii.patterns(F.col("text"), F.col("s"), F.col("s") + 7).alias("p")).collect():
        assert (x.among in x.p) if x.among else not any(len(p) > n for p in x.p), (x.s, len(x.text))


@pytest.mark.parametrize("kind", ["words", "one run"])
def test_a_text_of_many_spans(spark, kind):
    """2 MB, with 120,000 spans or 40,000 in one run without white space; quadratic work would take hours."""
    n = 20_000
    if kind == "words":
        one = "GET /page from 10.20.30.40 by u1@host.org at 12:30 took 7ms with id a1b2c3 and agent some-browser/5.0 ok done\n"
    else:
        one = "u1@host.org," + "x" * 80 + "/10.20.30.40;"
    began = time.monotonic()
    got, _ = found(spark.createDataFrame([(1, one * n), (2, "a@b.cd")], "doc_id long, text string"))
    assert time.monotonic() - began < 120
    assert got[0][1:3] == (n, n)


def test_empty_table(spark):
    assert pii.identifiers(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_no_python_on_the_main_path(spark):
    p = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = pii.found_in(p, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
