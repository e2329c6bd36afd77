import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from ordertide.llm import glr, queries
from tests.llm.brute import with_clashing_columns

SCHEMA = "conv_id long, turn long, role string, text string"
LEGAL = re.compile("(s?(ua)+)?")
PREFIX = re.compile("(s?(ua)*u?)?")


def damaged(rows):
    out = defaultdict(list)
    for c, t, r, x in rows:
        out[c]
        r, x = (" " if v is None else v for v in (r, x))
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if h == 0:
            continue
        x = "" if h == 1 else re.sub("[.!?]", "", x) if h == 2 else x
        out[c] += [(t, "user" if h == 4 else r, x)] * (2 if h == 3 else 1)
    return {c: sorted(v, key=lambda a: (a[0] is not None, a[0] or 0, a[1], a[2].encode())) for c, v in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, r, x in rows:
        body = re.sub("[\x20\x09-\x0d]+$", "", x)
        out.append("b" if not body else "d" if (r, x) in seen else "" if body[-1] in ".!?" else "t")
        seen.add((r, x))
    return out


def cheapest(rows, fault):
    """Uniform-cost search over whole edit strings: no two ways are ever merged."""
    todo = [(0, "", 0, "", ())]
    while todo:
        cost, audit, i, roles, items = heapq.heappop(todo)
        if i == len(rows) and LEGAL.fullmatch(roles):
            return cost, audit, items
        steps = [(3, "I", i, "user", ""), (3, "I", i, "assistant", "")]
        if i < len(rows):
            _, r, x = rows[i]
            steps.append((4, "D", i + 1, None, None))
            if fault[i] not in ("b", "d"):
                more = 3 if fault[i] == "t" else 0
                steps += [(more, "K", i + 1, r, x), (more + 3, "R", i + 1, "user", x), (more + 3, "R", i + 1, "assistant", x)]
        for c, edit, j, r, x in steps:
            now = roles + (r[:1] if r else "") if r is not None else roles
            if (r is None or r[:1]) and PREFIX.fullmatch(now):
                heapq.heappush(todo, (cost + c, audit + edit, j, now, items if r is None else (*items, (r, x))))


def expected(rows):
    out = set()
    for c, v in damaged(rows).items():
        f = faults(v)
        turns = [t for t, *_ in v if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(v, v[1:]))
        cost, audit, items = cheapest(v, f)
        text = "\n".join(f"{r}:{x}" for r, x in items)
        out.add((c, gaps, f.count("b"), f.count("d"), f.count("t"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return out


def found(df):
    return {(r.conv_id, r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    roles, texts = ["system", "user", "assistant", "tool", None, "", "System"], [None, "", "a.", "b!", "c", "d e", " \n"]
    return [(r.choice([None, *range(30)]), r.choice([None, *range(9)]), r.choice(roles), r.choice(texts)) for _ in range(130)]


@pytest.mark.parametrize("segment", [256, 2, 1])
def test_against_a_search_without_merging(spark, rows, segment):
    """Nulls in every column, ties, repeated rows, unknown roles; segments cut anywhere."""
    df = with_clashing_columns(spark.createDataFrame(rows, SCHEMA))
    assert found(glr.report(df, segment=segment)) == expected(rows)


def test_the_query_against_the_search(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.QUERIES["op12_structure_repair"](spark, sf)) == expected(rows)


def test_the_stack_accepts_the_role_grammar():
    """Every role string of up to six turns lives on the stack exactly if it begins a legal one."""
    nodes, moves = glr.stacks()
    for n in range(7):
        for k in range(3**n):
            roles = "".join("sua"[k // 3**i % 3] for i in range(n))
            at = 0
            for r in roles:
                at = None if at is None else moves[at].get(r)
            assert (at is not None) == bool(PREFIX.fullmatch(roles))
            assert (at is not None and nodes[at].state in glr.ACCEPT) == bool(LEGAL.fullmatch(roles))


def test_repaired_turns(spark):
    rows = [(1, 0, "user", "a."), (1, 1, "user", "b."), (1, 2, "assistant", "c."), (2, 0, "assistant", "d."), (2, 1, "assistant", "d.")]
    got = defaultdict(list)
    for r in glr.repaired_turns(spark.createDataFrame(rows, SCHEMA)).orderBy("conv_id", "part", "nr", "pos").collect():
        got[r.conv_id].append((r.edit, r.turn, r.role, r.text))
    assert got[1] == [("I", None, "user", ""), ("R", 0, "assistant", "a."), ("K", 1, "user", "b."), ("K", 2, "assistant", "c.")] or got[1] == [("K", 0, "user", "a."), ("I", None, "assistant", ""), ("K", 1, "user", "b."), ("K", 2, "assistant", "c.")]
    assert got[2] == [("I", None, "user", ""), ("K", 0, "assistant", "d.")]


def test_one_long_conversation(spark):
    """Twenty thousand turns in one conversation, a third of them the same row: many segments, one path."""
    rows = [(7, i // 3, ("user", "assistant")[i // 3 % 2], f"{'same' if i % 3 else i}.") for i in range(20_000)]
    got = glr.report(spark.createDataFrame(rows, SCHEMA)).collect()
    f = [x for v in damaged(rows).values() for x in faults(v)]
    assert len(got) == 1 and got[0].duplicate == f.count("d") and got[0].blank == f.count("b") and got[0].truncated == f.count("t")
    assert len(got[0].audit.replace("I", "")) == len(f)
    prices = {"K": 0, "R": 3, "D": 4, "I": 3}
    letters = iter(f)
    assert got[0].cost == sum(prices[e] + (3 if e != "I" and (x := next(letters)) == "t" and e != "D" else 0) for e in got[0].audit)


def test_empty_table(spark):
    assert not found(glr.report(spark.createDataFrame([], SCHEMA)))
