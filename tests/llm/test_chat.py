import itertools
import random
import re

import pytest

from ordertide.llm import chat
from tests.llm.brute import with_clashing_columns

LEGAL = {(0, 0), (0, 1), (1, 1), (2, 2), (3, 1)}
KNOWN = {"system": 0, "user": 1, "assistant": 2, "Human": 1}


def walk(state, roles):
    for r in roles:
        if (state, r) not in LEGAL:
            return None
        state = r + 1
    return state


def cheapest(roles):
    """Least cost over all labels, merges and up to three insertions anywhere."""
    gaps = [g for k in range(4) for g in itertools.product(range(3), repeat=k)]
    now = {0: 0}
    for given in roles:
        after = {}
        for s, c in now.items():
            for label in range(3):
                cost = c + (0 if label == given else 2 if given == 3 else 4)
                if s == label + 1:
                    after[s] = min(after.get(s, 10**9), cost + 1)
                for g in gaps:
                    if walk(s, (*g, label)) is not None:
                        after[label + 1] = min(after.get(label + 1, 10**9), cost + 3 * len(g))
        now = after
    return min(c + 3 * len(g) for s, c in now.items() for g in gaps if walk(s, g) == 3)


@pytest.fixture(scope="module")
def turns():
    r = random.Random(8)
    return [(c, i, r.choice(["system", "user", "assistant", "assistant", "user", "tool", None, "Human"]), r.choice([None, "", "hi", "é\n"])) for c in range(40) for i in range(r.choice([1, 2, 3, 5, 9, 30]))]


@pytest.mark.parametrize("segment", [512, 1, 3])
def test_repair_is_legal_and_cheapest(spark, turns, segment):
    df = with_clashing_columns(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    pieces = chat.formatted(df, segment=segment)
    rows = pieces.collect()
    price = {}
    for p in rows:
        cost = {"insert": 3, "keep": 0, "merge": 1}.get(p.action)
        if cost is None:
            given = next(t[2] for t in turns if t[:2] == (p.conv_id, p.turn))
            cost = (4 if given in KNOWN else 2) + ("merge" in p.action)
        price[p.conv_id] = price.get(p.conv_id, 0) + cost
    for r in chat.conversations(pieces).collect():
        least = cheapest([KNOWN.get(t[2], 3) for t in turns if t[0] == r.conv_id])
        assert r.cost == least == price[r.conv_id]
        roles = re.findall(r"<\|(system|user|assistant)\|>", r.rendered)
        body = roles[1:] if roles[0] == "system" else roles
        assert body and body == ["user", "assistant"] * (len(body) // 2)
        assert r.rendered.endswith("<|end|>\n") and r.rendered.count("<|end|>") == len(roles) == r.n_turns
    assert sorted((p.conv_id, p.turn) for p in rows if p.turn is not None) == [t[:2] for t in turns]


def test_rendered_text(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (2, 0, "assistant", "d"), (None, None, "user", "q"), (None, 1, "user", "p"), (None, 1, "user", "p")]
    found = {r.conv_id: r.rendered for r in chat.conversations(chat.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    assert found[1] == "<|user|>\na\n\nb<|end|>\n<|assistant|>\nc<|end|>\n"
    assert found[2] == "<|user|>\n<|end|>\n<|assistant|>\nd<|end|>\n"
    assert found[None] == "<|user|>\np\n\np\n\nq<|end|>\n<|assistant|>\n<|end|>\n"


def test_empty_table(spark):
    assert chat.formatted(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
