"""Chat formatting by minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant turns in turn, from a user
turn to an assistant turn. Each given turn keeps its role or gets another one, and is
merged into the turn before it or follows it, if need be after an inserted empty turn. Dynamic
programming over the automaton of legal turns finds the cheapest repair.

The program's steps are min-plus products of small matrices, which are associative: long
conversations are cut into segments, each segment gives the matrix of its turns, a scan over a
conversation's matrices fixes the states between its segments, and each segment is then repaired
on its own. So a conversation of any length is read and repaired in bounded parts. Rows are ordered
by range, so that a conversation with a third of all turns lies in many partitions.

The result is one row for each piece of the repaired conversation: a given turn (kept, relabelled,
merged) or an inserted one. The rendered pieces, joined in order of ``pos``, are the
conversation's text.

Defined cases: a null or unknown role has to be relabelled, at a cost of its own; a null text is empty; turns are
ordered by number (null last), then role, then text, so ties and repeated rows stand side by side;
a null conversation id is a conversation; further columns are ignored, whatever their names; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.llm.work import written

#: Roles, and other names that they go by.
ROLES = ("system", "user", "assistant")
NAMES = {"system": 0, "developer": 0, "user": 1, "human": 1, "assistant": 2, "bot": 2, "gpt": 2, "model": 2, "ai": 2}
UNKNOWN = 3
#: States: the start, and after a turn of each role. Role r leads to state r + 1.
START, STATES = 0, 4
LEGAL = {(0, 0), (0, 1), (1, 1), (2, 2), (3, 1)}  # (state, role) that may follow
COSTS = {"merge": 1, "insert": 3, "relabel": 4, "unknown": 2}
#: Most turns and bytes of a segment.
SEGMENT_TURNS, SEGMENT_BYTES = 512, 4 << 20
NEVER = 1 << 40

SEGMENT = "part int, nr int, conv long, is_null boolean, roles array<int>, turns array<long>, texts array<string>, names array<string>, matrix array<long>"
STATE = "part int, nr int, state_in int, state_out int, before long, is_last boolean, cost long"
PIECES = "conv_id long, pos long, turn long, role string, action string, text string, rendered string, cost long"


def inserts(state: int, role: int) -> tuple[int, ...] | None:
    """Roles to insert so that ``role`` may follow ``state``; None if it never may."""
    if (state, role) in LEGAL:
        return ()
    for r in (1, 2):
        if (state, r) in LEGAL and (r + 1, role) in LEGAL:
            return (r,)
    return None


def ending(state: int) -> tuple[int, ...]:
    """Roles to insert after the last turn."""
    return {0: (), 1: (1, 2), 2: (2,), 3: ()}[state]


def moves(given: int, costs: dict[str, int]) -> list[tuple[int, int, int, str, tuple[int, ...]]]:
    """(cost, state, role, merge or follow, inserted roles) of every way to place a turn, cheapest and simplest first."""
    out = []
    for role in range(3):
        label = 0 if role == given else costs["unknown" if given == UNKNOWN else "relabel"]
        for state in range(STATES):
            if state == role + 1:
                out.append((label + costs["merge"], state, role, "merge", ()))
            gap = inserts(state, role)
            if gap is not None:
                out.append((label + costs["insert"] * len(gap), state, role, "follow", gap))
    return sorted(out, key=lambda m: (m[0], m[1], m[2], m[3]))


def steps(costs: dict[str, int]) -> np.ndarray:
    """Cost matrix (from state, to state) of a turn of each given role."""
    out = np.full((4, STATES, STATES), NEVER, np.int64)
    for given in range(4):
        for cost, state, role, _, _ in moves(given, costs):
            out[given, state, role + 1] = min(out[given, state, role + 1], cost)
    return out


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product."""
    return np.minimum(np.min(a[:, :, None] + b[None, :, :], axis=1), NEVER)


# -------------------------------------------------------------- segments ----


def _segments(costs: dict[str, int], most: int):
    step = steps(costs)
    none = np.full((STATES, STATES), NEVER, np.int64)
    np.fill_diagonal(none, 0)

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        nr, held, conv, size = 0, [], None, 0

        def close() -> pa.RecordBatch:
            matrix = none
            roles = [NAMES.get((r or "").strip().lower(), UNKNOWN) for _, _, r, _ in held]
            for r in roles:
                matrix = times(matrix, step[r])
            row = {
                "part": part, "nr": nr, "conv": held[0][0], "is_null": held[0][0] is None, "roles": roles, "turns": [t for _, t, _, _ in held],
                "texts": [x or "" for *_, x in held], "names": [r for _, _, r, _ in held], "matrix": matrix.reshape(-1).tolist(),
            }
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_pydict({k: pa.array([v], t) for (k, v), t in zip(row.items(), kinds)})

        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("conv", "turn", "role", "text"))):
                if held and (row[0] != conv or len(held) >= most or size >= SEGMENT_BYTES):
                    yield close()
                    nr, held, size = nr + 1, [], 0
                conv = row[0]
                held.append(row)
                size += len(row[3] or "")
        if held:
            yield close()

    return segment


# ------------------------------------------------------------------ scan ----


def between(matrices: list[np.ndarray], costs: dict[str, int]) -> tuple[list[int], int]:
    """States before, between and after a conversation's segments on a cheapest path, and its cost."""
    ahead = [np.array([0] + [NEVER] * (STATES - 1), np.int64)]
    for m in matrices:
        ahead.append(np.minimum(np.min(ahead[-1][:, None] + m, axis=0), NEVER))
    end = ahead[-1] + np.array([costs["insert"] * len(ending(s)) for s in range(STATES)])
    path = [int(np.argmin(end))]
    for m, before in zip(reversed(matrices), reversed(ahead[:-1])):
        path.append(int(np.argmin(before + m[:, path[-1]])))
    return path[::-1], int(end.min())


def _scan(costs: dict[str, int]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def close() -> pa.RecordBatch:
            path, cost = between([np.array(r["matrix"], np.int64).reshape(STATES, STATES) for r in held], costs)
            before = np.concatenate([[0], np.cumsum([r["n"] for r in held])])
            return pa.RecordBatch.from_pydict({
                "part": pa.array([r["part"] for r in held], pa.int32()), "nr": pa.array([r["nr"] for r in held], pa.int32()),
                "state_in": pa.array(path[:-1], pa.int32()), "state_out": pa.array(path[1:], pa.int32()), "before": pa.array(before[:-1], pa.int64()),
                "is_last": pa.array([i == len(held) - 1 for i in range(len(held))], pa.bool_()), "cost": pa.array([cost] * len(held), pa.int64()),
            })

        for batch in batches:
            for row in batch.to_pylist():
                if held and row["conv"] != held[0]["conv"]:
                    yield close()
                    held = []
                held.append(row)
        if held:
            yield close()

    return scan


# ---------------------------------------------------------------- repair ----


def repaired(roles: list[int], state_in: int, state_out: int, costs: dict[str, int]) -> list[tuple[int, str, tuple[int, ...]]]:
    """(role, merge or follow, roles inserted before) of each turn on a cheapest path between two states."""
    step = steps(costs)
    ahead = [np.full(STATES, NEVER, np.int64)]
    ahead[0][state_in] = 0
    for r in roles:
        ahead.append(np.minimum(np.min(ahead[-1][:, None] + step[r], axis=0), NEVER))
    state, out = state_out, []
    for i in range(len(roles) - 1, -1, -1):
        for cost, before, role, how, gap in moves(roles[i], costs):
            if role + 1 == state and ahead[i][before] + cost == ahead[i + 1][state]:
                out.append((role, how, gap))
                state = before
                break
    return out[::-1]


def _opened(role: int, first: bool) -> str:
    return ("" if first else "<|end|>\n") + f"<|{ROLES[role]}|>\n"


def _pieces(costs: dict[str, int]):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in batch.to_pylist():
                rows: list[tuple] = []
                at, first = 4 * s["before"], s["before"] == 0
                for (role, how, gap), turn, text, given in zip(repaired(s["roles"], s["state_in"], s["state_out"], costs), s["turns"], s["texts"], s["roles"]):
                    for k, r in enumerate(gap):
                        rows.append((at + k, None, ROLES[r], "insert", "", _opened(r, first)))
                        first = False
                    action = "merge" if how == "merge" else "keep"
                    action = action if role == given else "relabel" if action == "keep" else "relabel and merge"
                    rows.append((at + 2, turn, ROLES[role], action, text, ("\n\n" if how == "merge" else _opened(role, first)) + text))
                    first = False
                    at += 4
                if s["is_last"]:
                    for k, r in enumerate(ending(s["state_out"])):
                        rows.append((at + k, None, ROLES[r], "insert", "", _opened(r, False)))
                    rows[-1] = (*rows[-1][:5], rows[-1][5] + "<|end|>\n")
                pos, turn, role, action, text, rendered = zip(*rows)
                yield pa.RecordBatch.from_pydict({
                    "conv_id": pa.array([s["conv"]] * len(rows), pa.int64()), "pos": pa.array(pos, pa.int64()), "turn": pa.array(turn, pa.int64()), "role": pa.array(role, pa.string()),
                    "action": pa.array(action, pa.string()), "text": pa.array(text, pa.string()), "rendered": pa.array(rendered, pa.string()), "cost": pa.array([s["cost"]] * len(rows), pa.int64()),
                })

    return pieces


def formatted(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", costs: dict[str, int] = COSTS, segment: int = SEGMENT_TURNS) -> DataFrame:
    """The pieces (``PIECES``) of all repaired conversations."""
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = turns.select(F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(role).cast("string").alias("role"), F.col(text).cast("string").alias("text"))
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_last(), F.col("role").asc(), F.xxhash64("text").asc(), F.col("text").asc()]
    ranged = rows.repartitionByRange(n, *order[:4]).sortWithinPartitions(*order)
    # written once: the segments' numbers name the same rows ever after
    segments = written(ranged.mapInArrow(_segments(costs, segment), SEGMENT), "segments")
    small = segments.select("conv", "part", "nr", F.size("roles").cast("long").alias("n"), "matrix")
    states = small.repartition(n, "conv").sortWithinPartitions("conv", "part", "nr").mapInArrow(_scan(costs), STATE)
    told = segments.drop("matrix", "names").join(states, ["part", "nr"])
    return told.mapInArrow(_pieces(costs), PIECES)


def conversations(pieces: DataFrame) -> DataFrame:
    """(conv_id, n_turns, cost, rendered): whole texts, for conversations that fit in a row."""
    parts = F.array_sort(F.collect_list(F.struct("pos", "rendered")))
    return pieces.groupBy("conv_id").agg(F.sum((~F.col("action").endswith("merge")).cast("long")).alias("n_turns"), F.first("cost").alias("cost"), F.array_join(F.transform(parts, lambda p: p["rendered"]), "").alias("rendered"))
