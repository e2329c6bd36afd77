"""Conversation structure repair by generalised LR parsing with weighted edits.

The role grammar ``C -> P | s P | nothing, P -> P u a | u a`` has the small LR table below. A conversation
is parsed by a graph-structured stack: every stack that some repair of the rows read so far leaves is alive at
once, stacks share their lower nodes, and equal stacks are merged by the minimum of (cost, audit). A
row may be kept, given another role or deleted, and a turn may be inserted before any row. At one cost, no audit
that leads to a stack is a prefix of another one that does, as the audit alone decides which roles
come out; so the least audit so far stays the least whatever follows, and merging is exact.

Costs add up and audits are joined, so a stretch of rows is a small matrix over the table's stacks: (cost, audit) from
each stack before it to each stack after it. Rows are ordered by range and cut into
segments of bounded size, each segment is parsed on its own, a scan over a conversation's
matrices fixes the stacks between its segments, and each segment then renders its repaired rows. Only the digest of a
conversation's repaired text is made by one task, in order and segment by segment.

Rows that are alike in conversation, turn, role and text are one row with a number before they are
shuffled by range; earlier copies elsewhere in the conversation are found by grouping on digests.

Defined cases: a null turn comes before any number; rows of one turn are ordered by role, then text;
a null role or text is one space; a null conversation id is a conversation; a row that is blank has to go
even if it is the only one; further columns are ignored, whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from ordertide.llm.work import written

#: Costs of the edits, and the remainder of the checksum that damages a row in each way.
COSTS = {"K": 0, "R": 3, "D": 4, "I": 3}
TRUNCATED = 3
DAMAGE = {"drop": 0, "empty": 1, "unstop": 2, "repeat": 3, "user": 4}
DAMAGE_OF = 20
SPACES, STOPS = " \t\n\x0b\x0c\r", ".!?"
NAMES = {"u": "user", "a": "assistant"}
#: Most rows and characters of a segment.
SEGMENT_ROWS, SEGMENT_CHARS = 256, 4 << 20

#: LR table of the role grammar: shifts, reductions (length of the right side) and gotos on P.
SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 6, (4, "u"): 6, (2, "a"): 5, (6, "a"): 7}
REDUCE = {5: 2, 7: 3}
GOTO = {0: 3, 1: 4}
ACCEPT = {0, 3, 4}

Best = tuple[int, str]


# ----------------------------------------------------------------- stack ----


class Node:
    """A stack: its top state and the node below. Equal stacks are one node."""

    def __init__(self, state: int, below: Node | None):
        self.state, self.below, self.above = state, below, {}

    def push(self, state: int) -> Node:
        if state not in self.above:
            self.above[state] = Node(state, self)
        return self.above[state]

    def after(self, role: str) -> Node | None:
        """The stack after a turn of ``role``: shift, then reduce as long as the table says."""
        state = SHIFT.get((self.state, role))
        if state is None:
            return None
        node = self.push(state)
        while node.state in REDUCE:
            for _ in range(REDUCE[node.state]):
                node = node.below
            node = node.push(GOTO[node.state])
        return node


@functools.cache
def stacks() -> tuple[list[Node], list[dict[str, int]]]:
    """All stacks that are alive between turns, the empty one first, and where each role leads from them."""
    found, moves = [Node(0, None)], []
    for node in found:
        to = {}
        for role in "sua":
            after = node.after(role)
            if after is not None:
                if after not in found:
                    found.append(after)
                to[role] = found.index(after)
        moves.append(to)
    return found, moves


def _merge(top: dict[int, Best], node: int, best: Best) -> bool:
    """Keeps the smaller of two equal stacks."""
    if node in top and top[node] <= best:
        return False
    top[node] = best
    return True


def _inserted(top: dict[int, Best]) -> dict[int, Best]:
    """The tops with every insertion that makes a stack cheaper."""
    moves, todo = stacks()[1], list(top)
    while todo:
        node = todo.pop()
        cost, audit = top[node]
        for role in "ua":
            to = moves[node].get(role)
            if to is not None and _merge(top, to, (cost + COSTS["I"], audit + "I")):
                todo.append(to)
    return top


def parsed(symbols: list[tuple[str, str, int]], start: int) -> dict[int, Best]:
    """Cheapest (cost, audit) from a stack to each stack, over rows (initial, fault, copies); faults are
    b(lank), d(uplicate), t(runcated) or none, and copies beyond the first are duplicates."""
    moves = stacks()[1]
    top = _inserted({start: (0, "")})
    for initial, fault, copies in symbols:
        after: dict[int, Best] = {}
        for node, (cost, audit) in top.items():
            _merge(after, node, (cost + COSTS["D"], audit + "D"))
            if fault in ("b", "d"):
                continue
            cost += TRUNCATED if fault == "t" else 0
            to = moves[node].get(initial)
            if to is not None:
                _merge(after, to, (cost + COSTS["K"], audit + "K"))
            for role in "ua":
                to = moves[node].get(role)
                if to is not None:
                    _merge(after, to, (cost + COSTS["R"], audit + "R"))
        if copies > 1:  # D is the least letter: an insertion between them is never better than one behind them
            after = {n: (c + COSTS["D"] * (copies - 1), a + "D" * (copies - 1)) for n, (c, a) in after.items()}
        top = _inserted(after)
    return top


@functools.lru_cache(maxsize=4096)
def _parsed_short(symbols: tuple[tuple[str, str, int], ...], start: int) -> dict[int, Best]:
    return parsed(list(symbols), start)


def rendered(rows: list[tuple[str, str, int]], audit: str, start: int) -> list[tuple[str, str, str, int | None]]:
    """(edit, role, text, row) of every turn that stays or is inserted; ``rows`` are (role, text, copies)."""
    moves = stacks()[1]
    node, row, copy, out = start, 0, 0, []
    for edit in audit:
        role = "u" if "u" in moves[node] else "a"
        if edit == "I":
            out.append((edit, NAMES[role], "", None))
        else:
            name, text, copies = rows[row]
            if edit == "K":
                role = name[:1]
                out.append((edit, name, text, row))
            elif edit == "R":
                out.append((edit, NAMES[role], text, row))
            copy += 1
            if copy == copies:
                row, copy = row + 1, 0
            if edit == "D":
                continue
        node = moves[node][role]
    return out


# ---------------------------------------------------------------- damage ----


def damaged(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, copies): the rows as the checksum of ``conv:turn`` leaves them."""
    space = F.lit(" ")
    rows = turns.select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role).cast("string"), space).alias("role"), F.coalesce(F.col(text).cast("string"), space).alias("text"),
        (F.crc32(F.concat(F.coalesce(F.col(conv).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn).cast("string"), space)).cast("binary")) % DAMAGE_OF).alias("h"),
    )
    hit = {k: F.col("h") == v for k, v in DAMAGE.items()}
    left = F.when(hit["empty"], F.lit("")).when(hit["unstop"], F.translate("text", STOPS, "")).otherwise(F.col("text"))
    return rows.filter(~hit["drop"]).select("conv", "turn", F.when(hit["user"], F.lit("user")).otherwise(F.col("role")).alias("role"), left.alias("text"), F.when(hit["repeat"], F.lit(2)).otherwise(F.lit(1)).cast("long").alias("copies"))


# -------------------------------------------------------------- segments ----


def _collected(rows: Iterator[tuple], schema: pa.Schema, size: Callable[[tuple], int]) -> Iterator[pa.RecordBatch]:
    """Record batches of rows of the ``schema``, of about a segment's size each."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += size(row)
        if len(held) >= 1024 or total >= SEGMENT_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


INT, LONG, STRING = pa.int32(), pa.int64(), pa.string()
_AT = [("part", INT), ("nr", INT), ("conv", LONG)]
SEGMENT = pa.schema([*_AT, ("turns", pa.list_(LONG)), ("roles", pa.list_(STRING)), ("texts", pa.list_(STRING)), ("copies", pa.list_(LONG)), ("faults", pa.list_(STRING)), ("digests", pa.list_(pa.binary()))])


def _fault(text: str) -> str:
    """Blank or truncated, as far as the text alone shows."""
    body = text.rstrip(SPACES)
    return "b" if not body else "" if body[-1] in STOPS else "t"


def _cut(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple]:
    part = TaskContext.get().partitionId()
    nr, held, conv, size = 0, [], None, 0

    def close() -> tuple:
        turns, roles, texts, copies = (list(x) for x in zip(*held))
        digests = [hashlib.sha256(f"{len(r)}:{r}{x}".encode()).digest() for r, x in zip(roles, texts)]
        return part, nr, conv, turns, roles, texts, copies, [_fault(x) for x in texts], digests

    for batch in batches:
        for c, *row in zip(*(batch[c].to_pylist() for c in ("conv", "turn", "role", "text", "copies"))):
            if held and (c != conv or len(held) >= most or size >= SEGMENT_CHARS):
                yield close()
                nr, held, size = nr + 1, [], 0
            conv = c
            held.append(tuple(row))
            size += len(row[2])
    if held:
        yield close()


def _segments(most: int):
    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _collected(_cut(batches, most), SEGMENT, lambda row: sum(map(len, row[5])))

    return segment


# ---------------------------------------------------------------- matrix ----

_COUNTS = ["n", "blank", "duplicate", "truncated", "illegal"]
MATRIX = pa.schema([
    *_AT, *[(c, LONG) for c in _COUNTS], ("first", STRING), ("last", STRING), ("least", LONG), ("most", LONG), ("turns", LONG),
    ("starts", pa.list_(INT)), ("ends", pa.list_(INT)), ("costs", pa.list_(LONG)), ("audits", pa.list_(STRING)),
])
LEGAL = {"su", "ua", "au"}


def _faults(faults: list[str], firsts: list[int] | None) -> list[str]:
    """Faults of the rows, where those that are no first of their kind are duplicates."""
    first = set(firsts or ())
    return [f if f == "b" or i in first else "d" for i, f in enumerate(faults)]


def _matrix(s: dict) -> tuple:
    faults = _faults(s["faults"], s["firsts"])
    initials = [r[:1] for r in s["roles"]]
    symbols = list(zip(initials, faults, s["copies"]))
    more = sum(s["copies"]) - len(faults)  # copies beyond the first: blank again, or duplicates
    blank = sum(c for f, c in zip(faults, s["copies"]) if f == "b")
    duplicate = sum(f == "d" for f in faults) + more - sum(c - 1 for f, c in zip(faults, s["copies"]) if f == "b")
    illegal = sum(x + y not in LEGAL for x, y in zip(initials, initials[1:])) + more  # a role never follows itself
    turns = [t for t in s["turns"] if t is not None]
    rows = []
    # the first segment of its conversation starts on the empty stack; any other one may start on each
    for start in [0] if s["opens"] else range(len(stacks()[0])):
        ends = _parsed_short(tuple(symbols), start) if len(symbols) <= 32 else parsed(symbols, start)
        rows += [(start, end, *best) for end, best in ends.items()]
    return (
        s["part"], s["nr"], s["conv"], sum(s["copies"]), blank, duplicate, sum(f == "t" for f in faults), illegal, initials[0], initials[-1],
        min(turns, default=None), max(turns, default=None), len(set(turns)), *(list(x) for x in zip(*rows)),
    )


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _collected((_matrix(s) for batch in batches for s in batch.to_pylist()), MATRIX, lambda row: sum(map(len, row[-1])))


# ------------------------------------------------------------------ scan ----

_WAY = pa.struct([("part", INT), ("nr", INT), ("start", INT), ("audit", STRING), ("only", pa.bool_())])
FACTS = pa.schema([("conv", LONG), ("gaps", LONG), *[(c, LONG) for c in _COUNTS], ("cost", LONG), ("audit", STRING), ("parts", pa.list_(_WAY))])


def chosen(matrices: list[dict[int, dict[int, Best]]]) -> tuple[Best, list[tuple[int, str]]]:
    """The least (cost, audit) through a conversation's matrices, and each segment's start and audit."""
    nodes = stacks()[0]
    # audits are joined once at the end: ahead holds the cost, the rank of the audit among equal costs, and the way
    top: dict[int, tuple[Best, tuple | None]] = {0: ((0, ""), None)}
    for m in matrices:
        after: dict[int, tuple[Best, tuple | None]] = {}
        for start, ((cost, audit), way) in top.items():
            for end, (more, letters) in m.get(start, {}).items():
                best = (cost + more, audit + letters)
                if end not in after or best < after[end][0]:
                    after[end] = (best, (start, letters, way))
        top = after
    best, way = min((v for k, v in top.items() if nodes[k].state in ACCEPT), key=lambda v: v[0])
    path = []
    while way is not None:
        path.append(way[:2])
        way = way[2]
    return best, path[::-1]


def _fact(held: list[dict]) -> tuple:
    matrices = []
    for s in held:
        m: dict[int, dict[int, Best]] = {}
        for start, end, cost, audit in zip(s["starts"], s["ends"], s["costs"], s["audits"]):
            m.setdefault(start, {})[end] = (cost, audit)
        matrices.append(m)
    (cost, audit), path = chosen(matrices)
    sums = [sum(s[c] for s in held) for c in _COUNTS]
    sums[-1] += sum(a["last"] + b["first"] not in LEGAL for a, b in zip(held, held[1:]))
    numbered = [s for s in held if s["least"] is not None]
    # a turn that goes on in the next segment is counted once
    turns = sum(s["turns"] for s in numbered) - sum(a["most"] == b["least"] for a, b in zip(numbered, numbered[1:]))
    gaps = numbered[-1]["most"] - numbered[0]["least"] + 1 - turns if numbered else 0
    parts = [{"part": s["part"], "nr": s["nr"], "start": at, "audit": letters, "only": len(held) == 1} for s, (at, letters) in zip(held, path)]
    return (held[0]["conv"], gaps, *sums, cost, audit, parts)


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row["conv"] != held[0]["conv"]:
                yield _fact(held)
                held = []
            held.append(row)
    if held:
        yield _fact(held)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _collected(_facts(batches), FACTS, lambda row: 2 * len(row[8]))


# ---------------------------------------------------------------- pieces ----

SHA = pa.schema([("conv", LONG), ("sha", STRING)])
PIECES = pa.schema([*_AT, ("edits", pa.list_(STRING)), ("roles", pa.list_(STRING)), ("texts", pa.list_(STRING)), ("turns", pa.list_(LONG))])


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[tuple]]]:
    for batch in batches:
        for s in batch.to_pylist():
            yield s, rendered(list(zip(s["roles"], s["texts"], s["copies"])), s["audit"], s["start"])


def _piece(s: dict, rows: list[tuple]) -> tuple:
    return s["part"], s["nr"], s["conv"], [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows], [None if r[3] is None else s["turns"][r[3]] for r in rows]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _collected((_piece(*x) for x in _repaired(batches)), PIECES, lambda row: sum(map(len, row[5])))


def _lines(rows: list[tuple]) -> bytes:
    return "\n".join(f"{role}:{text}" for _, role, text, _ in rows).encode()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations of one segment."""
    yield from _collected(((s["conv"], hashlib.sha256(_lines(rows)).hexdigest()) for s, rows in _repaired(batches)), SHA, len)


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    conv, digest, some = None, None, False
    for s, rows in _repaired(batches):
        if digest is not None and s["conv"] != conv:
            yield conv, digest.hexdigest()
            digest = None
        if digest is None:
            conv, digest, some = s["conv"], hashlib.sha256(), False
        if rows:
            digest.update((b"\n" if some else b"") + _lines(rows))
            some = True
    if digest is not None:
        yield conv, digest.hexdigest()


def _hashed_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of conversations whose segments come in order."""
    yield from _collected(_in_order(batches), SHA, len)


# -------------------------------------------------------------- operator ----


class Repair:
    """Repair of all conversations of damaged rows (conv, turn, role, text, copies): ``facts`` of each, and the cheapest way through each segment."""

    def __init__(self, rows: DataFrame, segment: int = SEGMENT_ROWS):
        spark = rows.sparkSession
        self.parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        alike = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
        order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc()]
        ranged = alike.repartitionByRange(self.parts, *order, F.xxhash64("text").asc()).sortWithinPartitions(*order, F.col("text").asc())
        # written once: the segments' numbers name the same rows ever after
        self.segments = written(ranged.mapInArrow(_segments(segment), from_arrow_schema(SEGMENT)), "segments")
        told = self._firsts()
        opening = self.segments.groupBy("conv").agg(F.min(F.struct("part", "nr")).alias("o")).select(F.col("o.part").alias("part"), F.col("o.nr").alias("nr"), F.lit(True).alias("opens"))
        plain = self.segments.select("part", "nr", "conv", "turns", "roles", "copies", "faults")
        ready = plain.join(told, ["part", "nr"], "left").join(opening, ["part", "nr"], "left").withColumn("opens", F.coalesce("opens", F.lit(False)))
        matrices = ready.mapInArrow(_matrices, from_arrow_schema(MATRIX))
        self.facts = written(matrices.repartition(self.parts, "conv").sortWithinPartitions("conv", "part", "nr").mapInArrow(_scan, from_arrow_schema(FACTS)), "facts")
        told = self.facts.select(F.explode("parts").alias("p")).select("p.*")
        self.ways = self.segments.select("part", "nr", "conv", "turns", "roles", "texts", "copies").join(told, ["part", "nr"])

    def _firsts(self) -> DataFrame:
        """(part, nr, firsts): the rows of each segment that are the first of their role and text in the conversation."""
        row = F.explode(F.filter(F.transform(F.arrays_zip("faults", "digests"), lambda x, i: F.struct(i.alias("i"), x["faults"].alias("fault"), x["digests"].alias("digest"))), lambda x: x["fault"] != "b"))
        rows = self.segments.select("part", "nr", "conv", row.alias("x")).select("conv", "x.digest", F.struct("part", "nr", "x.i").alias("at"))
        first = rows.groupBy("conv", "digest").agg(F.min("at").alias("at"))
        return first.groupBy(F.col("at.part").alias("part"), F.col("at.nr").alias("nr")).agg(F.collect_list("at.i").alias("firsts"))

    def digests(self) -> DataFrame:
        """(conv, sha) of the repaired rows, each as ``role:text``."""
        ways = self.ways.drop("turns")
        several = ways.filter(~F.col("only")).repartition(self.parts, "conv").sortWithinPartitions("conv", "part", "nr")
        return ways.filter("only").mapInArrow(_hashed, from_arrow_schema(SHA)).union(several.mapInArrow(_hashed_in_order, from_arrow_schema(SHA)))

    def turns(self) -> DataFrame:
        """(conv_id, part, nr, pos, edit, turn, role, text): the repaired rows; (part, nr, pos) is their order."""
        row = F.posexplode(F.arrays_zip("edits", "turns", "roles", "texts"))
        pieces = self.ways.mapInArrow(_pieces, from_arrow_schema(PIECES)).select(F.col("conv").alias("conv_id"), "part", "nr", row.alias("pos", "x"))
        return pieces.select("conv_id", "part", "nr", "pos", F.col("x.edits").alias("edit"), F.col("x.turns").alias("turn"), F.col("x.roles").alias("role"), F.col("x.texts").alias("text"))


def repaired_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Repaired rows of conversations as they are, undamaged."""
    space = F.lit(" ")
    rows = turns.select(F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role).cast("string"), space).alias("role"), F.coalesce(F.col(text).cast("string"), space).alias("text"), F.lit(1).cast("long").alias("copies"))
    return Repair(rows).turns()


def report(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", segment: int = SEGMENT_ROWS) -> DataFrame:
    """Faults, cost, audit and digest of every conversation after damage and repair."""
    repair = Repair(damaged(turns, conv, turn, role, text), segment)
    shas = repair.digests()

    def same(a: str, b: str) -> Column:
        return F.col(a).eqNullSafe(F.col(b))

    every = turns.select(F.col(conv).cast("long").alias("conv_id")).distinct()
    found = every.join(repair.facts.drop("parts"), same("conv_id", "conv"), "left").drop("conv").join(shas, same("conv_id", "conv"), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
