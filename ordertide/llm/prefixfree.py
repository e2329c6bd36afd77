"""Exact substring dedup by prefix-free parsing.

Every string of ``k`` bytes that starts twice anywhere is removed wherever it stands. Texts are parsed at rolling-hash
triggers, which depend on the bytes around them alone, so equal text is cut alike wherever it
stands. Two parses are used:

* Anchors: the least rolling hash among the first places of a window of ``k`` bytes is its anchor. Consecutive windows
  of one anchor form a stretch, and every window holds the ``core`` bytes that follow its anchor. Cores and
  whole stretches are counted by their hashes over the corpus (a chunk of texts sends each one once): a
  core that is alone settles its windows as single, a stretch that recurs settles all its windows as repeated.
  Only stretches that are alone though their core recurs, mostly the rims of repeated passages, are left, beside
  one copy of each other stretch of their core.
* Prefix-free phrases: what is left is cut at trigger hashes into phrases that overlap by a trigger. The suffix array of
  the dictionary of distinct phrases and that of the parse (phrases by rank) combine into the order of all
  suffixes, in which equal windows are neighbours; neighbours are compared on their bytes. The classes of a chunk's order
  are merged with those of other chunks on 95 bits of hash each.

Long texts are cut into pieces that overlap by ``k - 1`` bytes, so a window lies in one piece, and neither a chunk nor a bin
grows with a text. A hot passage costs a row or a hash for each chunk, not for each copy.

Defined cases: a null or empty text has no bytes; a text of fewer than ``k`` bytes keeps all of them; repeated
rows and rows of one key are copies like any other; matches never cross texts; further columns are ignored, whatever their names; an
empty table gives an empty result. Cores (64 bits) and stretches (128 bits with their core) are known by their hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.llm.words import buffer_of, mix
from ordertide.llm.work import CHUNK_BYTES, pack, spans_of, unpack, written

U = np.uint64
#: Bytes of a trigger (a power of two), and of a piece of a long text.
TRIGGER, PIECE = 16, 1 << 20
#: Of so many triggers one ends a phrase.
PHRASE = 32
_RANDOM = np.random.default_rng(20250211)
_BYTE = _RANDOM.integers(0, 2**64, (2, 256), dtype=np.uint64)
_BASE = (U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93))
SENT, TOLD = "chunk long, bin long, kind int, blob binary", "chunk long, kind int, blob binary"
SPANS = "doc long, tie long, piece long, n_pieces long, starts array<long>, ends array<long>, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
CORE, STRETCH, WINDOW = 0, 1, 2


# ---------------------------------------------------------------- hashes ----


def _powers(base: int, n: int) -> np.ndarray:
    power = np.full(n, base, U)
    power[:1] = 1
    return np.cumprod(power, dtype=U)


class Hashes:
    """Hash of any byte range of ``raw``, from prefix sums."""

    def __init__(self, raw: np.ndarray, which: int = 0):
        n, base = len(raw), int(_BASE[which])
        self.sums = np.zeros(n + 1, U)
        np.cumsum(_BYTE[which][raw] * _powers(base, n), dtype=U, out=self.sums[1:])
        self.back = _powers(pow(base, -1, 1 << 64), n + 1)

    def of(self, at: np.ndarray, lens: np.ndarray | int) -> np.ndarray:
        """Ranges are brought back to the power of zero, so equal bytes hash alike wherever they stand."""
        return mix((self.sums[at + lens] - self.sums[at]) * self.back[at] + np.asarray(lens).astype(U))


def rolling(raw: np.ndarray, size: int = TRIGGER) -> np.ndarray:
    """Hash of the ``size`` bytes (a power of two) from each place on."""
    h, base, n = _BYTE[0][raw], int(_BASE[0]), 1
    while n < size and len(h) > n:
        h = h[:-n] * U(base) + h[n:]
        base, n = base * base % (1 << 64), 2 * n
    return mix(h) if n == size else np.zeros(0, U)


def least_of(values: np.ndarray, span: int) -> np.ndarray:
    """Place of the (leftmost) least value among ``span`` values from each place on."""
    n = len(values) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    bits = U(max(1, int(len(values)).bit_length()))
    keyed = (values >> bits << bits) | np.arange(len(values), dtype=U)
    size = 1
    while 2 * size <= span:
        keyed = np.minimum(keyed[:-size], keyed[size:])
        size *= 2
    if size < span:
        keyed = np.minimum(keyed[:n], keyed[span - size : span - size + n])
    return (keyed & ((U(1) << bits) - U(1))).astype(np.int64)


# ---------------------------------------------------------------- chunks ----


class Chunk:
    """A chunk's pieces with their stretches, in the same order whenever it is built."""

    def __init__(self, table: pa.Table, k: int, core: int):
        table = table.take(pc.sort_indices(table, [(c, "ascending") for c in ("doc", "tie", "piece")]))
        self.table, self.k = table, k
        self.raw, off = buffer_of(table["text"])
        self.off = off
        span = k - core + 1
        anchor = least_of(rolling(self.raw), span)
        n = len(self.raw) - k + 1
        ok = np.ones(max(0, n), bool)  # windows that lie in one piece
        for end in off[1:-1]:
            ok[max(0, end - k + 1) : end] = False
        anchor = anchor[: len(ok)]
        new = ok.copy()
        new[1:] &= ~(ok[:-1] & (anchor[1:] == anchor[:-1]))
        self.start = np.flatnonzero(new)
        run = np.cumsum(new)[ok] - 1
        self.n = np.bincount(run, minlength=len(self.start)).astype(np.int64)
        self.hash = Hashes(self.raw)
        self.core = self.hash.of(anchor[self.start], core)
        whole = self.hash.of(self.start, self.n + k - 1)
        self.stretch = mix(whole ^ mix(self.core + U(1)))

    def distinct(self) -> dict[int, tuple[np.ndarray, ...]]:
        """Cores (with their only stretch, or 0 if they have several) and stretches, each with whether it recurs here."""
        order = np.lexsort((self.stretch, self.core))
        core, stretch = self.core[order], self.stretch[order]
        cuts = np.flatnonzero(np.concatenate([[True], core[1:] != core[:-1]])) if len(core) else np.zeros(0, np.int64)
        twice = np.diff(np.append(cuts, len(core))) > 1
        only = np.where(stretch[cuts] == stretch[np.append(cuts[1:], len(core)) - 1], stretch[cuts], U(0)) if len(cuts) else stretch
        of, n = np.unique(self.stretch, return_counts=True)
        return {CORE: (core[cuts], only, twice), STRETCH: (of, of, n > 1)}


def _sent(chunk: int, bins: int, kind: int, key: np.ndarray, value: np.ndarray, twice: np.ndarray) -> list[tuple]:
    """Sorted keys by bin, as steps; whether a key recurs is the lowest bit of its value."""
    to = (key >> U(32)) % U(bins)
    order = np.lexsort((key, to))
    key, to = key[order], to[order].astype(np.int64)
    value = ((value & ~U(1)) | twice.astype(U))[order]
    edges = np.append(np.flatnonzero(np.diff(to, prepend=-1)), len(to))
    out = []
    for a, b in zip(edges[:-1], edges[1:]):
        mine = value[a:b] if kind == CORE else (value[a:b] & U(0xFFFFFFFF)).astype(np.uint32) if kind == WINDOW else (value[a:b] & U(1)).astype(np.uint8)
        out.append((chunk, int(to[a]), kind, pack(np.diff(key[a:b], prepend=U(0)), mine)))
    return out


def _send_table(rows: list[tuple]) -> pa.Table:
    chunk, to, kind, blob = zip(*rows) if rows else ((), (), (), ())
    return pa.table({"chunk": pa.array(chunk, pa.int64()), "bin": pa.array(to, pa.int64()), "kind": pa.array(kind, pa.int32()), "blob": pa.array(blob, pa.binary())})


def _told_table(rows: list[tuple]) -> pa.Table:
    chunk, kind, blob = zip(*rows) if rows else ((), (), ())
    return pa.table({"chunk": pa.array(chunk, pa.int64()), "kind": pa.array(kind, pa.int32()), "blob": pa.array(blob, pa.binary())})


def _send(k: int, core: int, bins: int):
    def send(table: pa.Table) -> pa.Table:
        c, chunk = Chunk(table, k, core), table["chunk"][0].as_py()
        return _send_table([row for kind, (key, value, twice) in c.distinct().items() for row in _sent(chunk, bins, kind, key, value, twice)])

    return send


def _match(table: pa.Table) -> pa.Table:
    """Of a bin: cores that recur with one stretch (1) or several (2); stretches and windows that recur (1, 2 for the chunk
    that stands for a stretch)."""
    out = []
    for want in (CORE, STRETCH, WINDOW):
        part = table.filter(pc.equal(table["kind"], want))
        if not part.num_rows:
            continue
        chunks = part["chunk"].to_pylist()
        blobs = [unpack(b, U, U if want == CORE else np.uint32 if want == WINDOW else np.uint8) for b in part["blob"].to_pylist()]
        key = np.concatenate([np.cumsum(steps) for steps, _ in blobs])
        value = np.concatenate([v for _, v in blobs]).astype(U)
        sender = np.repeat(np.arange(len(chunks)), [len(v) for _, v in blobs])
        order = np.lexsort((np.array(chunks)[sender], value >> U(1), key)) if want == WINDOW else np.lexsort((np.array(chunks)[sender], key))
        key, value, sender = key[order], value[order], sender[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        if want == WINDOW:
            new[1:] |= (value[1:] >> U(1)) != (value[:-1] >> U(1))
        cuts = np.flatnonzero(new)
        sizes = np.diff(np.append(cuts, len(key)))
        recurs = np.repeat((sizes > 1) | (np.bitwise_or.reduceat(value & U(1), cuts) > 0), sizes)
        mark = np.ones(len(key), np.uint8)
        if want == CORE:  # a stretch of 0 stands for several
            least, most = np.minimum.reduceat(value >> U(1), cuts), np.maximum.reduceat(value >> U(1), cuts)
            mark += np.repeat((least != most) | (least == 0), sizes).astype(np.uint8)
        elif want == STRETCH:
            mark[cuts] = 2
        by = np.flatnonzero(recurs)
        by = by[np.argsort(sender[by], kind="stable")]
        edges = np.append(np.flatnonzero(np.diff(sender[by], prepend=-1)), len(by))
        for a, b in zip(edges[:-1], edges[1:]):
            at = by[a:b]
            out.append((chunks[sender[at[0]]], want, pack(key[at], mark[at], (value[at] >> U(1)).astype(np.uint32))))
    return _told_table(out)


def _answers(told: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    part = told.filter(pc.equal(told["kind"], kind))
    blobs = [unpack(b, U, np.uint8, np.uint32) for b in part["blob"].to_pylist()]
    if not blobs:
        return np.zeros(0, U), np.zeros(0, np.uint8), np.zeros(0, np.uint32)
    key, mark, tag = (np.concatenate(x) for x in zip(*blobs))
    order = np.lexsort((tag, key))
    return key[order], mark[order], tag[order]


def _marks(keys: np.ndarray, told: tuple[np.ndarray, ...]) -> np.ndarray:
    """Mark of each key, 0 if none was told."""
    key, mark, _ = told
    if not len(key):
        return np.zeros(len(keys), np.uint8)
    at = np.minimum(np.searchsorted(key, keys), len(key) - 1)
    return np.where(key[at] == keys, mark[at], 0)


def settled(c: Chunk, told: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Which stretches recur as a whole, and which go on to the windows: those that are alone though their core
    recurs, and one copy of each other one of such a core."""
    core, stretch = _marks(c.core, _answers(told, CORE)), _marks(c.stretch, _answers(told, STRETCH))
    whole = (core > 0) & (stretch > 0)
    _, heads = np.unique(c.stretch, return_index=True)
    first = np.zeros(len(c.stretch), bool)
    first[heads] = True
    return whole, (core == 2) & ((stretch == 0) | ((stretch == 2) & first))


# --------------------------------------------------------- suffix arrays ----


def ranks(codes: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """Rank of the suffix at each place of sequences that end before ``ends`` (per place), by prefix doubling to ``depth`` codes."""
    rank = np.unique(codes, return_inverse=True)[1].reshape(-1).astype(np.int64) + 1
    place = np.arange(len(codes))
    size, classes = 1, int(rank.max(initial=0))
    while size < depth and classes < len(codes):
        on = place + size
        inside = on < ends
        behind = np.zeros(len(codes), np.int64)
        behind[inside] = rank[on[inside]]
        key = rank * (classes + 1) + behind
        rank = np.unique(key, return_inverse=True)[1].reshape(-1) + 1
        size, classes = 2 * size, int(rank.max(initial=0))
    return rank


def corpus_order(raw: np.ndarray, off: np.ndarray, k: int, places: np.ndarray) -> np.ndarray:
    """``places`` of the texts ``raw[off[i]:off[i + 1]]`` in the order of the ``k`` bytes that follow them, from the suffix arrays
    of dictionary and parse. All texts are longer than a trigger."""
    starts = np.zeros(len(raw), bool)
    h = rolling(raw)
    starts[: len(h)] = (h % U(PHRASE)) == 0
    for end in off[1:]:
        starts[max(0, end - TRIGGER) : end] = False  # such a trigger would cross into the next text
    starts[off[:-1]] = True
    first = np.flatnonzero(starts)  # phrases begin at triggers ...
    text = np.searchsorted(off, first, "right") - 1
    last_of = np.append(text[1:] != text[:-1], True)
    end = np.where(last_of, off[text + 1], np.append(first[1:], 0) + TRIGGER)  # ... and end with the next one
    lens = end - first
    phrase_off = np.zeros(len(first) + 1, np.int64)
    np.cumsum(lens, out=phrase_off[1:])
    phrases = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(phrase_off), pa.py_buffer(raw[spans_of(first, lens)])])
    encoded = phrases.dictionary_encode()
    number, (words, word_off) = encoded.indices.to_numpy().astype(np.int64), buffer_of(encoded.dictionary)
    word_lens = np.diff(word_off)
    in_dictionary = ranks(words, np.repeat(word_off[1:], word_lens), min(k, int(word_lens.max(initial=1))))
    parse_end = np.searchsorted(text, text, "right")
    in_parse = ranks(in_dictionary[word_off[number]], parse_end, k)
    behind = np.append(in_parse[1:], 0)
    behind[last_of] = 0
    phrase = np.searchsorted(first, places, "right") - 1
    inner = places - first[phrase]
    # a suffix of at most a trigger's length stands at its own place in the next phrase, so none is looked up here
    return places[np.lexsort((behind[phrase], in_dictionary[word_off[number[phrase]] + inner]))]


def equal_windows(raw: np.ndarray, a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    """Whether the ``k`` bytes at a and b are equal, some bytes at a time for those still alike."""
    same = np.ones(len(a), bool)
    left = np.arange(len(a))
    for at in range(0, k, 8):
        size = min(8, k - at)
        step = np.arange(at, at + size)
        alike = (raw[a[left][:, None] + step] == raw[b[left][:, None] + step]).all(axis=1)
        same[left[~alike]] = False
        left = left[alike]
    return same


class Rims:
    """Windows of the stretches that are left, with both of their hashes."""

    def __init__(self, c: Chunk, on: np.ndarray):
        self.chunk, self.on = c, on
        self.windows = spans_of(c.start[on], c.n[on])
        self.stretch = np.repeat(np.flatnonzero(on), c.n[on])
        self.key = c.hash.of(self.windows, c.k)
        self.tag = Hashes(c.raw, 1).of(self.windows, c.k) >> U(33)

    def classes(self) -> np.ndarray:
        """Number of each window's class of equal windows, by the suffix order of the bytes that the windows cover."""
        c, on = self.chunk, self.on
        if not len(self.windows):
            return np.zeros(0, np.int64)
        cover = np.zeros(len(c.raw) + 1, np.int64)
        np.add.at(cover, c.start[on], 1)
        np.add.at(cover, c.start[on] + c.n[on] + c.k - 1, -1)
        inside = np.cumsum(cover[:-1]) > 0
        begin = inside & ~np.append(False, inside[:-1])
        edges = c.off[c.off < len(inside)]
        begin[edges] = inside[edges]
        shift = np.cumsum(inside) - 1
        raw, off = c.raw[inside], np.append(shift[begin], inside.sum())
        order = corpus_order(raw, off, c.k, shift[self.windows])
        new = np.append(True, ~equal_windows(raw, order[1:], order[:-1], c.k))
        cls = np.empty(len(raw), np.int64)
        cls[order] = np.cumsum(new) - 1
        return cls[shift[self.windows]]

    def recurring(self, told: pa.Table) -> np.ndarray:
        """Windows whose class recurs."""
        key, _, tag = _answers(told, WINDOW)
        found = np.zeros(len(self.key), bool)
        at, to = np.searchsorted(key, self.key, "left"), np.searchsorted(key, self.key, "right")
        for step in range(int((to - at).max(initial=0))):  # more than one only where first hashes meet
            here = np.flatnonzero(at + step < to)
            found[here] |= tag[at[here] + step] == self.tag[here]
        return found


def _send_rims(k: int, core: int, bins: int):
    def send(texts: pa.Table, told: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return _send_table([])
        c, chunk = Chunk(texts, k, core), texts["chunk"][0].as_py()
        whole, on = settled(c, told)
        r = Rims(c, on)
        cls = r.classes()
        heads = np.unique(cls, return_index=True)[1]  # a window of each class
        # a class recurs if it has two windows here, or one in a stretch that has a copy
        twice = np.bincount(cls, weights=1 + whole[r.stretch], minlength=len(heads)) > 1
        return _send_table(_sent(chunk, bins, WINDOW, r.key[heads], r.tag[heads] << U(1), twice))

    return send


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of sorted ranges, where touching ones are one."""
    if not len(starts):
        return starts, ends
    reach = np.maximum.accumulate(ends)
    new = np.append(True, starts[1:] > reach[:-1])
    return starts[new], reach[np.append(np.flatnonzero(new)[1:], len(starts)) - 1]


def without(text: bytes, starts: list[int], ends: list[int]) -> str:
    """Digest of a text without some ranges, taken run by run."""
    digest, at = hashlib.sha256(), 0
    for a, b in zip(starts, ends):
        digest.update(memoryview(text)[at:a])
        at = b
    digest.update(memoryview(text)[at:])
    return digest.hexdigest()


def _spans(k: int, core: int):
    def spans(texts: pa.Table, told: pa.Table) -> pa.Table:
        c = Chunk(texts, k, core)
        whole, on = settled(c, told)
        r = Rims(c, on)
        hit = r.windows[r.recurring(told)]
        starts, ends = np.append(c.start[whole], hit), np.append(c.start[whole] + c.n[whole], hit + 1) + k - 1
        order = np.argsort(starts, kind="stable")
        starts, ends = starts[order], ends[order]
        out: dict[str, list] = {n: [] for n in ("starts", "ends", "n_bytes", "n_removed", "n_spans", "kept_sha256")}
        raw = c.raw.tobytes()
        several = c.table["n_pieces"].to_pylist()
        for i, (a, b) in enumerate(zip(c.off[:-1], c.off[1:])):
            x, y = np.searchsorted(starts, [a, b])
            s, e = merged(starts[x:y] - a, ends[x:y] - a)
            alone = several[i] == 1
            out["starts"].append(None if alone else s)
            out["ends"].append(None if alone else e)
            out["n_bytes"].append(int(b - a))
            out["n_removed"].append(int((e - s).sum()))
            out["n_spans"].append(len(s))
            out["kept_sha256"].append(without(raw[a:b], s.tolist(), e.tolist()) if alone else None)
        kinds = {"starts": pa.list_(pa.int64()), "ends": pa.list_(pa.int64()), "kept_sha256": pa.string()}
        return pa.table({**{n: c.table[n].cast(pa.int64()) for n in ("doc", "tie", "piece", "n_pieces")}, **{n: pa.array(v, kinds.get(n, pa.int64())) for n, v in out.items()}})

    return spans


# -------------------------------------------------------------- operator ----


def pieces_of(docs: DataFrame, key: str, text: str, k: int, piece: int) -> DataFrame:
    """(doc, tie, piece, n_pieces, text): bytes of texts in pieces that overlap by ``k - 1`` bytes; a window starts in one piece."""
    whole = F.col(text).cast("string")
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.xxhash64(whole).alias("tie"), F.coalesce(whole.cast("binary"), F.lit(b"")).alias("text"))
    rows = rows.withColumn("n_pieces", F.greatest(F.lit(1), F.ceil(F.octet_length("text") / piece)).cast("long"))
    nr = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_pieces") - 1)).alias("piece")
    cut = F.when(F.col("n_pieces") == 1, F.col("text")).otherwise(F.substring("text", (F.col("piece") * piece + 1).cast("int"), F.lit(piece + k - 1)))
    return rows.select("doc", "tie", "n_pieces", "text", nr).select("doc", "tie", "piece", "n_pieces", cut.alias("text"))


def _long_texts(docs: DataFrame, spans: DataFrame, key: str, text: str, piece: int) -> DataFrame:
    """Texts of several pieces, from the ranges that their pieces lose."""
    moved = spans.filter("n_pieces > 1").select("doc", "tie", F.explode(F.arrays_zip(F.transform("starts", lambda s: s + F.col("piece") * piece).alias("s"), F.transform("ends", lambda e: e + F.col("piece") * piece).alias("e"))).alias("x"))
    ranges = moved.groupBy("doc", "tie").agg(F.array_sort(F.collect_set(F.struct(F.col("x.s").alias("s"), F.col("x.e").alias("e")))).alias("ranges"))
    whole = F.col(text).cast("string")
    rows = docs.filter(F.octet_length(whole) > piece).select(F.col(key).cast("long").alias("doc"), F.xxhash64(whole).alias("tie"), whole.cast("binary").alias("text"))
    near = rows.alias("r").join(ranges.alias("g"), F.col("r.doc").eqNullSafe(F.col("g.doc")) & (F.col("r.tie") == F.col("g.tie")), "left")
    return near.select(F.col("r.doc").alias("doc"), F.col("r.tie").alias("tie"), "text", "ranges").mapInArrow(_cut_out, RESULT)


RESULT = "doc long, tie long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cut_out(batches):
    for batch in batches:
        for row in batch.to_pylist():
            given = row["ranges"] or []
            s, e = merged(np.array([x["s"] for x in given], np.int64), np.array([x["e"] for x in given], np.int64))
            values = [row["doc"], row["tie"], len(row["text"]), int((e - s).sum()), len(s)]
            arrays = [pa.array([v], pa.int64()) for v in values] + [pa.array([without(row["text"], s.tolist(), e.tolist())])]
            yield pa.RecordBatch.from_arrays(arrays, ["doc", "tie", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 200, core: int = 97, piece: int = PIECE) -> DataFrame:
    """(doc_id, tie, n_bytes, n_removed, n_spans, kept_sha256) of each row; ``tie`` is the text's hash."""
    if not TRIGGER <= core <= k - TRIGGER + 1:
        raise ValueError("a window of k bytes holds its anchor's trigger and the core behind it")
    spark = docs.sparkSession
    length = F.octet_length(F.col(text).cast("string"))
    size, longest = (x or 0 for x in docs.agg(F.sum(length), F.max(length)).first())
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = max(1, parts, -(-size // CHUNK_BYTES))
    cut = pieces_of(docs, key, text, k, piece)
    chunks = cut.select(F.pmod(F.xxhash64("doc", "tie", "piece"), F.lit(n)).cast("long").alias("chunk"), "*").repartition(parts, "chunk")
    sent = chunks.groupBy("chunk").applyInArrow(_send(k, core, n), SENT)
    told = written(sent.groupBy("bin").applyInArrow(_match, TOLD), "stretches")
    rims = chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(_send_rims(k, core, n), SENT)
    windows = written(rims.groupBy("bin").applyInArrow(_match, TOLD), "windows")
    spans = chunks.groupBy("chunk").cogroup(told.union(windows).groupBy("chunk")).applyInArrow(_spans(k, core), SPANS)
    if longest > piece:
        spans = written(spans, "spans")
        short = spans.filter("n_pieces = 1").select(*[c.split()[0] for c in RESULT.split(", ")])
        found = short.union(_long_texts(docs, spans, key, text, piece))
    else:
        found = spans.select(*[c.split()[0] for c in RESULT.split(", ")])
    return found.withColumnRenamed("doc", "doc_id")
