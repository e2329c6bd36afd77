"""N-gram Jaccard join as a blocked sparse product of the document by n-gram incidence.

Rows of the incidence are different shingle sets (equal sets are one row). Two linked rows of
sizes a and b differ in at most ``(100 - t) (a + b) / (100 + t)`` columns, so when the columns are
dealt by hash into one block more than that, the rows agree on a whole block. Only rows
that agree on a block are multiplied: a block's digest goes to its bin, bins tell chunks which
digests two rows share, and the chunks give out those rows. Rows that shared blocks connect are one
family, so a row is sent to one product only; blocks of so few shingles that unrelated rows share
them connect families only where counts of shingles by bucket allow some pair to link, and empty blocks are made up for by spare ones. A family is tiled, a tile
accumulates overlap counts over slabs of columns, and pairs below the bound that
follows from their sizes are discarded. A family larger than a tile is first joined
within its tiles; what is not yet connected is then multiplied across them, so a large family of
near copies costs its size times its few stragglers, not its square.

Sizes are put into classes in which the smallest and largest can still link; a row gives the
blocks of its own class and of the next one, so linked rows of neighbouring classes meet.

Shingles are held as 64-bit hashes, of which products compare the upper 48 bits. Equal sets
are known by a 128-bit digest, and bins tell sets apart by 32 bits of it.

Defined cases: a null or empty text, or one without words, has the empty set and is linked with nothing,
so its component is its own key; fewer than ``n`` words are one shingle; a null key never names a
component unless all its members' are null; repeated rows are copies; further
columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.llm.work import by_chunk, chunk_count, pack, plain_texts, unpack, written
from ordertide.llm.words import SPACE, buffer_of, cut, dictionary_hashes, mix, windows, within

SENT, TOLD = "chunk long, bin long, blob binary", "chunk long, blob binary"
ROWS = "doc long, tie long, n_shingles long, cls binary, blocks array<long>, shingles binary, buckets binary"
EDGES = "a binary, b binary"
#: Rows of a tile, and columns of a slab.
TILE, SLAB = 4096, 2048
#: A block with fewer shingles connects no families.
TELLING = 3
U = np.uint64


# ----------------------------------------------------------- size bounds ----


def most_apart(total: int, t: int) -> int:
    """Columns in which two rows of ``total`` shingles together may differ and still link at ``t`` percent."""
    return (100 - t) * total // (100 + t)


def size_classes(largest: int, t: int) -> np.ndarray:
    """First size of each class: a class holds the sizes that can link with its first."""
    first = [1]
    while first[-1] <= largest * 100 // t + 1:
        first.append(first[-1] * 100 // t + 1)
    return np.array(first + [first[-1] * 100 // t + 1], np.int64)


def block_counts(first: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of each size class, and how many of them are spare.

    Rows that differ in d columns agree on all but d blocks. With ``spare`` blocks beyond d + 1 they agree on more
    than ``spare`` of them, so of a row with at most that many empty blocks the empty ones need not be
    compared: another agreeing block is not empty. Spares follow the number of empty blocks that chance leaves.
    """
    need = np.array([most_apart(2 * int(x - 1), t) + 1 for x in first[1:]], np.int64)
    empty = need * np.exp(-first[:-1] / need)
    spare = (empty + 4 * np.sqrt(empty) + 0.5).astype(np.int64)
    return need + spare, spare


# ------------------------------------------------------------- incidence ----


class Incidence:
    """Rows of a chunk: each text's shingle set, and for each different set its column blocks' digests."""

    def __init__(self, table: pa.Table, n: int, t: int):
        table = table.take(pc.sort_indices(table, [("doc", "ascending"), ("tie", "ascending")]))
        self.table = table
        w = cut(*buffer_of(table["text"]), SPACE, lower=True)
        ids, distinct = w.encode()
        h = dictionary_hashes(distinct)[ids]
        count = w.counts
        at = np.flatnonzero(within(w.first, n, len(w)))
        parts, texts = [windows(h, n)[at]], [w.text_of[at]]
        for few in range(1, n):  # the whole of a short text
            short = np.flatnonzero(count == few)
            parts.append(windows(h, few, seed=few)[w.first[short]] if len(short) else np.zeros(0, U))
            texts.append(short)
        value, text = np.concatenate(parts), np.concatenate(texts)
        order = np.lexsort((value, text))
        value, text = value[order], text[order]
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
        self.value, text = value[new], text[new]
        self.size = np.bincount(text, minlength=len(table)).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.size)])
        sums = [np.concatenate([[U(0)], np.cumsum(mix(self.value ^ U(s)))]) for s in (0x51, 0xA7)]
        digest = np.stack([s[self.first[1:]] - s[self.first[:-1]] for s in sums] + [self.size.astype(U)], axis=1)
        self.digest = np.ascontiguousarray(digest[:, :2] + digest[:, 2:] * U(0x9E3779B97F4A7C15))
        _, heads, self.row = np.unique(self.digest, axis=0, return_index=True, return_inverse=True)
        self.row = self.row.reshape(-1)
        self.heads = heads[self.size[heads] > 0]  # one text for each different set
        self.of_head, self.block = self._blocks(t)
        self.tag = (mix(self.digest[:, 0] ^ mix(self.digest[:, 1])) >> U(32)).astype(np.uint32)[self.of_head]  # tells sets apart

    def names(self) -> list[bytes | None]:
        """Name of each text's set; None for the empty one."""
        return [d.tobytes() if s else None for d, s in zip(self.digest, self.size)]

    def _blocks(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, digest) of every block of every different set, for its size class and the next."""
        if not len(self.heads):
            return np.zeros(0, np.int64), np.zeros(0, U)
        first = size_classes(int(self.size.max()), t)
        own = np.searchsorted(first, self.size[self.heads], "right") - 1
        rows, out = [], []
        lens = self.size[self.heads]
        of = np.repeat(np.arange(len(self.heads)), lens)
        begin = np.cumsum(lens) - lens
        value = self.value[np.arange(int(lens.sum())) - np.repeat(begin, lens) + np.repeat(self.first[self.heads], lens)]
        spread, weight = mix(value ^ U(0x1B)), mix(value ^ U(0xE3))
        per_class, spares = block_counts(first, t)
        for tag in (own, own + 1):
            blocks = per_class[tag]
            off = np.cumsum(blocks) - blocks
            total = np.zeros(int(blocks.sum()), U)
            slot = np.repeat(off, lens) + (spread % np.repeat(blocks, lens).astype(U)).astype(np.int64)
            np.add.at(total, slot, weight)
            held = np.bincount(slot, minlength=len(total))
            nr = np.arange(len(total)) - np.repeat(off, blocks)
            name = mix((np.repeat(tag, blocks).astype(U) << U(32)) + nr.astype(U))
            empty = np.add.reduceat((held == 0).astype(np.int64), off)
            said = (held > 0) | np.repeat(empty > spares[tag], blocks)  # empty blocks only of rows with many
            rows.append(np.repeat(self.heads, blocks)[said])
            out.append(((mix(total + name) & ~U(1)) | (held < TELLING).astype(U))[said])  # odd if of few shingles
        return np.concatenate(rows), np.concatenate(out)


def _send(n: int, t: int, bins: int):
    def send(table: pa.Table) -> pa.Table:
        m = Incidence(table, n, t)
        to = (m.block % U(bins)).astype(np.int64)
        order = np.lexsort((m.block, to))
        block, to, tag = m.block[order], to[order], m.tag[order]
        edges = np.append(np.flatnonzero(np.diff(to, prepend=-1)), len(to))
        blobs = [pack(np.diff(block[a:b], prepend=U(0)), tag[a:b]) for a, b in zip(edges[:-1], edges[1:])]
        return pa.table({"chunk": pa.array([table["chunk"][0].as_py()] * len(blobs), pa.int64()), "bin": pa.array(to[edges[:-1]], pa.int64()), "blob": pa.array(blobs, pa.binary())})

    return send


def _shared(table: pa.Table) -> pa.Table:
    """Of a bin, the digests that two different sets gave, for each chunk that gave them; copies of one set do not count."""
    chunks = table["chunk"].to_pylist()
    parts = [unpack(b, U, np.uint32) for b in table["blob"].to_pylist()]
    mine = [np.cumsum(steps) for steps, _ in parts]
    block, tag = np.concatenate(mine), np.concatenate([x for _, x in parts])
    order = np.argsort(block, kind="stable")
    block, tag = block[order], tag[order]
    cuts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    shared = block[cuts[np.minimum.reduceat(tag, cuts) != np.maximum.reduceat(tag, cuts)]]
    out = []
    for chunk, sent in zip(chunks, mine):
        found = sent[np.isin(sent, shared)]
        if len(found):
            out.append((chunk, pack(np.diff(found, prepend=U(0)))))
    return pa.table({"chunk": pa.array([c for c, _ in out], pa.int64()), "blob": pa.array([b for _, b in out], pa.binary())})


def _rows(n: int, t: int):
    def rows(texts: pa.Table, told: pa.Table) -> pa.Table:
        m = Incidence(texts, n, t)
        twice = [np.cumsum(unpack(b, U)[0]) for b in told["blob"].to_pylist()]
        hit = np.isin(m.block, np.concatenate(twice)) if twice else np.zeros(len(m.block), bool)
        count = np.bincount(m.of_head[hit], minlength=len(m.size))
        order = np.argsort(m.of_head[hit], kind="stable")
        off = np.concatenate([[0], np.cumsum(count)])
        blocks = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(m.block[hit][order].view(np.int64)))
        few = np.bincount(m.of_head[hit], weights=m.block[hit] & U(1), minlength=len(m.size))
        # most rows that share blocks of few shingles only link with nothing: their sets are made later, of the few that may
        sets = [squeezed(m.value[a:b]) if c else None for a, b, c in zip(m.first[:-1], m.first[1:], count - few)]
        buckets = [bucketed(m.value[a:b]) if f else None for a, b, f in zip(m.first[:-1], m.first[1:], few)]
        cls = m.names()
        return pa.table({"doc": m.table["doc"], "tie": m.table["tie"], "n_shingles": pa.array(m.size), "cls": pa.array(cls, pa.binary()), "blocks": blocks, "shingles": pa.array(sets, pa.binary()), "buckets": pa.array(buckets, pa.binary())})

    return rows


def _sets(n: int, t: int):
    """Sets of texts one by one, for rows whose chunk gave none."""

    def sets(batches):
        for batch in batches:
            if batch.num_rows:
                m = Incidence(pa.Table.from_batches([batch]), n, t)
                found = [squeezed(m.value[a:b]) for a, b in zip(m.first[:-1], m.first[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(m.names(), pa.binary()), pa.array(found, pa.binary())], ["cls", "shingles"])

    return sets


# ---------------------------------------------------------------- buckets ----


def bucketed(values: np.ndarray) -> bytes:
    """How many shingles fall into each of about an eighth as many buckets, by the upper bits of their hashes."""
    bits = max(0, int(len(values) // 8).bit_length())
    at = (mix(values) >> U(64 - bits)).astype(np.int64) if bits else np.zeros(len(values), np.int64)
    return pack(np.bincount(at, minlength=1 << bits).astype(np.uint32))


def _survive(t: int):
    """Labels of a block's rows that some pair of rows may link: shared shingles are at most the sum of their buckets' lesser counts."""

    def survive(table: pa.Table) -> pa.Table:
        label = dict(zip(table["cls"].to_pylist(), table["label"].to_pylist()))
        counts = dict(zip(table["cls"].to_pylist(), (unpack(b, np.uint32)[0].astype(np.int32) for b in table["buckets"].to_pylist())))
        names = sorted(counts, key=lambda n: (label[n], n))
        least = min(len(c) for c in counts.values())
        flat = np.stack([counts[n].reshape(least, -1).sum(axis=1) for n in names])
        size = flat.sum(axis=1, dtype=np.int64)
        link = np.zeros((len(names), len(names)), bool)
        for i in range(len(names) - 1):
            most = np.minimum(flat[i], flat[i + 1 :]).sum(axis=1, dtype=np.int64)
            link[i, i + 1 :] = 100 * most >= t * (size[i] + size[i + 1 :] - most)
        stars = trees(names, link | link.T, [label[n] for n in names])
        return _edge_table(sorted({(label[a], label[b]) for a, b in stars if label[a] != label[b]}))

    return survive


# --------------------------------------------------------------- product ----


def squeezed(values: np.ndarray) -> bytes:
    """A sorted set by the upper 48 bits of its hashes: steps, byte plane by byte plane, compressed."""
    steps = np.diff(np.unique(values >> U(16)), prepend=U(0))
    return pack(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8)[:, :6].T).reshape(-1))


def spread_out(blob: bytes) -> np.ndarray:
    planes = unpack(blob, np.uint8)[0].reshape(6, -1)
    steps = np.zeros((planes.shape[1], 8), np.uint8)
    steps[:, :6] = planes.T
    return np.cumsum(steps.reshape(-1).view(U))


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Overlap counts of all pairs of a tile's rows: incidence slabs times their transposes, added up."""
    columns, where = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    where = where.reshape(-1)
    kept = np.bincount(where, minlength=len(columns)) > 1  # a column of one row adds to no pair
    row, where = row[kept[where]], (np.cumsum(kept) - 1)[where[kept[where]]]
    order = np.argsort(where, kind="stable")
    row, where = row[order], where[order]
    total = np.zeros((len(sets), len(sets)), np.float32)  # whole numbers below 2**24 are exact
    for at in range(0, int(kept.sum()), SLAB):
        a, b = np.searchsorted(where, [at, at + SLAB])
        slab = np.zeros((len(sets), SLAB), np.float32)
        slab[row[a:b], where[a:b] - at] = 1
        total += slab @ slab.T
    return total


def linked(sets: list[np.ndarray], t: int) -> np.ndarray:
    size = np.array([len(s) for s in sets], np.int64)
    if len(sets) == 2:
        over = np.diag(size)
        over[0, 1] = over[1, 0] = len(np.intersect1d(sets[0], sets[1], assume_unique=True)) if 100 * size.min() >= t * size.max() else 0
    else:
        over = overlaps(sets)
    link = np.zeros((len(sets), len(sets)), bool)
    for at in range(0, len(sets), 256):  # whole-number comparison, some rows at a time
        some = over[at : at + 256].astype(np.int64)
        link[at : at + 256] = 100 * some >= t * (size[at : at + 256, None] + size - some)
    return link


def trees(names: list[bytes], link: np.ndarray, label: list | None = None) -> list[tuple[bytes, bytes]]:
    """Star edges, from the first of the sorted ``names``, that connect what the links connect; rows of one label are connected already."""
    left, edges = np.ones(len(names), bool), []
    alike = np.unique(label, return_inverse=True)[1].reshape(-1) if label else np.arange(len(names))
    for root in range(len(names)):
        if not left[root]:
            continue
        left[root] = False
        ahead = [root]
        while ahead:
            i = ahead.pop()
            near = np.flatnonzero(left & (link[i] | (alike == alike[i])))
            left[near] = False
            ahead += near.tolist()
            edges += [(names[root], names[j]) for j in near.tolist()]
    return edges


def _edge_table(edges: list[tuple[bytes, bytes]]) -> pa.Table:
    return pa.table({"a": pa.array([a for a, _ in edges], pa.binary()), "b": pa.array([b for _, b in edges], pa.binary())})


def _tile(t: int):
    def tile(table: pa.Table) -> pa.Table:
        sets = dict(zip(table["cls"].to_pylist(), table["shingles"].to_pylist()))
        names = sorted(sets)
        return _edge_table(trees(names, linked([spread_out(sets[n]) for n in names], t)))

    return tile


def _across(t: int):
    """Tile of stragglers times other rows; only pairs of different labels are new."""

    def across(table: pa.Table) -> pa.Table:
        sets = dict(zip(table["cls"].to_pylist(), table["shingles"].to_pylist()))
        labels = dict(zip(table["cls"].to_pylist(), table["label"].to_pylist()))
        names = sorted(sets)
        return _edge_table(trees(names, linked([spread_out(sets[n]) for n in names], t), [labels[n] for n in names]))

    return across


def components(held: DataFrame) -> DataFrame:
    """(cls, label): the smallest class that each class is connected to, where a group of ``held`` (cls, grp) connects its classes."""
    # the least class of each group is known before any class has a label
    of_group = written(held.groupBy("grp").agg(F.min("cls").alias("least"), F.max("cls").alias("most")), "groups")
    while True:
        near = written(held.join(of_group, "grp").groupBy("cls").agg(F.min("least").alias("label")), "near")
        # a label's own label is nearer the end
        ahead = near.select(F.col("cls").alias("label"), F.col("label").alias("next"))
        labels = written(near.join(ahead, "label").select("cls", F.least("label", "next").alias("label")), "labels")
        of_group = written(held.join(labels, "cls").groupBy("grp").agg(F.min("label").alias("least"), F.max("label").alias("most")), "groups")
        if of_group.filter("least <> most").isEmpty():  # no group has two labels
            return labels


def _stars(edges: DataFrame) -> DataFrame:
    """Star edges as groups named by their centre."""
    return edges.select(F.explode(F.array("a", "b")).alias("cls"), F.col("a").alias("grp")).distinct()


def sets_of(rows: DataFrame, members: DataFrame, texts: DataFrame, n: int, t: int) -> DataFrame:
    """(cls, shingles) of the members; copies in several chunks give one set more than once."""
    have = rows.filter(F.col("shingles").isNotNull()).select("cls", "shingles")
    lack = members.select("cls").distinct().join(have.select("cls").distinct(), "cls", "left_anti")
    one = rows.select("cls", F.struct("doc", "tie").alias("k")).join(lack, "cls").groupBy("cls").agg(F.min("k").alias("k")).select(F.col("k.doc").alias("d"), F.col("k.tie").alias("t"))
    found = texts.join(one, F.col("doc").eqNullSafe(F.col("d")) & (F.col("tie") == F.col("t")), "left_semi")
    return have.union(found.mapInArrow(_sets(n, t), "cls binary, shingles binary"))


def connected(rows: DataFrame, texts: DataFrame, n: int, t: int, tile: int = TILE) -> DataFrame | None:
    """Labels of the classes that links connect, or None without any."""
    shared = rows.filter(F.size("blocks") > 0).select("cls", F.explode("blocks").alias("block")).distinct()
    groups = shared.groupBy("block").agg(F.count("cls").alias("n")).filter("n > 1").select("block")
    held = written(shared.join(groups, "block"), "held")
    telling = F.col("block").bitwiseAND(F.lit(1)) == 0
    families = components(held.filter(telling).select("cls", F.col("block").alias("grp")))
    # a block of few shingles matters only where it brings two families together
    few = held.filter(~telling).join(families, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    mixed = few.groupBy("block").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count(F.lit(1)).alias("n")).filter("x <> y").select("block", "n")
    few = written(few.join(mixed, "block"), "few")
    # only families that a bound on some pair's overlap lets meet become one; a block too large for that is a product of its own
    counts = rows.filter(F.col("buckets").isNotNull()).select("cls", "buckets").dropDuplicates(["cls"])
    may = few.filter(F.col("n") <= tile).join(counts, "cls").groupBy("block").applyInArrow(_survive(t), EDGES)
    may = written(may.distinct(), "may")
    whole = families.union(may.select(F.explode(F.array("a", "b")).alias("label")).distinct().join(families.select("label").distinct(), "label", "left_anti").select(F.col("label").alias("cls"), "label"))
    if not may.isEmpty():
        joined = components(_stars(may)).select(F.col("cls").alias("label"), F.col("label").alias("joined"))
        whole = whole.join(joined, "label", "left").select("cls", F.coalesce("joined", "label").alias("label"))
    few = few.filter(F.col("n") > tile).select(F.col("block").cast("string").cast("binary").alias("block"), "cls")
    members = whole.select(F.col("label").alias("block"), "cls").union(few)
    sized = members.join(members.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / tile).alias("tiles")), "block")
    members = written(sized.withColumn("tile", F.pmod(F.xxhash64("block", "cls"), F.col("tiles"))), "members")
    if members.isEmpty():
        return None
    sets = sets_of(rows, members, texts, n, t)  # a tile takes each class once
    edges = written(members.select("block", "tile", "cls").join(sets, "cls").groupBy("block", "tile").applyInArrow(_tile(t), EDGES), "links")
    labels = None if edges.isEmpty() else components(_stars(edges))
    large = members.filter("tiles > 1")
    if large.isEmpty():
        return labels
    if labels is not None:
        large = large.join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    else:
        large = large.withColumn("label", F.col("cls"))
    counted = large.groupBy("block", "label").agg(F.count(F.lit(1)).alias("m"))
    main = counted.groupBy("block").agg(F.max(F.struct("m", "label")).alias("most"), F.count(F.lit(1)).alias("labels")).filter("labels > 1").select("block", F.col("most.label").alias("main"))
    apart = written(large.join(main, "block"), "apart")
    if apart.isEmpty():
        return labels
    # each straggler meets every other row of its group: its tile times all of the group's tiles
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
    left = apart.filter("label <> main").select("block", "cls", "label", F.col("tile").alias("x"), every.alias("y"))
    used = left.select("block", "x").distinct()
    right = apart.join(used, "block").select("block", "cls", "label", "x", F.col("tile").alias("y"))
    tiles = left.union(right).distinct().join(sets, "cls").select("block", "x", "y", "cls", "label", "shingles")
    more = tiles.groupBy("block", "x", "y").applyInArrow(_across(t), EDGES)
    return components(_stars(written(more if labels is None else edges.union(more), "links")))


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 3, percent: int = 90, tile: int = TILE) -> DataFrame:
    """(doc_id, tie, n_shingles, component_id) for each row; ``tie`` is the text's hash."""
    texts = plain_texts(docs, key, text)
    bins = chunk_count(texts, "text")
    chunks = by_chunk(texts, bins)
    told = chunks.groupBy("chunk").applyInArrow(_send(n, percent, bins), SENT).groupBy("bin").applyInArrow(_shared, TOLD)
    rows = written(chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(_rows(n, percent), ROWS), "rows")
    labels = connected(rows, texts, n, percent, tile)
    classes = rows.filter(F.col("cls").isNotNull()).groupBy("cls").agg(F.min("doc").alias("least"))
    if labels is None:
        named = classes.select("cls", F.col("least").alias("component"))
    else:
        classes = classes.join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
        named = classes.select("cls", "label").join(classes.groupBy("label").agg(F.min("least").alias("component")), "label").select("cls", "component")
    out = rows.select("doc", "tie", "n_shingles", "cls").join(named, "cls", "left")
    return out.select(F.col("doc").alias("doc_id"), "tie", "n_shingles", F.when(F.col("cls").isNull(), F.col("doc")).otherwise(F.col("component")).alias("component_id"))


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest key (then text hash); rows without a shingle all stay."""
    found = near_copies(docs, key, text, n, percent)
    best = found.filter("n_shingles > 0").groupBy("component_id").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("d"), "tie")).alias("k"))
    best = best.select(F.col("k.d").alias("keep_doc"), F.col("k.tie").alias("keep_tie"))
    whole = F.col(text).cast("string")
    rows = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.coalesce(F.col(key).cast("long"), F.lit(2**63 - 1)).alias("keep_doc"), F.xxhash64(whole).alias("keep_tie"),
        F.coalesce(F.regexp_count(whole, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).alias("words"),
    )
    kept = rows.filter("words > 0").dropDuplicates(["keep_doc", "keep_tie"]).join(best, ["keep_doc", "keep_tie"], "left_semi")
    return kept.select("row.*").union(rows.filter("words = 0").select("row.*"))
