"""Spelling variants by dense prefix-suffix tiling.

Words are counted by Spark. Two words are near if one inserted, deleted or replaced code point
makes them equal; then their common prefix and common suffix together reach the longer
length minus one. Words are compared densely, block against block, on matrices of code points padded from
the left and from the right. A block holds the words that agree outside one short segment: an edit lies
in one segment of the shorter word, so two near words share the block of that segment, and blocks stay
small however many words there are (a segment is two code points wide, wider only beyond 128 code points).
Of the blocks that a pair shares, the one in which its common prefix ends reports it, so no pair is counted twice.
A word's near words are added up as (count, best), never listed.

A word's form is its near word of largest count (ties: smallest in code-point order) if that is at
least ``ratio`` times its own; roots follow forms to the end by pointer doubling, whose number of rounds
is bounded as counts grow ``ratio``-fold with every step.

Defined cases: a null or empty text has no words; a null key counts as an empty string in the damage;
repeated rows count again; further columns are ignored, whatever their names; an empty table gives an
empty result; runs of any length are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.llm.work import written

#: Letters of a word, and its least length and count.
LETTERS = r"A-Za-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT, RATIO = 7, 2, 10
#: One in so many runs loses a code point.
DAMAGE = 31
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Width of a segment, and most segments of a word.
SEGMENT, SEGMENTS = 2, 64
#: Rows that are held, and cells of a padded matrix that are compared at a time.
ROWS, CELLS = 1 << 18, 1 << 22

NEAR = "word string, n_near long, best_n long, best string"


# ----------------------------------------------------------------- words ----


def damaged_words(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_LENGTH, damage: int = DAMAGE) -> DataFrame:
    """(word) for each run of at least ``least`` letters; one run in ``damage`` lacks the code point that its checksum names."""
    whole = F.translate(F.col(text).cast("string"), UPPER, UPPER.lower())
    runs = F.regexp_extract_all(whole, F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))  # runs that are shorter give no word
    rows = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("d"), F.explode(runs).alias("run"))
    h = F.crc32(F.concat("d", F.lit(":"), "run").cast("binary"))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return rows.withColumn("h", h).select(F.when(F.col("h") % damage == 0, less).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least: int = LEAST_LENGTH, count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): distinct words of at least ``least`` code points that occur ``count`` times or more."""
    return words.filter(F.length("word") >= least).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= count)


# ---------------------------------------------------------------- blocks ----


def width_of(length):
    """Width of the segments of words of a length (column or number)."""
    if isinstance(length, int):
        return max(SEGMENT, -(-length // SEGMENTS))
    return F.greatest(F.lit(SEGMENT), F.ceil(length / SEGMENTS)).cast("int")


def blocks(words: DataFrame) -> DataFrame:
    """(class, segment, block, word, n): each word in the blocks of its own length, and of the length below as the longer one."""
    own = words.select("word", "n", F.explode(F.array(F.lit(0), F.lit(1))).alias("longer")).withColumn("class", F.length("word") - F.col("longer"))
    own = own.filter("class > 0").withColumn("width", width_of(F.col("class")))
    cut = own.withColumn("segment", F.explode(F.sequence(F.lit(0), F.floor((F.col("class") - 1) / F.col("width")).cast("int"))))
    start = F.col("segment") * F.col("width")
    end = F.least(start + F.col("width"), F.col("class")) + F.col("longer")
    outside = F.xxhash64(F.lit("left"), F.substring("word", F.lit(1), start), F.lit("right"), F.substring("word", end + 1, F.length("word")))
    return cut.select("class", "segment", outside.alias("block"), "longer", "word", "n")


# ---------------------------------------------------------------- tiling ----


def _padded(flat: np.ndarray, start: np.ndarray, lens: np.ndarray, width: int, right: bool) -> np.ndarray:
    """Rows of code points, padded with zeros to ``width`` at their end (or at their start)."""
    place = np.arange(width)[None, :] - ((width - lens)[:, None] if right else 0)
    inside = (place >= 0) & (place < lens[:, None])
    return np.where(inside, flat[np.where(inside, start[:, None] + place, 0)], 0)


def _alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Columns in which rows agree before they first differ."""
    differ = a != b
    return np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])


def single_edits(flat: np.ndarray, off: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the pairs (x, y) of different words are one edit apart, and their common prefixes."""
    lens = np.diff(off)
    near, prefix = np.zeros(len(x), bool), np.zeros(len(x), np.int64)
    at = 0
    while at < len(x):
        width = int(max(lens[x[at : at + 4096]].max(), lens[y[at : at + 4096]].max()))
        to = at + max(1, min(4096, CELLS // max(1, width)))
        i, j = x[at:to], y[at:to]
        shorter, longer = np.minimum(lens[i], lens[j]), np.maximum(lens[i], lens[j])
        head = np.minimum(_alike(_padded(flat, off[i], lens[i], width, False), _padded(flat, off[j], lens[j], width, False)), shorter)
        tail = np.minimum(_alike(_padded(flat, off[i], lens[i], width, True)[:, ::-1], _padded(flat, off[j], lens[j], width, True)[:, ::-1]), shorter)
        near[at:to] = head + tail >= longer - 1
        prefix[at:to] = head
        at = to
    return near, prefix


def _pairs(new: np.ndarray, longer: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Diagonals of the blocks' pair matrices: rows and the rows so many places on in their block; the longer words are last and meet none."""
    first = np.flatnonzero(new)
    left = np.repeat(np.append(first[1:], len(new)), np.diff(np.append(first, len(new)))) - np.arange(len(new)) - 1
    rows = np.flatnonzero((left > 0) & ~longer)
    shift = 1
    while len(rows):
        yield rows, rows + shift
        shift += 1
        rows = rows[left[rows] >= shift]


def _best(word: pa.Array, n: np.ndarray, of: np.ndarray, near: np.ndarray) -> pa.RecordBatch:
    """(count, best near word) of each row's word."""
    codes = word.dictionary_encode()
    mine = codes.indices.to_numpy()
    rank = np.empty(len(codes.dictionary), np.int64)
    rank[np.array(pa.compute.sort_indices(codes.dictionary.cast(pa.binary())))] = np.arange(len(rank))
    order = np.lexsort((rank[mine[near]], -n[near], mine[of]))
    heads = np.flatnonzero(np.diff(mine[of][order], prepend=-1))
    counts = np.diff(np.append(heads, len(order)))
    first = order[heads]
    return pa.RecordBatch.from_arrays([word.take(pa.array(of[first])), pa.array(counts, pa.int64()), pa.array(n[near[first]]), word.take(pa.array(near[first]))], ["word", "n_near", "best_n", "best"])


def _tile(table: pa.Table) -> pa.RecordBatch | None:
    """Whole blocks, sorted."""
    word = table["word"].combine_chunks()
    word = word.chunk(0) if isinstance(word, pa.ChunkedArray) else word
    cls, segment, block = (table[c].to_numpy() for c in ("class", "segment", "block"))
    longer, n = table["longer"].to_numpy() == 1, table["n"].to_numpy()
    new = np.ones(len(cls), bool)
    new[1:] = (cls[1:] != cls[:-1]) | (segment[1:] != segment[:-1]) | (block[1:] != block[:-1])
    alone = new & np.append(new[1:], True)
    at = np.flatnonzero(~alone)
    if not len(at):
        return None
    word, cls, segment, longer, n, new = word.take(pa.array(at)), cls[at], segment[at], longer[at], n[at], new[at]
    flat = np.frombuffer("".join(word.to_pylist()).encode("utf-32-le"), np.uint32)
    off = np.concatenate([[0], np.cumsum(pa.compute.utf8_length(word).to_numpy())])
    xs, ys = [], []
    for x, y in _pairs(new, longer):
        near, prefix = single_edits(flat, off, x, y)
        width = np.maximum(SEGMENT, -(-cls[x] // SEGMENTS))
        here = near & (np.minimum(prefix // width, (cls[x] - 1) // width) == segment[x])
        xs.append(x[here])
        ys.append(y[here])
    x, y = np.concatenate(xs), np.concatenate(ys)
    if not len(x):
        return None
    return _best(word, n, np.concatenate([x, y]), np.concatenate([y, x]))


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows, some whole blocks at a time."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < ROWS:
            continue
        table = pa.Table.from_batches(held)
        ids = np.stack([table[c].to_numpy().astype(np.int64) for c in ("class", "segment", "block")])
        last = int(np.flatnonzero((ids != ids[:, -1:]).any(axis=0))[-1]) + 1 if (ids != ids[:, -1:]).any() else 0
        done = _tile(table.slice(0, last)) if last else None
        if done is not None:
            yield done
        held = table.slice(last).to_batches()
        rows = table.num_rows - last
    if rows:
        done = _tile(pa.Table.from_batches(held))
        if done is not None:
            yield done


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of the words that have near ones."""
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = blocks(words).repartition(parts, "class", "segment", "block").sortWithinPartitions("class", "segment", "block", "longer")
    some = dealt.mapInArrow(_tiles, NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("best")))
    return some.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.minus")).alias("best_n"), F.col("b.best").alias("best"))


# ----------------------------------------------------------------- roots ----


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the end. ``forms`` (word, form) has no circle, as counts grow."""
    at = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = written(at.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if moved.filter("moved").isEmpty():
            return moved.select("word", "root")
        at = moved.select("word", "root")


def grouped(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each row of ``words`` (word, n)."""
    words = written(words, "words")
    near = words.join(neighbours(words), "word", "left")
    of = F.col("best_n") >= F.col("n") * ratio
    found = written(near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(of, F.col("best")).alias("form"), F.when(of, F.col("best_n")).alias("form_n")), "forms")
    ends = roots(found.filter("form is not null"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_LENGTH, count: int = LEAST_COUNT, ratio: int = RATIO, damage: int = DAMAGE) -> DataFrame:
    """Spelling variants among the words of all documents."""
    return grouped(vocabulary(damaged_words(docs, key, text, least, damage), least, count), ratio)
