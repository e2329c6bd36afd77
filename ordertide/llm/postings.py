"""Benchmark decontamination over a distributed positional inverted index.

Index: texts are cut into shards of bounded size. A shard's row holds, for each different
term of its texts, the sorted places at which it stands, and its directory of documents.

Search: the items' windows (``k`` consecutive words; an item of fewer words is one window)
go to every shard, in blocks of bounded size. In each window the terms are taken from the
rarest (by count over all documents) to the most frequent: the rarest gives the candidate
starts, and each further term's places, moved back by its offset in the window, are
intersected with them. The same intersection with places up to ``slop`` words off gives
proximity matches.

Defined cases: a null or empty text has no words, hits nothing and is not hit; an item whose id is
null counts as the item with the empty id; items of one id count once; repeated documents
are rows of their own; other columns are ignored, whatever their names; with no items every
document is clean; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.llm.words import ALNUM, binary_array, buffer_of, cut, slices
from ordertide.llm.work import CHUNK_BYTES, only, pack, plain_texts, spans_of, unpack, written

INDEX = "shard long, docs binary, terms binary, places binary"
MATCHES = "shard long, nr int, doc_id long, tie long, n_words long, starts array<long>, ends array<long>, items array<string>, near array<string>"
HITS = "doc_id long, tie long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, n_near_items long"
#: Bytes of items that a block sends to every task; further items go in further blocks.
BLOCK_BYTES = 8 << 20
GAP = 64  # free places between documents, so that no tolerance reaches the next one


# ---------------------------------------------------------------- index ----


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    made = 0
    for batch in batches:
        for a, b in slices(batch, batch["text"], CHUNK_BYTES):
            part = batch.slice(a, b - a)
            w = cut(*buffer_of(part["text"]), ALNUM, lower=True)
            ids, terms = w.encode()
            order = np.argsort(ids, kind="stable")
            place = np.arange(len(w)) + GAP * w.text_of
            t, off = buffer_of(terms)
            known = pc.is_valid(part["doc"]).to_numpy(zero_copy_only=False)
            doc = np.asarray(pc.fill_null(part["doc"], 0).to_numpy(zero_copy_only=False), np.int64)
            # a shard's number only has to differ from the others': the index is written once
            shard = (TaskContext.get().partitionId() << 32) + made
            made += 1
            per_term = np.bincount(ids, minlength=len(terms)).astype(np.int32)
            steps = np.diff(place[order], prepend=0).astype(np.int64)
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int64()),
                "docs": pa.array([pack(doc, known.astype(np.uint8), w.counts, part["tie"].to_numpy(zero_copy_only=False))], pa.binary()),
                "terms": pa.array([pack(t, np.diff(off).astype(np.int32), per_term)], pa.binary()),
                "places": pa.array([pack(steps)], pa.binary()),
            })


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The index as a written table (``INDEX``): a row for each shard of about ``CHUNK_BYTES`` of text."""
    return written(plain_texts(docs, key, text).mapInArrow(_index, INDEX), "postings")


class Shard:
    def __init__(self, docs: bytes, terms: bytes, places: bytes | None = None):
        doc, known, self.counts, self.tie = unpack(docs, np.int64, np.uint8, np.int64, np.int64)
        self.doc = [int(d) if k else None for d, k in zip(doc, known)]
        text, lens, self.per_term = unpack(terms, np.uint8, np.int32, np.int32)
        off = np.zeros(len(lens) + 1, np.int64)
        np.cumsum(lens, out=off[1:])
        self.terms = binary_array(text, off)
        if places is not None:
            self.place = np.cumsum(unpack(places, np.int64)[0])
            self.first = np.concatenate([[0], np.cumsum(self.per_term, dtype=np.int64)])
            self.begin = np.cumsum(self.counts) - self.counts + GAP * np.arange(len(self.counts))

    def find(self, terms: pa.Array) -> np.ndarray:
        """Number of each of ``terms`` here, -1 where no text has it."""
        if len(self.terms) == 0 or len(terms) == 0:
            return np.full(len(terms), -1, np.int64)
        return pc.fill_null(pc.index_in(terms, value_set=self.terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)


# --------------------------------------------------------------- search ----


@dataclass
class Phrases:
    """Windows of a block of items, over the block's vocabulary."""

    vocabulary: list[bytes]
    term: np.ndarray  # windows x k; -1 beyond a short item's end
    item: list[str]  # of each window
    order: np.ndarray | None = None  # offsets of each window's terms, rarest first


def phrases_of(items: list[tuple[object, str | None]], k: int) -> Phrases:
    w = cut(*buffer_of(pa.array([t for _, t in items], pa.string())), ALNUM, lower=True)
    ids, terms = w.encode()
    rows: dict[tuple[str, tuple[int, ...]], None] = {}
    for (name, _), a, b in zip(items, w.first[:-1], w.first[1:]):
        for i in range(a, max(a + 1, b - k + 1) if b > a else a):
            rows[("" if name is None else str(name), tuple(ids[i : min(b, i + k)].tolist()))] = None
    term = np.full((len(rows), k), -1, np.int64)
    for i, (_, x) in enumerate(rows):
        term[i, : len(x)] = x
    return Phrases(terms.to_pylist(), term, [name for name, _ in rows])


def _frequency(vocabulary: list[bytes]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = pa.array(vocabulary, pa.large_binary())
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for docs, t in zip(batch["docs"].to_pylist(), batch["terms"].to_pylist()):
                shard = Shard(docs, t)
                at = shard.find(terms)
                total[at >= 0] += shard.per_term[at[at >= 0]]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": pa.array(some, pa.int64()), "n": pa.array(total[some], pa.int64())})

    return count


def rarest_first(index: DataFrame, phrases: Phrases) -> Phrases:
    """Puts each window's terms in order of their count over all documents; the result is as long as the vocabulary."""
    counts = np.zeros(len(phrases.vocabulary), np.int64)
    found = index.select("docs", "terms").mapInArrow(_frequency(phrases.vocabulary), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    for row in found.toLocalIterator():
        counts[row["term"]] = row["n"]
    weight = np.where(phrases.term >= 0, counts[phrases.term], np.iinfo(np.int64).max)  # beyond the end: last
    phrases.order = np.argsort(weight, axis=1, kind="stable")
    return phrases


def _intersect(shard: Shard, p: Phrases, slop: int) -> tuple[np.ndarray, np.ndarray]:
    """(window, place of its first word) of all matches with every term up to ``slop`` words off its offset from the rarest."""
    at = shard.find(pa.array(p.vocabulary, pa.large_binary()))
    length = (p.term >= 0).sum(axis=1)
    there = np.where(p.term >= 0, at[p.term], 0) >= 0
    window = np.flatnonzero(there.all(axis=1) & (length > 0))
    if not len(window):
        return window, np.zeros(0, np.int64)
    rarest = at[p.term[window, p.order[window, 0]]]
    n = shard.per_term[rarest].astype(np.int64)
    start = shard.place[spans_of(shard.first[rarest], n)] - np.repeat(p.order[window, 0], n)
    window = np.repeat(window, n)
    span = int(shard.place.max()) + 2 * GAP + 2
    keys = np.repeat(np.arange(len(shard.per_term)) * span, shard.per_term) + shard.place + GAP
    for j in range(1, p.term.shape[1]):
        more = j < length[window]
        offset = p.order[window, j]
        want = np.where(more, at[p.term[window, offset]], 0) * span + start + offset + GAP
        near = np.minimum(np.searchsorted(keys, want - slop), len(keys) - 1)
        ok = ~more | ((keys[near] >= want - slop) & (keys[near] <= want + slop))
        window, start = window[ok], start[ok]
    return window, start


def _match(p: Phrases, slop: int):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length = (p.term >= 0).sum(axis=1)
        names = np.array(p.item, object)
        for batch in batches:
            for number, docs, terms, places in zip(*(batch[c].to_pylist() for c in ("shard", "docs", "terms", "places"))):
                shard = Shard(docs, terms, places)
                n = len(shard.doc)
                starts, ends, items, near = ([[] for _ in range(n)] for _ in range(4))
                for tolerance, to in ((0, items), (slop, near)):
                    if not p.item or not len(shard.place) or (tolerance == 0 and to is near):
                        continue
                    window, start = _intersect(shard, p, tolerance)
                    rarest = start + (p.order[window, 0] if len(window) else 0)  # always in the document itself
                    of = np.searchsorted(shard.begin, rarest, "right") - 1
                    order = np.lexsort((start, of))
                    for d, w, s in zip(of[order].tolist(), window[order].tolist(), start[order].tolist()):
                        to[d].append(names[w])
                        if to is items:
                            starts[d].append(s - int(shard.begin[d]))
                            ends[d].append(s - int(shard.begin[d]) + int(length[w]))
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([number] * n, pa.int64()), "nr": pa.array(range(n), pa.int32()), "doc_id": pa.array(shard.doc, pa.int64()), "tie": pa.array(shard.tie, pa.int64()), "n_words": pa.array(shard.counts, pa.int64()),
                    "starts": pa.array(starts, pa.list_(pa.int64())), "ends": pa.array(ends, pa.list_(pa.int64())),
                    "items": pa.array([sorted(set(x)) for x in items], pa.list_(pa.string())), "near": pa.array([sorted(set(x) - set(y)) for x, y in zip(near, items)], pa.list_(pa.string())),
                })

    return match


def search(index: DataFrame, items: DataFrame, key: str = "item_id", text: str = "text", k: int = 10, slop: int = 3, block: int = BLOCK_BYTES) -> DataFrame:
    """``MATCHES``: for each document the word spans of exact matches, their items, and the items with proximity matches only."""
    texts = items.select(F.col(key).cast("string").alias("item"), F.col(text).cast("string").alias("text")).filter(F.col("text").isNotNull()).distinct()
    blocks = max(1, -(-(texts.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0) // block))
    found = None
    for i in range(blocks):
        mine = texts.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == i) if blocks > 1 else texts
        phrases = rarest_first(index, phrases_of([tuple(r) for r in mine.toLocalIterator()], k))
        part = index.mapInArrow(_match(phrases, max(0, min(slop, GAP - k - 1))), MATCHES)
        found = part if found is None else found.union(part)
    if blocks == 1:
        return found
    lists = [F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "ends", "items", "near")]
    merged = found.groupBy("shard", "nr").agg(F.first("doc_id").alias("doc_id"), F.first("tie").alias("tie"), F.first("n_words").alias("n_words"), *lists)
    return merged.withColumn("items", F.array_distinct("items")).withColumn("near", F.array_except("near", "items"))


def _covered(starts: list[int], ends: list[int]) -> int:
    """Words in the union of the spans."""
    total, reach = 0, 0
    for a, b in sorted(zip(starts, ends)):
        total += max(0, b - max(a, reach))
        reach = max(reach, b)
    return total


def _hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        items = batch["items"].to_pylist()
        n_hit = [_covered(a, b) for a, b in zip(batch["starts"].to_pylist(), batch["ends"].to_pylist())]
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch["doc_id"], "tie": batch["tie"], "n_words": batch["n_words"], "n_hit": pa.array(n_hit, pa.int64()), "n_items": pa.array([len(x) for x in items], pa.int64()),
            "items_sha256": pa.array([hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items], pa.string()), "contaminated": pa.array([x > 0 for x in n_hit], pa.bool_()),
            "n_near_items": pa.array([len(x) for x in batch["near"].to_pylist()], pa.int64()),
        })


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", k: int = 10, slop: int = 3, block: int = BLOCK_BYTES) -> DataFrame:
    """One row (``HITS``) for each row of ``docs``; ``tie`` is its text's hash."""
    return search(build_index(docs, key, text), items, item, item_text, k, slop, block).mapInArrow(_hits, HITS)


def clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that no window of an item occurs in."""
    return only(docs, key, text, contamination(docs, items, key, text, **options).filter("NOT contaminated").select(F.col("doc_id").alias("doc"), "tie"))
