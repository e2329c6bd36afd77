"""Substring dedup by super-k-mer partitioning.

A window is ``k`` consecutive words of one text. Each window has a minimiser, the
smallest hash among its runs of ``m`` words. Consecutive windows with the same
minimiser travel as one packed string of words to the minimiser's bin, so equal
windows of any two texts meet in one bin, where the windows are sorted and counted
on their words. A chunk of texts sends each different packed string once, with its
smallest and largest document, so copies do not pile up in a bin. A bin tells
each chunk the smallest document of every window that repeats, and the chunk removes
the covered words from its texts.

Defined cases: a null or empty text has no words and no windows; a text of fewer
than ``k`` words has no window; rows that share a doc_id are no smaller than
one another, so they never remove each other's words; a null doc_id is larger than any
other; further columns of the input are ignored, whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ordertide.llm.words import SPACE, Words, buffer_of, cut, dictionary_hashes, hashes, mix, windows, within
from ordertide.llm.work import by_chunk, chunk_count, pack, plain_texts, spans_of, unpack

LAST = np.iinfo(np.int64).max
SENT = "chunk long, bin long, blob binary"
TOLD = "chunk long, blob binary"
KEPT = "doc_id long, n_words long, n_removed long, kept_text string, kept_sha256 string"


class Chunk:
    """Words and distinct super-k-mers of a chunk's texts, in the same order whenever it is built."""

    def __init__(self, table: pa.Table, k: int, m: int):
        table = table.take(pc.sort_indices(table, [("doc", "ascending"), ("tie", "ascending")]))
        self.ids = table["doc"]
        self.doc = np.asarray(pc.fill_null(self.ids, LAST).to_numpy(), np.int64)
        self.words = w = cut(*buffer_of(table["text"]), SPACE)
        self.joined, self.at = spaced(w)
        codes, distinct = w.encode()
        runs = windows(dictionary_hashes(distinct)[codes], m)
        ok = within(w.first, k, len(w))
        self.start, self.n, self.minimiser = superkmers(runs, ok, k - m + 1)
        self.text_of = w.text_of
        self.from_doc = self.doc[self.text_of[self.start]]
        lens = self.at[self.start + self.n + k - 1] - self.at[self.start]
        self.code, self.lens = self._distinct(lens)

    def _distinct(self, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact number of each super-k-mer's packed string."""
        off = np.zeros(len(lens) + 1, np.int64)
        np.cumsum(lens, out=off[1:])
        packed = self.joined[spans_of(self.at[self.start], lens)]
        if len(lens) == 0:
            return np.zeros(0, np.int64), lens
        strings = pa.Array.from_buffers(pa.large_binary(), len(lens), [None, pa.py_buffer(off), pa.py_buffer(packed)])
        return strings.dictionary_encode().indices.to_numpy().astype(np.int64), lens


def spaced(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """All words, a space after each, and where each begins (and the end)."""
    n = len(w)
    at = w.off + np.arange(n + 1)
    out = np.full(int(at[-1]), 0x20, np.uint8)
    inside = np.ones(len(out), bool)
    inside[at[1:] - 1] = False
    out[inside] = w.data
    return out, at


def superkmers(runs: np.ndarray, ok: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of windows and minimiser of each maximal run of windows with one minimiser place."""
    n = len(ok)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    best, place = runs[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, width):
        less = runs[j : j + n] < best
        best[less] = runs[j : j + n][less]
        place[less] = j
    place += np.arange(n)
    new = ok.copy()
    new[1:] &= ~(ok[:-1] & (place[1:] == place[:-1]))
    start = np.flatnonzero(new)
    run = np.cumsum(new)[ok] - 1
    return start, np.bincount(run, minlength=len(start)).astype(np.int64), best[start]


def _send(k: int, m: int, bins: int):
    def send(table: pa.Table) -> pa.Table:
        c = Chunk(table, k, m)
        chunk = table["chunk"][0].as_py()
        out: dict[str, list] = {"chunk": [], "bin": [], "blob": []}
        if len(c.start):
            order = np.argsort(c.code, kind="stable")
            heads = order[np.flatnonzero(np.diff(c.code[order], prepend=-1))]  # one place of each string
            cuts = np.flatnonzero(np.diff(c.code[order], prepend=-1))
            low, high = np.minimum.reduceat(c.from_doc[order], cuts), np.maximum.reduceat(c.from_doc[order], cuts)
            to = (mix(c.minimiser[heads]) % np.uint64(bins)).astype(np.int64)
            by_bin = np.argsort(to, kind="stable")
            edges = np.append(np.flatnonzero(np.diff(to[by_bin], prepend=-1)), len(by_bin))
            for a, b in zip(edges[:-1], edges[1:]):
                mine = by_bin[a:b]
                lens = c.lens[heads[mine]]
                text = c.joined[spans_of(c.at[c.start[heads[mine]]], lens)]
                out["chunk"].append(chunk)
                out["bin"].append(int(to[mine[0]]))
                out["blob"].append(pack(c.code[heads[mine]].astype(np.uint32), low[mine], high[mine], lens.astype(np.uint32), text))
        return pa.table({"chunk": pa.array(out["chunk"], pa.int64()), "bin": pa.array(out["bin"], pa.int64()), "blob": pa.array(out["blob"], pa.binary())})

    return send


def _equal(ids: np.ndarray, at: np.ndarray, other: np.ndarray, k: int) -> np.ndarray:
    same = np.ones(len(at), bool)
    for j in range(k):
        same &= ids[at + j] == ids[other + j]
    return same


def sorted_windows(ids: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Order that puts equal windows side by side, and where each different one begins; decided on the words."""
    h = windows(mix(ids.astype(np.uint64) + np.uint64(1)), k)[at]
    order = np.argsort(h, kind="stable")
    new = np.diff(h[order], prepend=0) != 0
    new[:1] = True
    again = np.flatnonzero(~new)
    if len(again) and not _equal(ids, at[order[again]], at[order[again - 1]], k).all():  # two windows of one hash
        rows = np.stack([ids[at + j] for j in range(k)])
        order = np.lexsort(rows[::-1])
        new = np.ones(len(order), bool)
        new[1:] = ~_equal(ids, at[order[1:]], at[order[:-1]], k)
    return order, np.flatnonzero(new)


def _count(k: int):
    def count(table: pa.Table) -> pa.Table:
        chunks, blobs = table["chunk"].to_pylist(), table["blob"].to_pylist()
        parts = [unpack(b, np.uint32, np.int64, np.int64, np.uint32, np.uint8) for b in blobs]
        code, low, high, lens, text = (np.concatenate(x) for x in zip(*parts))
        off = np.zeros(len(lens) + 1, np.int64)
        np.cumsum(lens, out=off[1:])
        w = cut(text, off, SPACE)
        ids, _ = w.encode()
        at = np.flatnonzero(within(w.first, k, len(w)))
        order, cuts = sorted_windows(ids, at, k)
        of = np.searchsorted(w.first, at, "right") - 1  # the super-k-mer that a window is in
        least = np.minimum.reduceat(low[of[order]], cuts)
        smallest = np.empty(len(at), np.int64)
        smallest[order] = np.repeat(least, np.diff(np.append(cuts, len(at))))
        hit = np.flatnonzero(smallest < high[of])
        sender = np.repeat(np.arange(len(chunks)), [len(p[0]) for p in parts])[of[hit]]
        out: dict[str, list] = {"chunk": [], "blob": []}
        edges = np.append(np.flatnonzero(np.diff(sender, prepend=-1)), len(hit))
        for a, b in zip(edges[:-1], edges[1:]):
            x = hit[a:b]
            out["chunk"].append(chunks[sender[a]])
            out["blob"].append(pack(code[of[x]], (at[x] - w.first[of[x]]).astype(np.uint32), smallest[x]))
        return pa.table({"chunk": pa.array(out["chunk"], pa.int64()), "blob": pa.array(out["blob"], pa.binary())})

    return count


def _remove(k: int, m: int):
    def remove(texts: pa.Table, told: pa.Table) -> pa.Table:
        c = Chunk(texts, k, m)
        w = c.words
        cover = np.zeros(len(w) + 1, np.int64)
        order = np.argsort(c.code, kind="stable")
        first = np.searchsorted(c.code[order], np.arange(int(c.code.max()) + 2)) if len(order) else np.zeros(1, np.int64)
        for blob in told["blob"].to_pylist():
            code, shift, smallest = unpack(blob, np.uint32, np.uint32, np.int64)
            n = first[code.astype(np.int64) + 1] - first[code]
            places = order[spans_of(first[code], n)]  # every place of the string that a window is in
            later = np.repeat(smallest, n) < c.from_doc[places]
            starts = (c.start[places] + np.repeat(shift.astype(np.int64), n))[later]
            np.add.at(cover, starts, 1)
            np.add.at(cover, starts + k, -1)
        gone = np.cumsum(cover[:-1]) > 0
        lens = np.diff(c.at)
        kept = np.zeros(len(w) + 1, np.int64)  # bytes kept before each word
        np.cumsum(np.where(gone, 0, lens), out=kept[1:])
        rest = c.joined[np.repeat(~gone, lens)].tobytes()
        removed = np.concatenate([[0], np.cumsum(gone)])
        texts = [rest[a : max(a, b - 1)] for a, b in zip(kept[w.first[:-1]], kept[w.first[1:]])]
        return pa.table({
            "doc_id": c.ids, "n_words": pa.array(w.counts, pa.int64()), "n_removed": pa.array(removed[w.first[1:]] - removed[w.first[:-1]], pa.int64()),
            "kept_text": pa.array(texts, pa.binary()).cast(pa.string()), "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in texts]),
        })

    return remove


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 13, m: int = 3) -> DataFrame:
    """One row per row of ``docs``: its words, how many of them a window covers that also
    starts in a document with a smaller key, and the text of the words that stay."""
    texts = plain_texts(docs, key, text)
    n = chunk_count(texts, "text")
    chunks = by_chunk(texts, n)
    sent = chunks.groupBy("chunk").applyInArrow(_send(k, m, n), SENT)
    told = sent.groupBy("bin").applyInArrow(_count(k), TOLD)
    return chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(_remove(k, m), KEPT)
