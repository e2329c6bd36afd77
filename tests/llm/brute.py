"""Plain restatements of the operators' contracts, one text at a time."""

import hashlib
import random
import re
from collections import Counter

CLASHING = ["doc", "tie", "row", "chunk", "h", "k", "kept", "lines", "words", "size", "of", "part", "payload", "main", "host"]


def with_clashing_columns(df):
    """The table with further columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING) if c not in df.columns])


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def hits(docs, items, k=10):
    windows = {}
    for i, t in items:
        w = plain_words(t)
        for x in [tuple(w)] if 0 < len(w) < k else [tuple(w[j : j + k]) for j in range(len(w) - k + 1)]:
            windows.setdefault(x, set()).add("" if i is None else str(i))
    out = []
    for d, t in docs:
        w = plain_words(t)
        hit, found = [False] * len(w), set()
        for n in {len(x) for x in windows}:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in windows:
                    found |= windows[tuple(w[j : j + n])]
                    hit[j : j + n] = [True] * n
        out.append((d, len(w), sum(hit), len(found), sha(",".join(sorted(found))), any(hit)))
    return sorted(out, key=str)


def repeats(rows, k=13):
    last = 2**63 - 1
    first = {}
    split = [(last if d is None else d, d, words(t)) for d, t in rows]
    for n, _, w in split:
        for i in range(len(w) - k + 1):
            first[tuple(w[i : i + k])] = min(first.get(tuple(w[i : i + k]), n), n)
    out = []
    for n, d, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - k + 1):
            if first[tuple(w[i : i + k])] < n:
                gone[i : i + k] = [True] * k
        out.append((d, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return sorted(out, key=str)


def shingles(text, n):
    w = words(lower(text))
    return frozenset([tuple(w)] if 0 < len(w) < n else [tuple(w[i : i + n]) for i in range(len(w) - n + 1)])


def groups(rows, n=3, percent=90):
    """(key, set size, component) of each row."""
    sets = [shingles(t, n) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return [(d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)]


def quality(text):
    text = text or ""
    w, seen, dup = words(text), set(), 0
    for line in text.split("\n"):
        dup += bool(words(line)) and line in seen
        seen.add(line)
    count = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    again = {i + j for i in range(len(w) - 2) if count[tuple(w[i : i + 3])] > 1 for j in range(3)}
    failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(again), failed)


def chunks(text):
    lines = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:7], 16) for x in lines]
    out, now = [], []
    for i, line in enumerate(lines):
        now.append(line)
        if len(now) > 1 and (h[i] + 257 * (h[i - 1] if i else 0)) % 1_000_003 % 3 == 0:
            out.append(now)
            now = []
    if len(now) == 1 and out:
        out[-1] += now
    elif now:
        out.append(now)
    return out


def without_repeated_chunks(rows):
    """Texts of rows with different keys, in key order."""
    seen, out = set(), {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        if t is None:
            out[d] = None
            continue
        keep = []
        for c in chunks(t):
            if len(c) > 1 and tuple(c) in seen:
                continue
            seen.add(tuple(c))
            keep += c
        out[d] = "\n".join(keep)
    return out


def family(r: random.Random, size, edits=3):
    """Near copies of texts, some of them exact."""
    rows = []
    for _ in range(size):
        base = [r.choice("abcdefghijklmnopqrstuvwxyz") + r.choice("abcdef") for _ in range(r.choice([0, 1, 2, 3, 4, 10, 11, 12, 30, 60, 90]))]
        for _ in range(r.randrange(1, 9)):
            b = list(base)
            for _ in range(r.randrange(edits + 1)):
                if b:
                    b[r.choice([0, -1, r.randrange(len(b))])] = r.choice("xyz")
            rows.append((r.choice([len(rows), len(rows), len(rows), None]), r.choice([" ", "\n "]).join(b) if r.random() < 0.95 else None))
    return rows
