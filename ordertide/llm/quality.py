"""Quality rules by distribution divergence.

Each text has counts of words, symbols, repeated lines and repeated 3-word windows, a
histogram of its characters over fixed classes and a histogram of its words over the
common words of its language (and all others). A language's references are the summed histograms
of all its texts that pass the base rules. A text is rejected when the base rules fail,
or when it is long enough for a verdict and its Jensen-Shannon distance (root of the base-2
divergence) from a reference is above a limit. A language is told by its tag without case
and region (``EN`` and ``en-US`` are ``en``); a script in the tag stays. Languages without a list of common words
are judged by their own reference of characters alone, if enough of their texts pass the base rules.

Defined cases: a null or empty text has no words, so it fails the base rules; a null or empty language, or one
that stands for none or several, has no reference and gives no divergence verdict; nor does a listed language without a
text that passes or an unlisted one with few; a text under the length guards gets none either; repeated rows are
judged alike; other columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide.llm.words import SPACE, Words, _mapped, binary_array, buffer_of, cut, slices
from ordertide.llm.work import CHUNK_BYTES, only, written

#: Frequent words of each listed language.
COMMON = {
    "en": "the of and to in is for on with that this as are be by it from at was an or a he she they not have you we his".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an er so aus bei nach wie".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec ou son aux".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si".split(),
}
#: Tags that name no single language.
NO_LANGUAGE = ("", "und", "mul", "mis", "zxx")
SYMBOLS = b"#*$%&|<>"
#: Character classes: the bytes of each; bytes that continue a code point are of none.
CLASSES = {
    "lower": bytes(range(0x61, 0x7B)), "upper": bytes(range(0x41, 0x5B)), "digit": bytes(range(0x30, 0x3A)), "space": bytes([0x20, *range(0x09, 0x0E)]),
    "symbol": SYMBOLS, "mark": bytes(set(range(0x21, 0x7F)) - set(range(0x30, 0x3A)) - set(range(0x41, 0x5B)) - set(range(0x61, 0x7B)) - set(SYMBOLS)),
    "control": bytes([*range(0x09), *range(0x0E, 0x20), 0x7F]), "beyond": bytes(range(0xC0, 0x100)),
}
#: Base rules.
LEAST_WORDS, MOST_REPEATED = 50, 50
#: A divergence verdict needs so many characters (words) and a distance above the limit.
GUARD_CHARS, LIMIT_CHARS = 400, 0.30
GUARD_WORDS, LIMIT_WORDS = 100, 0.31
#: An unlisted language has a reference when so many of its texts pass the base rules.
GUARD_TEXTS = 30

FEATURES = "doc_id long, tie long, ref string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, chars array<long>, words array<long>"


def _table(members: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(members)] = True
    return t


def _per_text(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return np.diff(total[off])


def _codes(values: np.ndarray) -> tuple[np.ndarray, int]:
    codes, distinct = pd.factorize(values)
    return codes.astype(np.int64), len(distinct)


def repeated_lines(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Of each text, lines with a word that equal an earlier line."""
    n = len(off) - 1
    breaks = np.flatnonzero(raw == 0x0A)
    at = np.concatenate([off[1:] * 2, breaks * 2 + 1])  # a text's end comes before a break at the same place
    order = np.argsort(at, kind="stable")
    is_break = (order >= n).astype(np.int64)
    place = at[order] // 2
    gone = np.cumsum(is_break) - is_break
    line_off = np.concatenate([[0], place - gone])
    of = np.cumsum(1 - is_break) - (1 - is_break)
    wordy = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(_mapped(raw, ~SPACE), out=wordy[1:])
    begin = np.concatenate([[0], place[:-1] + is_break[:-1]])
    some = wordy[place] > wordy[begin]
    lines = binary_array(raw[raw != 0x0A], line_off).filter(pa.array(some)).dictionary_encode()
    ids, of = lines.indices.to_numpy(zero_copy_only=False).astype(np.int64), of[some]
    again = pd.Series(of * max(1, len(lines.dictionary)) + ids).duplicated().to_numpy()
    return np.bincount(of[again], minlength=n)


def repeated_words(w: Words, ids: np.ndarray, n_ids: int, k: int = 3) -> np.ndarray:
    """Of each text, words in k-word windows that occur in it twice or more."""
    n, out = len(w.first) - 1, np.zeros(len(w.first) - 1, np.int64)
    if len(w) < k:
        return out
    of = w.text_of
    codes = ids.astype(np.int64)
    for j in range(1, k):
        codes, _ = _codes(codes[:-1] * n_ids + ids[j:])
    inside = of[: len(codes)] == of[k - 1 :]
    start = np.flatnonzero(inside)
    keys, many = _codes(of[start] * (int(codes.max()) + 1) + codes[start])
    start = start[np.bincount(keys, minlength=many)[keys] > 1]
    cover = np.zeros(len(w) + 1, np.int64)
    np.add.at(cover, start, 1)
    np.add.at(cover, start + k, -1)
    return np.bincount(of[np.cumsum(cover[:-1]) > 0], minlength=n)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = sorted({x for words in COMMON.values() for x in words})
    column = {x: i for i, x in enumerate(known)}
    lists = {lang: [column[x] for x in words] for lang, words in COMMON.items()}
    for batch in batches:
        for a, b in slices(batch, batch["text"], CHUNK_BYTES):
            part = batch.slice(a, b - a)
            raw, off = buffer_of(part["text"])
            n = len(part)
            w = cut(raw, off, SPACE)
            ids, distinct = w.encode()
            bare = pc.ascii_rtrim(pc.ascii_lower(distinct.cast(pa.large_string())), ".,;:!?")
            common = pc.fill_null(pc.index_in(bare, value_set=pa.array(known, pa.large_string())), -1).to_numpy(zero_copy_only=False)
            code = common[ids].astype(np.int64)
            has = code >= 0
            counts = np.bincount(w.text_of[has] * len(known) + code[has], minlength=n * len(known)).reshape(n, len(known))
            classes = np.stack([_per_text(_mapped(raw, _table(x)), off) for x in CLASSES.values()], axis=1)
            leads = _per_text((w.data & 0xC0) != 0x80, w.off[w.first])
            refs = part["ref"].to_pylist()
            words = []
            for d, ref in enumerate(refs):
                mine = counts[d, lists[ref]] if ref in lists else np.zeros(0, np.int64)
                words.append([*mine.tolist(), int(w.counts[d] - mine.sum())])
            yield pa.RecordBatch.from_pydict({
                "doc_id": part["doc"], "tie": part["tie"], "ref": pa.array(refs, pa.string()), "n_words": pa.array(w.counts, pa.int64()), "word_chars": pa.array(leads, pa.int64()),
                "n_symbols": pa.array(classes[:, list(CLASSES).index("symbol")], pa.int64()), "n_dup_lines": pa.array(repeated_lines(raw, off), pa.int64()),
                "n_repeat_words": pa.array(repeated_words(w, ids, max(1, len(distinct))), pa.int64()),
                "chars": pa.array(classes.tolist(), pa.list_(pa.int64())), "words": pa.array(words, pa.list_(pa.int64())),
            })


def reference_of(lang: Column) -> Column:
    """The language whose reference a text has: its tag in lower case without region and variants, with a script if one is named; null for none."""
    parts = F.split(F.regexp_replace(F.lower(F.trim(lang)), "[.@].*$", ""), "[-_]")
    name = F.get(parts, 0)
    script = F.get(F.filter(F.slice(parts, 2, 1 << 20), lambda x: x.rlike("^[a-z]{4}$")), 0)
    plain = script.isNull() | (name.isin(*COMMON) & (script == "latn"))
    return F.when(~name.isin(*NO_LANGUAGE), F.when(plain, name).otherwise(F.concat_ws("-", name, script)))


def features(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    whole = F.col(text).cast("string")
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.xxhash64(whole).alias("tie"), whole.alias("text"), reference_of(F.col(lang).cast("string")).alias("ref"))
    return rows.mapInArrow(_features, FEATURES)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)


def js_distance(counts: Column, reference: Column) -> Column:
    """Root of the base-2 Jensen-Shannon divergence of two count arrays of one length; null if either is empty."""

    def shares(c: Column) -> Column:
        return F.transform(c, lambda x: x / F.when(_total(c) > 0, _total(c)).cast("double"))

    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)

    terms = F.zip_with(shares(counts), shares(reference), lambda x, y: (part(x, y) + part(y, x)) / 2)
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x)))


def references(found: DataFrame) -> DataFrame:
    """Summed histograms of the texts that pass the base rules: a row for each listed language, and for each other of which enough pass."""
    good = found.filter(~base_failed() & F.col("ref").isNotNull())
    summed = []
    for name in ("chars", "words"):
        at = good.select("ref", F.posexplode(name).alias("i", "n")).groupBy("ref", "i").agg(F.sum("n").alias("n"), F.count("*").alias("texts"))
        ordered = F.transform(F.array_sort(F.collect_list(F.struct("i", "n"))), lambda x: x["n"])
        enough = F.col("ref").isin(*COMMON) | (F.max("texts") >= GUARD_TEXTS)
        summed.append(at.groupBy("ref").agg(ordered.alias(f"ref_{name}"), enough.alias("enough")).filter("enough").drop("enough"))
    return summed[0].join(summed[1], "ref")


def judged(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row for each row of ``docs``: its counts, distances and verdict; ``tie`` is its text's hash."""
    found = written(features(docs, key, text, lang), "features")
    # as a table, the references' size is known: a few languages are sent to the texts, others are joined
    told = found.join(written(references(found), "references"), "ref", "left").withColumns({
        "char_distance": F.when((_total(F.col("chars")) >= GUARD_CHARS) & F.col("ref_chars").isNotNull(), js_distance(F.col("chars"), F.col("ref_chars"))),
        "word_distance": F.when((F.col("n_words") >= GUARD_WORDS) & F.col("ref").isin(*COMMON) & F.col("ref_words").isNotNull(), js_distance(F.col("words"), F.col("ref_words"))),
        "base_failed": base_failed(),
    })
    far = F.coalesce(F.col("char_distance") > LIMIT_CHARS, F.lit(False)) | F.coalesce(F.col("word_distance") > LIMIT_WORDS, F.lit(False))
    return told.withColumn("kept", ~F.col("base_failed") & ~far).select(
        "doc_id", "tie", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "char_distance", "word_distance"
    )


def accepted(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that the rules keep."""
    return only(docs, key, text, judged(docs, key, text, lang).filter("kept").select(F.col("doc_id").alias("doc"), "tie"))
