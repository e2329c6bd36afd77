"""Line dedup by content-defined chunks; DataFrame functions only.

A text is cut at line ends into lines, and into chunks after each line where a rolling
hash over the last ``WINDOW`` line hashes is a multiple of ``divisor``. No boundary follows a chunk's first
line, and a lone last line belongs to the chunk before it, so only a text of one line is a chunk of one line. A boundary
depends on the lines around it (and on boundaries that follow one another without a gap) alone, so inserted lines shift no later chunk. A chunk of
two or more lines that also occurs earlier (in a document with a smaller key, or earlier
in the same one) is removed, after its bytes have been compared with those of the first
occurrence; the first occurrence stays.

Defined cases: a null text stays null and has no lines; an empty text is one empty line;
single-line chunks always stay; rows that share a key are told apart by their text's
hash, and rows equal in both are one occurrence, so none of them removes
another; a null key sorts before all others; other columns, whatever their names, pass
through unchanged (``n_chars``, if there, is the new text's length); an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide.llm.work import written

#: Lines that the rolling hash covers, its base and its modulus.
WINDOW, BASE, MODULUS = 2, 257, 1_000_003
DIVISOR = 3


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 7), 16, 10).cast("long")


def ends_of(hashes: Column, divisor: int) -> Column:
    """Places of the lines that end a chunk."""

    def rolling(i: Column) -> Column:
        total = F.lit(0).cast("long")
        for back in range(WINDOW):
            total = total + F.coalesce(F.get(hashes, i - back), F.lit(0)) * BASE**back
        return F.pmod(F.pmod(total, F.lit(MODULUS)), F.lit(divisor)) == 0

    last = F.size(hashes) - 1
    # a mark for each line, behind one for the text's start; of marks in a row each second one goes
    marks = F.array_join(F.transform(hashes, lambda _, i: F.when(rolling(i), F.lit("1")).otherwise(F.lit("0"))), "")
    left = F.split(F.replace(F.concat(F.lit("1"), marks), F.lit("11"), F.lit("10")), "")
    return _bound(left, lambda m: F.filter(F.sequence(F.lit(0), last), lambda i: (i == last) | ((F.get(m, i + 1) == "1") & (i != last - 1))))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _chunks(text: Column, divisor: int) -> Column:
    """Array of (k, s, e, h): each chunk's number, first and last line, and a hash of its line hashes; null for a null text."""

    def of(hashes: Column) -> Column:
        def chunk(ends: Column) -> Column:
            def part(e: Column, k: Column) -> Column:
                s = F.when(k == 0, F.lit(0)).otherwise(F.get(ends, k - 1) + 1)
                return F.struct(k.alias("k"), s.alias("s"), e.alias("e"), F.xxhash64(F.slice(hashes, s + 1, e - s + 1)).alias("h"))

            return F.transform(ends, part)

        return _bound(ends_of(hashes, divisor), chunk)

    return F.when(text.isNotNull(), _bound(F.transform(_lines(text), line_hash), of))


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _part(lines: Column, s: Column, e: Column) -> Column:
    """Text of a chunk."""
    return F.array_join(F.slice(lines, s + 1, e - s + 1), "\n")


def _between(lines: Column, gone: Column) -> Column:
    """Text of the lines before, between and after sorted chunks."""

    def stretch(i: Column) -> Column:
        s = F.when(i == 0, F.lit(0)).otherwise(F.get(gone, i - 1)["e"] + 1)
        e = F.when(i == F.size(gone), F.size(lines)).otherwise(F.get(gone, i)["s"])
        return F.when(e > s, _part(lines, s, e - 1))  # null where chunks touch: array_join leaves it out

    return F.array_join(F.transform(F.sequence(F.lit(0), F.size(gone)), stretch), "\n")


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (row, doc, tie, text); ``row`` holds the input's columns."""
    whole = F.col(text).cast("string")
    return docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(key).cast("long").alias("doc"), F.xxhash64(whole).alias("tie"), whole.alias("text"))


def with_row(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """What was found joined to its rows; null keys meet."""
    found = found.withColumnsRenamed({"doc": "found_doc", "tie": "found_tie"})
    return docs.join(found, F.col("doc").eqNullSafe(F.col("found_doc")) & (F.col("tie") == F.col("found_tie")), how).drop("found_doc", "found_tie")


def repeated_chunks(docs: DataFrame, divisor: int) -> DataFrame:
    """(doc, tie, removed): the chunks (k, s, e) of each row whose bytes equal those of an earlier occurrence."""
    place = F.struct("doc", "tie", "k")
    many = F.filter(_chunks(F.col("text"), divisor), lambda c: c["e"] > c["s"])
    seen = written(docs.select("doc", "tie", F.explode(many).alias("c")).select("doc", "tie", "c.*"), "chunks")  # no text
    groups = seen.groupBy("h").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter(F.col("first") != F.col("last")).select("h", "first")
    again = seen.join(groups, "h").select("doc", "tie", F.struct("k", "s", "e", "h", (place == F.col("first")).alias("is_first")).alias("c"))
    # a document's repeated chunks meet its text once
    of_doc = again.groupBy("doc", "tie").agg(F.collect_set("c").alias("found"))
    met = with_row(docs.select("doc", "tie", "text"), of_doc, "inner")
    parts = _bound(_lines(F.col("text")), lambda lines: F.transform("found", lambda c: F.struct(c.alias("c"), _part(lines, c["s"], c["e"]).alias("part"))))
    texts = written(met.select("doc", "tie", F.explode(parts).alias("p")).select("doc", "tie", "p.c.*", "p.part"), "parts")
    firsts = texts.filter("is_first").select("h", F.col("part").alias("first_part"))
    # the side of the firsts has one row for each hash, so a hot chunk splits on the other side
    equal = texts.filter(~F.col("is_first")).join(firsts, "h").filter(F.col("part") == F.col("first_part"))
    return equal.groupBy("doc", "tie").agg(F.collect_set(F.struct("k", "s", "e")).alias("removed"))


def remove_repeated_chunks(docs: DataFrame, key: str = "doc_id", text: str = "text", divisor: int = DIVISOR) -> DataFrame:
    """Rows (row, doc, text, removed, kept): the input's row, the chunks taken out, and the text that stays."""
    rows = keyed(docs, key, text)
    joined = with_row(rows, repeated_chunks(rows, divisor), "left")
    kept = _bound(_lines(F.col("text")), lambda lines: _bound(F.array_sort("removed"), lambda gone: _between(lines, gone)))
    return joined.withColumn("kept", F.when(F.col("removed").isNull(), F.col("text")).otherwise(kept))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", divisor: int = DIVISOR) -> DataFrame:
    """``docs`` with the repeated chunks taken out of its texts."""
    out = remove_repeated_chunks(docs, key, text, divisor)

    def column(c: str) -> Column:
        if c == text:
            return F.col("kept").alias(c)
        if c == "n_chars":
            return F.when(F.col("removed").isNull(), F.col("row")[c]).otherwise(F.length("kept")).cast(docs.schema[c].dataType).alias(c)
        return F.col("row")[c].alias(c)

    return out.select(*[column(c) for c in docs.columns])


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", divisor: int = DIVISOR) -> DataFrame:
    """What was removed from each row, and a digest of the text that stays."""
    out = remove_repeated_chunks(docs, key, text, divisor)
    lines = F.aggregate("removed", F.lit(0), lambda a, c: a + c["e"] - c["s"] + 1)
    n_chunks = F.size(_bound(F.transform(_lines(F.col("text")), line_hash), lambda h: ends_of(h, divisor)))

    def number(c: Column) -> Column:
        return F.coalesce(c, F.lit(0)).cast("long")

    return out.select(
        F.col("doc").alias("doc_id"), number(F.when(F.col("text").isNotNull(), F.size(_lines(F.col("text"))))).alias("n_lines"), number(F.when(F.col("text").isNotNull(), n_chunks)).alias("n_chunks"),
        number(F.when(F.col("removed").isNotNull(), F.size("removed"))).alias("n_removed_chunks"), number(lines).alias("n_removed_lines"),
        F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, string_split(text, chr(10)) AS lines FROM documents),
h AS (SELECT *, list_transform(lines, lambda x: ('0x' || substr(md5(x), 1, 7))::BIGINT) AS hs FROM d),
b AS (SELECT *, list_transform(range(1, len(lines) + 1), lambda i: CASE WHEN (hs[i] + {BASE} * (CASE WHEN i > 1 THEN hs[i - 1] ELSE 0 END)) % {MODULUS} % {DIVISOR} = 0 THEN '1' ELSE '0' END) AS marks FROM h),
m2 AS (SELECT *, string_split(replace('1' || array_to_string(marks, ''), '11', '10'), '') AS ok FROM b),
e AS (SELECT *, list_filter(range(1, len(lines) + 1), lambda i: i = len(lines) OR (ok[i + 1] = '1' AND i <> len(lines) - 1)) AS ends FROM m2),
c AS (SELECT doc_id, k, lines[(CASE WHEN k > 1 THEN ends[k - 1] ELSE 0 END) + 1 : ends[k]] AS part FROM e, unnest(range(1, len(ends) + 1)) AS u(k)),
m AS (SELECT *, len(part) > 1 AND row_number() OVER (PARTITION BY part ORDER BY doc_id, k) > 1 AS gone FROM c),
r AS (SELECT doc_id, count(*) FILTER (gone) AS nc, coalesce(sum(len(part)) FILTER (gone), 0) AS nl, count(*) AS n,
  coalesce(string_agg(array_to_string(part, chr(10)), chr(10) ORDER BY k) FILTER (NOT gone), '') AS kept FROM m GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(d.lines), 0)::BIGINT AS n_lines, coalesce(r.n, 0)::BIGINT AS n_chunks, coalesce(r.nc, 0)::BIGINT AS n_removed_chunks,
  coalesce(r.nl, 0)::BIGINT AS n_removed_lines, sha256(CASE WHEN coalesce(r.nc, 0) = 0 THEN d.text ELSE r.kept END) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id)
"""
