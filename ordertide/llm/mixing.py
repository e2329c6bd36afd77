"""Mixing sources to target weights by systematic sampling; DataFrame functions only.

A source's documents stand in one order (by words, then key). Each has the same expected
number of copies, the source's target over its size. Their prefix sum plus one offset
for the source crosses whole numbers, and a document is taken once for each one that it crosses.
The order by words keeps the taken words near the target. Prefix sums are in
whole units of 2^-40 copies: exact, and alike on every run.

Targets: sources in code point order (null last) weigh ``weights`` in turn and share all
words. No target is above ``limit`` times its source's words; what is above is shared
again by weight.

Defined cases: a null or empty text has size 0 and takes 0 words, whatever its copies; a null
source is a source of its own; rows that share a key are rows like any others (ties
are broken by the text's hash; equal rows are interchangeable); other columns are ignored
or carried as they are; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordertide.llm.work import written

WEIGHTS = (5, 2, 1)
LIMIT = 3
UNIT = 1 << 40
SEED = 7


def word_count(text):
    return F.when(text.isNull(), F.lit(0)).otherwise(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """``target`` for each row (name, source_size): one row a source, so windows over them all are small."""
    order = Window.orderBy(F.col("name").isNull(), "name")
    w = F.get(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))))
    # those that stop at their limit are those with the least size for their weight
    least = Window.orderBy(F.col("source_size") / F.col("w"), F.col("name").isNull(), "name")
    before, from_here = least.rowsBetween(Window.unboundedPreceding, -1), least.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    share = (F.sum("source_size").over(every) - limit * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / F.sum("w").over(from_here)
    fits = F.col("share") * F.col("w") <= limit * F.col("source_size")
    return (
        sources.withColumn("w", w)
        .withColumn("share", share)
        .withColumn("at", F.row_number().over(least))
        # of those that have not stopped, the one nearest its limit settles the share
        .withColumn("share", F.min_by("share", F.when(fits, F.col("at"))).over(every))
        .withColumn("target", F.least((limit * F.col("source_size")).cast("double"), F.col("share") * F.col("w")).cast("double"))
        .drop("w", "share", "at")
    )


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT, seed: int = SEED, tie: bool = False) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for each row; with ``tie`` also the text's hash."""
    whole = F.col(text).cast("string")
    rows = written(
        docs.select(
            F.col(key).cast("long").alias("doc"), F.col(source).cast("string").alias("name"), word_count(whole).alias("size"), F.xxhash64(whole).alias("tie"),
        ),
        "sizes",
    )
    named = F.coalesce(F.concat(F.lit("="), "name"), F.lit(""))  # null has a key of its own
    rows = rows.withColumn("of", named)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # neighbours in the order stay together, and a hot source lies in many parts
    parts = written(rows.repartitionByRange(n, "of", "size", "doc", "tie").withColumn("part", F.spark_partition_id()), "ordered")
    counts = parts.groupBy("of", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("of").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("of", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    sources = targets(rows.groupBy("of", "name").agg(F.sum("size").alias("source_size")), weights, limit)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    sources = sources.select(
        "of", "source_size", "target", F.least(F.floor(rate * F.lit(float(UNIT))), F.lit(limit * UNIT)).cast("decimal(18,0)").alias("rate"),
        # 40 bits: a part of one copy
        F.conv(F.substring(F.md5(F.concat(F.lit(str(seed)), "of").cast("binary")), 1, 10), 16, 10).cast("decimal(18,0)").alias("offset"),
    )
    told = offsets.join(sources, "of")  # a row for each source of each part
    place = F.row_number().over(Window.partitionBy("of", "part").orderBy("size", "doc", "tie")) - 1
    ranked = parts.withColumn("place", place).join(told, ["of", "part"])
    at = (F.col("skip") + F.col("place")).cast("decimal(18,0)")
    ranked = ranked.withColumns({"low": F.col("offset") + at * F.col("rate"), "high": F.col("offset") + (at + 1) * F.col("rate")})
    copies = F.expr(f"(high div {UNIT}) - (low div {UNIT})").cast("long")
    out = ranked.withColumn("copies", copies)
    return out.select(
        F.col("doc").alias("doc_id"), F.col("name").alias("source"), "size", F.col("source_size").cast("long").alias("source_size"), "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"), *(["tie"] if tie else []),
    )


def mixture(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; column ``copy`` counts them from 1."""
    told = mixed(docs, key, text, source, tie=True, **options)
    # rows meet what the mix takes of them by key, source and hash, so texts are shuffled once; rows that are alike are numbered
    at = [F.coalesce("doc_id", F.lit(0)), F.col("doc_id").isNull(), F.coalesce("source", F.lit("")), F.col("source").isNull(), F.col("tie")]
    names = ["at0", "at1", "at2", "at3", "at4"]
    told = told.select(*[c.alias(n) for c, n in zip(at, names)], "copies")
    told = told.withColumn("nr", F.row_number().over(Window.partitionBy(*names).orderBy(F.col("copies").desc()))).filter("copies > 0")
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(key).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), F.xxhash64(F.col(text).cast("string")).alias("tie"))
    rows = rows.select("row", *[c.alias(n) for c, n in zip(at, names)]).withColumn("nr", F.row_number().over(Window.partitionBy(*names).orderBy(F.lit(1))))
    taken = rows.join(told, [*names, "nr"]).select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    return taken.select("row.*", "copy") if "copy" not in docs.columns else taken.select("row.*", F.col("copy").alias("mix_copy"))
