"""Personal data: base expressions, and contextual bootstrapping from them; DataFrame functions only.

Base entities (e-mail, IP, card, phone) are found by expression and check. They are the
seeds. The words around a span are its lexical patterns: the two words before it, and the word
before with the word after. Spans that may be identifiers (words with a digit or an ``@``) and
their patterns make a bipartite graph of values and patterns. Each round scores a pattern by the
confidence of its values, out of all values it goes with, and a value by the patterns that vouch
for it. Values that are not base entities but that confident patterns vouch for are added
with the pattern's kind. Base spans always stay as they are.

Places are code points from the text's start, end exclusive.

Spans are held against one another and against the text's words by bisection, so work grows with a text's
length, whatever it holds. A run of more than ``LONGEST`` code points without white space is no word of a pattern.

Defined cases: a null or empty text has no spans; further columns are ignored, whatever
their names; repeated rows get equal spans; of several kinds that vouch for a span the
most confident wins, then the first as listed; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide.llm.work import written

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "A-Za-z0-9._%+-"
#: The given expressions, anchored where a leftmost match can start and possessive, so that long runs are
#: read once: an e-mail starts a run of its characters or follows the last match, a number starts its run. Numbers
#: look back after their first digit, so other characters cost one comparison.
EXPRESSIONS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9](?<![0-9]{2})[0-9]*+(?:\.[0-9]++){3}",
    "card": r"[0-9](?<![0-9]{2})(?<![0-9][ -][0-9])(?=(?:[ -]?[0-9]){11})[0-9]*+(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must contain for a match, looked for first: most texts have none.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){11}", "phone": r"\+[0-9]"}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
#: Words that may be identifiers.
MAYBE = "[0-9@]"
CANDIDATE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
#: Longer values are known by their digest.
SHORT = 64
#: A run without white space of more code points is no word of a context: such words would be read again for each span in them.
LONGEST = 1 << 14
RUN = rf"[^\x20\x09-\x0D]{{1,{LONGEST}}}+"
#: Rounds, least seeds and score of a pattern, least score of an added value.
ROUNDS, LEAST_SEEDS, LEAST_PATTERN, LEAST_VALUE = 3, 3, 0.6, 0.8
#: Elements that a prefix sum adds one by one, and how often blocks are put in blocks.
BLOCK_BITS, LEVELS = 5, 2
BLOCK = 1 << BLOCK_BITS


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def starts_of(lengths: Column, levels: int = LEVELS) -> Column:
    """Sum of all earlier elements, for each element; by blocks, and blocks of blocks, so that long arrays stay cheap."""
    if not levels:
        return F.transform(lengths, lambda _, i: _sum(F.slice(lengths, F.lit(1), i)))
    blocks = F.transform(F.sequence(F.lit(0), ((F.size(lengths) - 1) / BLOCK).cast("int")), lambda b: _sum(F.slice(lengths, b * BLOCK + 1, BLOCK)))

    def each(skip: Column) -> Column:
        def start(_: Column, i: Column) -> Column:
            b = F.shiftright(i, BLOCK_BITS)
            return F.get(skip, b) + _sum(F.slice(lengths, b * BLOCK + 1, i - b * BLOCK))

        return F.transform(lengths, start)

    return bound(bound(blocks, lambda sums: starts_of(sums, levels - 1)), each)


def matches(text: Column, expression: str) -> Column:
    """Array of (start, end, value) of the leftmost non-overlapping matches."""
    pattern = F.lit(expression)

    def located(found: Column) -> Column:
        def placed(gaps: Column) -> Column:
            # a gap and the match after it make a step
            steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, m: F.length(g) + F.length(m))
            return bound(steps, lambda n: bound(starts_of(n), lambda s: F.transform(found, lambda m, i: F.struct((F.get(s, i) + F.length(F.get(gaps, i))).alias("start"), (F.get(s, i) + F.get(n, i)).alias("end"), m.alias("value")))))

        return F.when(F.size(found) > 0, bound(F.split(text, expression, -1), placed)).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>"))

    return bound(F.regexp_extract_all(text, pattern, F.lit(0)), located)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    def weighed(i: Column) -> Column:
        d = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        twice = F.when(F.pmod(i, F.lit(2)) == 0, 2 * d).otherwise(d)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    return F.pmod(_sum(F.transform(F.sequence(F.lit(1), F.length(digits)), weighed)), F.lit(10)) == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return bound(_digits(value), lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Array of (start, kind, end, value) by start, then kind as listed; ``kind`` is its place in ``KINDS``."""
    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    of_kind = []
    for k, kind in enumerate(KINDS):
        found = F.filter(matches(text, EXPRESSIONS[kind]), _check(kind))
        named = F.transform(found, _named(k))
        of_kind.append(F.when(text.rlike(NEEDS[kind]), named).otherwise(none))
    # every kind needs one of these characters
    return F.when(text.rlike(MAYBE), F.array_sort(F.concat(*of_kind))).otherwise(none)


def _check(kind: str) -> Callable[[Column], Column]:
    return lambda m: _valid(kind, m["value"])


def _named(k: int) -> Callable[[Column], Column]:
    return lambda m: F.struct(m["start"].alias("start"), F.lit(k).alias("kind"), m["end"].alias("end"), m["value"].alias("value"))


# ------------------------------------------------------------- contexts ----


def _norm(word: Column) -> Column:
    return F.regexp_replace(F.lower(word), "[0-9]", "0")


def searched(items: Column, use: Callable[[Callable[[Column], Column]], Column]) -> Column:
    """``use(last)``: ``last(place)`` is the index of the last of ``items``, sorted by ``start``, at or before the place, by bisection; -1 if none is."""
    powers = F.filter(F.array(*[F.lit(1 << k) for k in range(30, -1, -1)]), lambda p: p <= F.size(items))
    # past the end is null, and no step
    return bound(powers, lambda steps: use(lambda place: F.aggregate(steps, F.lit(-1), lambda at, p: F.when(F.get(items, at + p)["start"] <= place, at + p).otherwise(at))))


def _free(candidates: Column, base: Column) -> Column:
    """The candidates that no base span overlaps; spans of one kind are apart, so the last one that starts before a candidate's end tells."""

    def without(left: Column, spans: Column) -> Column:
        return F.when(F.size(spans) == 0, left).otherwise(searched(spans, lambda last: F.filter(left, lambda m: F.coalesce(F.get(spans, last(m["end"] - 1))["end"] <= m["start"], F.lit(True)))))

    def step(left: Column, k: int) -> Column:
        return bound(F.struct(left.alias("left"), F.filter(base, lambda b: b["kind"] == k).alias("spans")), lambda x: without(x["left"], x["spans"]))

    for k in range(len(KINDS)):
        candidates = step(candidates, k)
    return candidates


def patterns(text: Column, start: Column, end: Column) -> Column:
    """Lexical patterns of a span: the two words before it, and the words around it; none without a word before."""
    # long runs are in pieces
    return bound(matches(text, RUN), lambda words: searched(words, lambda last: _beside(words, last, start, end)))


def _beside(words: Column, last: Callable[[Column], Column], start: Column, end: Column) -> Column:
    def meet(i: Column) -> Column:
        """Whether pieces ``i`` and ``i + 1`` are of one run."""
        return F.coalesce(F.get(words, i)["end"] == F.get(words, i + 1)["start"], F.lit(False))

    def whole(i: Column) -> Column:
        return F.when(~meet(i - 1) & ~meet(i), F.get(words, i)["value"])

    def left(i: Column) -> Column:
        at = F.get(words, i)["start"]
        # a span that starts within a run has the run's part before it as its first word
        return F.when((start > at) | meet(i - 1), F.struct(F.substring(whole(i), F.lit(1), start - at).alias("one"), whole(i - 1).alias("two"))).otherwise(
            F.struct(whole(i - 1).alias("one"), whole(i - 2).alias("two"))
        )

    def right(j: Column) -> Column:
        word = F.get(words, j)
        return F.when((end < word["end"]) | meet(j), F.substring(whole(j), end - word["start"] + 1, F.lit(LONGEST))).otherwise(whole(j + 1))

    sides = F.struct(bound(last(start), left).alias("left"), bound(last(end - 1), right).alias("after"))
    return bound(sides, lambda w: _forms(_norm(w["left"]["one"]), _norm(w["left"]["two"]), _norm(w["after"])))


def _forms(one: Column, two: Column, after: Column) -> Column:
    forms = F.array(
        F.when((one != "") & (two != ""), F.concat(two, F.lit(" "), one, F.lit(" _"))),
        F.when((one != "") & (after != ""), F.concat(one, F.lit(" _ "), after)),
    )
    return F.filter(forms, lambda p: p.isNotNull())


def found_in(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (doc, tie, base, seen): base spans, and every span of the graph with its patterns (kind null if not a base one)."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("doc"), F.xxhash64(whole).alias("tie"), whole.alias("text")).withColumn("base", base_spans(F.col("text")))
    body = F.col("text")
    nothing = F.array().cast("array<struct<start:int,end:int,value:string>>")
    rows = rows.withColumn("maybe", F.when(body.rlike(MAYBE), matches(body, CANDIDATE)).otherwise(nothing)).withColumn("free", _free(F.col("maybe"), F.col("base")))
    rows = rows.withColumn("words", F.when(F.size("base") + F.size("free") > 0, matches(body, RUN)).otherwise(nothing))
    spans = F.concat(
        F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"), b["kind"].alias("kind"), b["value"].alias("value"))),
        F.transform("free", lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), F.lit(None).cast("int").alias("kind"), m["value"].alias("value"))),
    )

    def contexts(words: Column, last: Callable[[Column], Column]) -> Callable[[Column], Column]:
        def of(s: Column) -> Column:
            value = F.when(F.length(s["value"]) > SHORT, F.md5(s["value"].cast("binary"))).otherwise(F.lower(s["value"]))
            return F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), value.alias("value"), _beside(words, last, s["start"], s["end"]).alias("patterns"))

        return of

    seen = searched(F.col("words"), lambda last: F.transform(spans, contexts(F.col("words"), last)))
    return rows.select("doc", "tie", "base", seen.alias("seen"))


# -------------------------------------------------------------- scoring ----


def scored(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(pattern, kind, score) and (value, kind, score) after the rounds, over ``edges`` (pattern, value) and ``seeds`` (value, kind)."""
    sizes = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    values = seeds.withColumn("score", F.lit(1.0)).withColumn("seed", F.lit(1))
    for _ in range(rounds):
        vouched = edges.join(values, "value").groupBy("pattern", "kind").agg(F.sum("score").alias("s"), F.sum("seed").alias("seeds"))
        # a pattern's score: its values' confidence, out of all its values and one more in doubt
        good = vouched.join(sizes, "pattern").withColumn("score", F.col("s") / (F.col("n") + 1)).filter((F.col("seeds") >= LEAST_SEEDS) & (F.col("score") >= LEAST_PATTERN))
        good = written(good.select("pattern", "kind", "score"), "patterns")
        told = edges.join(good, "pattern").groupBy("value", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.col("score"))))).alias("score"))
        both = told.withColumn("seed", F.lit(0)).unionByName(seeds.withColumn("score", F.lit(1.0)).withColumn("seed", F.lit(1)))
        values = written(both.groupBy("value", "kind").agg(F.max("score").alias("score"), F.max("seed").alias("seed")), "values")
    return good, values


def discovered(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(doc, tie, start, end, kind): spans that are not base ones and that confident patterns vouch for."""
    seen = found.select("doc", "tie", F.explode("seen").alias("s")).select("doc", "tie", "s.*")
    edges = written(seen.select("value", F.explode("patterns").alias("pattern")).distinct(), "edges")
    seeds = written(seen.filter(F.col("kind").isNotNull()).select("value", "kind").distinct(), "seeds")
    good, values = scored(edges, seeds, rounds)
    new = seen.filter(F.col("kind").isNull()).select("doc", "tie", "start", "end", "value", F.explode("patterns").alias("pattern"))
    held = new.join(good.select("pattern", "kind"), "pattern").join(values.filter(F.col("score") >= LEAST_VALUE).select("value", "kind", "score"), ["value", "kind"])
    best = held.groupBy("doc", "tie", "start", "end").agg(F.max(F.struct("score", (-F.col("kind")).alias("k"))).alias("best"))
    return best.select("doc", "tie", "start", "end", (-F.col("best.k")).alias("kind"))


def _written_out(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def identifiers(docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row for each row of ``docs``: counts and digest of the base spans, and all spans."""
    found = written(found_in(docs, key, text), "found")
    plain = F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["kind"].alias("kind"), b["end"].alias("end")))
    more = discovered(found, rounds).groupBy("doc", "tie").agg(F.collect_set(F.struct("start", "kind", "end")).alias("more")).withColumnsRenamed({"doc": "d", "tie": "t"})
    rows = found.select("doc", "tie", plain.alias("base")).join(more, F.col("doc").eqNullSafe(F.col("d")) & (F.col("tie") == F.col("t")), "left")
    every = F.when(F.col("more").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "more")))

    def count(k: int) -> Column:
        return F.size(F.filter("base", lambda b: b["kind"] == k)).cast("long")

    return rows.select(
        F.col("doc").alias("doc_id"), *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.sha2(_written_out(F.col("base")).cast("binary"), 256).alias("base_sha256"), _written_out(every).alias("spans"), F.coalesce(F.when(F.col("more").isNotNull(), F.size("more")), F.lit(0)).cast("long").alias("n_added"),
    )
