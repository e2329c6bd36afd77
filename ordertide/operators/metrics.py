"""Per-store event-time window metrics.

Plan shape, one stage (default): Project(window) -> partial HashAggregate (map
side, before the shuffle: a hot store leaves each task as one row per window)
-> Exchange(window, store) -> final aggregate -> Project.
Salted (``salt_factor`` > 1): Project(window, salt) -> partial -> Exchange(window,
store, salt) -> final (stage 1) -> partial -> Exchange(window, store) -> final
(stage 2) -> Project; in streaming, two chained stateful aggregations.

Averages are ratios of sums (never averages of averages): Σamount / Σcount and
Σwait / Σcount, with a null amount adding nothing to the numerator but
counting in the denominator. With ``params.exact`` amounts are summed as whole
units of 10**-10 and waits as whole seconds, so every grouping order — direct,
salted, any partitioning, any micro-batch split — gives identical results,
rounded HALF_UP once, on the exact quotient. Amounts that units cannot hold
(NaN, infinities, 1e14 and beyond) are summed beside them as doubles: no value
stops a stream.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide.functions.ordercols import LARGEST, UNIT_PLACES, half_up_ratio, salt, strays, units
from ordertide.params import PipelineParams
from ordertide.operators.curate import PLACED


def window_col(params: PipelineParams) -> Column:
    """Tumbling when slide == duration, sliding otherwise; [start, end)."""
    if params.slide_duration and params.slide_duration != params.window_duration:
        return F.window(PLACED, params.window_duration, params.slide_duration)
    return F.window(PLACED, params.window_duration)


@dataclass(frozen=True)
class Measure:
    """A sum that is taken once from orders and then from earlier sums."""

    name: str
    of_orders: Column

    def first(self) -> Column:
        return self.of_orders.alias(self.name)

    def again(self) -> Column:
        return F.sum(self.name).alias(self.name)


def measures(params: PipelineParams, null_counts: bool = False) -> list[Measure]:
    """What every plan adds up: amount, wait, orders; stray amounts beside exact ones."""
    amount, wait = F.col("transaction_amount"), F.col("wait_time_seconds")
    out = [Measure("orders", F.count(F.lit(1)))]
    if params.exact:
        out += [Measure("amount", F.sum(units(amount))), Measure("stray", F.sum(strays(amount))),
                Measure("wait", F.sum(wait.cast("long")))]
    else:
        out += [Measure("amount", F.sum(amount)), Measure("wait", F.sum(wait))]
    if null_counts:
        out.append(Measure("nulls", F.count(F.lit(1)) - F.count(amount)))
    return out


def with_salt(curated: DataFrame, params: PipelineParams) -> DataFrame:
    """salt = first 32 bits of md5(order_id) modulo salt_factor."""
    return curated.withColumn("salt", salt("order_id", params.salt_factor or 1))


def salted_partials(curated: DataFrame, params: PipelineParams,
                    null_counts: bool = False) -> DataFrame:
    """A1: stage 1, grouped by (window, store, salt)."""
    return (with_salt(curated, params)
            .groupBy(window_col(params).alias("window"), F.col("store_id"), F.col("salt"))
            .agg(*[m.first() for m in measures(params, null_counts)]))


def rollup(partials: DataFrame, params: PipelineParams, null_counts: bool = False) -> DataFrame:
    """A2: stage 2, partial sums rolled up per (window, store)."""
    return partials.groupBy("window", "store_id").agg(*[m.again() for m in measures(params, null_counts)])


def one_stage(curated: DataFrame, params: PipelineParams, null_counts: bool = False) -> DataFrame:
    """A4 shape with a window: direct aggregate per (window, store).

    The partial (map-side) aggregate already bounds what a hot store sends
    through the shuffle to one row per (window, store) per input task.
    """
    return (curated.groupBy(window_col(params).alias("window"), F.col("store_id"))
            .agg(*[m.first() for m in measures(params, null_counts)]))


def averages(params: PipelineParams, amount_places: int = 2, wait_places: int = 1) -> tuple[Column, Column]:
    """C8 + C9: Σamount/Σcount and Σwait/Σcount, rounded half-up once.

    With a stray amount (NaN, infinite, beyond exact range) in the group the
    amount is averaged in doubles, as plain floating point would.
    """
    amount, wait, n = F.col("amount"), F.col("wait"), F.col("orders")
    if not params.exact:
        return F.round(amount / n, amount_places), F.round(wait / n, wait_places)
    loose = (F.coalesce(amount.cast("double"), F.lit(0.0)) / 10.0 ** UNIT_PLACES + F.col("stray")) / n
    exact = half_up_ratio(amount, n, amount_places, unit_places=UNIT_PLACES)
    finite = F.abs(loose) < LARGEST
    return (F.when(F.col("stray").isNull(), exact).otherwise(F.when(finite, F.round(loose, amount_places)).otherwise(loose)),
            half_up_ratio(wait, n, wait_places))


def finish(totals: DataFrame, params: PipelineParams, stamp: bool = False) -> DataFrame:
    """A3 + C7: silver columns from per-(window, store) totals."""
    aov, wait = averages(params)
    cols = [
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.col("store_id"),
        F.col("orders").alias("total_order_count"),
        aov.alias("avg_order_value"),
        wait.alias("avg_wait_time_seconds"),
    ]
    if "nulls" in totals.columns:
        cols.append(F.col("nulls").alias("null_amount_count"))
    if stamp:
        cols.append(F.current_timestamp().alias("metrics_calculated_timestamp"))
    return totals.select(*cols)


def store_metrics(curated: DataFrame, params: PipelineParams, stamp: bool = False,
                  null_counts: bool = False) -> DataFrame:
    """Silver metrics: two-stage salted when ``salt_factor`` > 1, else one stage."""
    if params.salted:
        totals = rollup(salted_partials(curated, params, null_counts), params, null_counts)
    else:
        totals = one_stage(curated, params, null_counts)
    return finish(totals, params, stamp)


def store_totals_direct(curated: DataFrame, params: PipelineParams, places: int = 4) -> DataFrame:
    """A4: one stage per store, no window: count and both averages to ``places``."""
    totals = curated.groupBy("store_id").agg(*[m.first() for m in measures(params)])
    aov, wait = averages(params, places, places)
    return totals.select("store_id", F.col("orders").alias("order_count"),
                         aov.alias("aov"), wait.alias("avg_wait"))


def salting_parity(curated: DataFrame, params: PipelineParams, tolerance: float = 5e-5) -> DataFrame:
    """A5: two-stage equals one-stage, per (window, store).

    Both results are tagged and unioned, then grouped once per (window, store)
    (one small shuffle instead of a full outer join's two). A group mismatches
    when it is missing on one side, counts differ, or an average differs by
    ``tolerance`` or more. Uses plain double sums (``exact=False``), the case
    where summation order could matter. Returns (groups, mismatches, max_abs_diff).
    """
    p = params.replace(exact=False, salt_factor=params.salt_factor or 16)

    def tagged(totals: DataFrame, side: int) -> DataFrame:
        n = F.col("orders")
        return totals.select(
            F.col("window.start").alias("window_start"), "store_id", n.alias("n"),
            (F.col("amount") / n).alias("aov"),
            (F.col("wait") / n).alias("wait"),
            F.lit(side).alias("side"))

    both = tagged(one_stage(curated, p), 0).unionByName(tagged(rollup(salted_partials(curated, p), p), 1))
    per_group = both.groupBy("window_start", "store_id").agg(
        F.count(F.lit(1)).alias("sides"),
        (F.max("n") - F.min("n")).alias("dn"),
        F.count("aov").alias("n_aov"),
        (F.max("aov") - F.min("aov")).alias("daov"),
        (F.max("wait") - F.min("wait")).alias("dwait"),
    )
    bad = ((F.col("sides") != 2) | (F.col("dn") != 0) | F.col("n_aov").isin(1)
           | (F.coalesce(F.col("daov"), F.lit(0.0)) >= tolerance) | (F.col("dwait") >= tolerance))
    return per_group.agg(
        F.count(F.lit(1)).alias("groups"),
        F.count_if(bad).alias("mismatches"),
        F.coalesce(F.max(F.greatest(F.coalesce("daov", F.lit(0.0)), "dwait")), F.lit(0.0))
         .alias("max_abs_diff"),
    )


def partials_invariants(curated: DataFrame, params: PipelineParams) -> DataFrame:
    """A1 invariants: per (window, store), Σ partial counts and Σ partial cents
    equal the direct totals; ``n_salts`` stage-1 rows exist, all with a salt
    in [0, N)."""
    n = params.salt_factor or 1
    p = params.replace(exact=True)
    return (salted_partials(curated, p)
            .groupBy("window", "store_id").agg(
                F.sum("orders").alias("order_count"),
                half_up_ratio(F.sum("amount") * 100, F.lit(1), 0, unit_places=UNIT_PLACES).cast("long").alias("amount_cents"),
                F.count(F.lit(1)).alias("n_salts"),
                F.min("salt").alias("min_salt"), F.max("salt").alias("max_salt"))
            .select(F.col("window.start").alias("window_start"), "store_id", "order_count",
                    "amount_cents", "n_salts",
                    ((F.col("n_salts") <= n) & (F.col("min_salt") >= 0) & (F.col("max_salt") < n))
                    .alias("salts_ok")))


def salt_spread(curated: DataFrame, params: PipelineParams) -> DataFrame:
    """C10 distribution: rows per salt value."""
    return with_salt(curated, params).groupBy("salt").agg(F.count(F.lit(1)).alias("n"))
