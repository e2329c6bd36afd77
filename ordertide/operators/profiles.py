"""Table-level profiles and checks (R1-R5) and the dashboard views (O1-O2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide.operators.curate import PLACED
from ordertide.schemas import CHANNELS


def skew_profile(orders: DataFrame) -> DataFrame:
    """Rows and share per store, and each store's ratio to the median store.

    One lazy plan: the counts are one row per store, and the two global
    figures (total rows, median count) are scalar subqueries over them.
    """
    counts = orders.groupBy("store_id").agg(F.count(F.lit(1)).alias("n"))
    total = counts.select(F.sum("n")).scalar()
    median = counts.select(F.percentile("n", 0.5)).scalar()

    def per(value) -> Column:
        return F.col("n") / F.nullif(value.cast("double"), F.lit(0.0))

    return counts.select("store_id", "n", per(total).alias("share"), per(median).alias("ratio_to_median"))


def channel_profile(orders: DataFrame) -> DataFrame:
    """Channel domain check: orders per channel and whether the channel is one
    of the event schema's enum symbols (decoding reads it as plain text)."""
    return (orders.groupBy("channel").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("valid", F.coalesce(F.col("channel").isin(*CHANNELS), F.lit(False))))


def lateness_profile(orders: DataFrame, late_after_seconds: int = 600,
                     delay_seconds: int = 900) -> DataFrame:
    """R2: publish delay (published - placed, whole seconds) per store."""
    lateness = F.unix_timestamp("published") - F.unix_timestamp(PLACED)
    return (orders.select("store_id", lateness.alias("lateness"))
            .groupBy("store_id").agg(
                F.count(F.lit(1)).alias("n"),
                F.count_if(F.col("lateness") > late_after_seconds).alias("n_late"),
                F.count_if(F.col("lateness") > delay_seconds).alias("n_beyond_delay"),
                F.max("lateness").alias("max_lateness_seconds")))


def _dec(c):
    return c.cast("decimal(18,2)")


def items_total(items: str = "items"):
    """Σ quantity x unit price over an items array, exact (decimal)."""
    return F.aggregate(
        items, F.lit(0).cast("decimal(18,2)"),
        lambda acc, it: (acc + _dec(it["quantity"]) * _dec(it["unit_price"])).cast("decimal(18,2)"))


def order_total_check(orders: DataFrame) -> DataFrame:
    """Stated amount vs Σ quantity x unit price of the order's items.

    Items are either inline in ``orders`` (one event per order: a row-wise
    check over the array) or already summed per order (``items_total``, with
    ``n_unpriced`` items that no price was found for, which fail the check).
    """
    inline = "items" in orders.columns
    total = items_total() if inline else F.col("items_total")
    complete = F.lit(True) if inline else F.col("n_unpriced") == 0
    return orders.select(
        "order_key",
        F.col("transaction_amount").alias("stated"),
        total.cast("double").alias("computed"),
        ((_dec(F.col("transaction_amount")) == total) & complete).alias("ok"),
    )


def split_tender_check(orders: DataFrame) -> DataFrame:
    """When split tenders exist, their amounts must sum to the order amount."""
    splits = F.col("payment.split_tender")
    total = F.aggregate(splits, F.lit(0).cast("decimal(18,2)"),
                        lambda acc, s: (acc + _dec(s["amount"])).cast("decimal(18,2)"))
    return orders.select(
        "order_key",
        F.size(splits).alias("n_splits"),
        total.cast("double").alias("split_total"),
        ((F.size(splits) == 0) | (total == _dec(F.col("transaction_amount")))).alias("ok"),
    )


def item_lines(lines: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """One row per item and per syrup modifier; items without modifiers and
    (given ``orders``) orders without items are kept, with nulls."""
    flat = lines.select(
        F.col("order_key"), "item_id", "quantity", F.explode_outer("seasonal_syrup_modifiers").alias("modifier"),
    ).select("order_key", "item_id", "quantity",
             F.col("modifier.syrup_name").alias("syrup_name"),
             F.col("modifier.pumps").alias("pumps"))
    if orders is None:
        return flat
    return orders.select("order_key").join(flat, "order_key", "left")


def dashboard(silver: DataFrame, limit: int | None = None) -> DataFrame:
    """O1: newest windows first, longest waits first within a window."""
    out = silver.orderBy(F.col("window_end").desc(), F.col("avg_wait_time_seconds").desc())
    return out.limit(limit) if limit else out


def latest_bronze(bronze: DataFrame, n: int = 20) -> DataFrame:
    """O2: newest ``n`` bronze rows; ingestion time ties are broken by publish
    time, then (partition, offset) so the top-n is deterministic."""
    order = [F.col(c).desc() for c in ("bronze_ingestion_timestamp",) if c in bronze.columns]
    order += [F.col("kafka_published_timestamp").desc(), F.col("partition").asc(), F.col("offset").asc()]
    return bronze.orderBy(*order).limit(n)
