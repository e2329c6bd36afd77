"""Order fixtures derived from the given tables with column expressions only.

* ``flat_orders``  (F6): one order per ``events`` row; ~65% of rows on one
  hot store, null amounts, unfulfilled orders, late publication.
* ``raw_log``      (F7): the same orders framed as log records (magic byte,
  schema id 101/102, JSON body), plus malformed records.
* ``order_lines`` and ``nested_orders`` (F8): items from ``lineitem`` x ``part``,
  a row each, and order heads (amount, split tenders) per ``orders`` row.

All are narrow projections (no shuffle) except ``nested_orders``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide.functions.framing import build_frame
from ordertide.functions.timefns import session_zone, utc_instant, wall_clock

# Fixture rules for the derived order stream.
HOT_STORE = "STORE-0001"
TOPIC = "live_orders"
SCHEMA_V1, SCHEMA_V2 = 101, 102
# unregistered ids; the second is beyond the signed range
SCHEMA_UNKNOWN, SCHEMA_LARGE = 103, 2**32 - 1
# event_type -> order channel
CHANNEL_BY_EVENT = {
    "click": "IN_STORE_POS",
    "view": "DRIVE_THRU",
    "purchase": "MOBILE_APP_PICKUP",
    "signup": "MOBILE_APP_DELIVERY",
    "error": "IN_STORE_POS",
}
# malformed-record injection, by event_id % 1000
BAD_PLACED, BAD_STORE, BAD_SCHEMA, BAD_BODY = 1, 2, 3, 4


def _seconds(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), n.cast("decimal(18,6)"))


def flat_orders(events: DataFrame) -> DataFrame:
    """events -> flat orders (TIMESTAMP instants, UTC)."""
    eid, uid = F.col("event_id"), F.col("user_id")
    placed = utc_instant(F.col("ts"), zone=session_zone(events.sparkSession))
    channel = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v))
                           for k, v in CHANNEL_BY_EVENT.items()], F.lit("IN_STORE_POS"))
    return events.select(
        eid.alias("event_id"),
        uid.alias("user_id"),
        F.col("event_type"),
        F.concat(F.lit("ORD-"), eid.cast("string")).alias("order_id"),
        F.when(uid % 20 < 13, F.lit(HOT_STORE))
         .otherwise(F.concat(F.lit("STORE-"), F.lpad((uid % 6 + 2).cast("string"), 4, "0")))
         .alias("store_id"),
        F.when(F.col("event_type") != "signup", F.concat(F.lit("CUST-"), uid.cast("string")))
         .alias("customer_id"),
        channel.alias("channel"),
        placed.alias("order_placed_timestamp"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("timestamp"))
         .otherwise(placed + _seconds(eid % 361 + 90)).alias("order_fulfilled_timestamp"),
        F.when(eid % 97 == 0, F.lit(None).cast("double")).otherwise(F.col("value"))
         .alias("transaction_amount"),
        (placed + _seconds(F.when(eid % 10 == 0, eid % 36 + 730).otherwise(eid % 6)))
         .alias("published"),
    )


def _json_str(c: Column) -> Column:
    return F.coalesce(F.concat(F.lit('"'), c, F.lit('"')), F.lit("null"))


def _iso(ts: Column, zone: str) -> Column:
    """ISO-8601 UTC text of an instant (formatted from the UTC wall clock, so
    the session time zone does not matter)."""
    return F.date_format(wall_clock(ts, zone), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _money(c: Column) -> Column:
    return F.coalesce(c.cast("decimal(18,2)").cast("string"), F.lit("null"))


def order_body(o: DataFrame) -> Column:
    """JSON text of one order (fixed field order and number format)."""
    eid = F.col("event_id")
    zone = session_zone(o.sparkSession)
    schema_id = F.when(eid % 2 == 0, F.lit(SCHEMA_V1)).otherwise(F.lit(SCHEMA_V2))
    placed = F.when(eid % 1000 == BAD_PLACED, F.lit("junk")).otherwise(_iso(F.col("order_placed_timestamp"), zone))
    store = F.when(eid % 1000 == BAD_STORE, F.lit(None).cast("string")).otherwise(F.col("store_id"))
    modifiers = F.when(eid % 3 == 0, F.lit('[{"syrup_name":"Vanilla","pumps":2}]')).otherwise(F.lit("[]"))
    items = F.when(F.col("transaction_amount").isNull(), F.lit("[]")).otherwise(F.concat(
        F.lit('[{"item_id":"SKU-'), (F.col("user_id") % 50).cast("string"),
        F.lit('","item_name":"'), F.col("event_type"),
        F.lit('","quantity":1,"unit_price":'), _money(F.col("transaction_amount")),
        F.lit(',"seasonal_syrup_modifiers":'), modifiers, F.lit("}]")))
    tier = F.when(F.col("transaction_amount") >= 25, F.lit("GOLD")).otherwise(F.lit("GREEN"))
    return F.concat(
        F.lit('{"order_id":'), _json_str(F.col("order_id")),
        F.lit(',"store_id":'), _json_str(store),
        F.lit(',"customer_id":'), _json_str(F.col("customer_id")),
        F.lit(',"channel":'), _json_str(F.col("channel")),
        F.lit(',"order_placed_timestamp":'), _json_str(placed),
        F.lit(',"order_fulfilled_timestamp":'), _json_str(_iso(F.col("order_fulfilled_timestamp"), zone)),
        F.lit(',"transaction_amount":'), _money(F.col("transaction_amount")),
        F.lit(',"items":'), items,
        F.lit(',"payment":{"primary_tender":"CARD","split_tender":[]'),
        F.when(schema_id == SCHEMA_V2, F.concat(F.lit(',"wallet":"W-'), (F.col("user_id") % 7).cast("string"), F.lit('"'))).otherwise(F.lit("")),
        F.lit("}"),
        F.when(schema_id == SCHEMA_V2, F.concat(F.lit(',"loyalty_tier":'), _json_str(tier))).otherwise(F.lit("")),
        F.lit("}"),
    )


def raw_log(orders: DataFrame) -> DataFrame:
    """flat orders -> raw log rows ``(key, value, topic, partition, offset, timestamp)``."""
    eid = F.col("event_id")
    schema_id = (F.when(eid % 2000 == BAD_SCHEMA, F.lit(SCHEMA_LARGE))
                 .when(eid % 1000 == BAD_SCHEMA, F.lit(SCHEMA_UNKNOWN))
                 .when(eid % 2 == 0, F.lit(SCHEMA_V1)).otherwise(F.lit(SCHEMA_V2)))
    body = F.when(eid % 1000 == BAD_BODY, F.lit("")).otherwise(order_body(orders))
    return orders.select(
        F.col("store_id").cast("binary").alias("key"),
        build_frame(schema_id, body).alias("value"),
        F.lit(TOPIC).alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        eid.alias("offset"),
        F.col("published").alias("timestamp"),
    )


TENDERS = "array<struct<tender_type:string,amount:double>>"
MODIFIERS = "array<struct<syrup_name:string,pumps:int>>"
# orders whose second tender is one unit too much, so that the split check has failing cases
BAD_SPLIT = 1


def order_lines(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """F8 items, one row per line: ``order_key, item_id, item_name, quantity, unit_price,
    seasonal_syrup_modifiers, line_number``. A line whose part is missing keeps its row,
    without name and price. No array grows with the size of one order."""
    mods = F.when(F.col("l_linenumber") % 3 == 0,
                  F.array(F.struct(F.lit("Vanilla").alias("syrup_name"), F.lit(2).alias("pumps"))))
    return (lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
            .join(part.select("p_partkey", "p_name", "p_retailprice"),
                  F.col("l_partkey") == F.col("p_partkey"), "left")
            .select(F.col("l_orderkey").alias("order_key"),
                    F.col("l_partkey").cast("string").alias("item_id"),
                    F.col("p_name").alias("item_name"),
                    F.col("l_quantity").cast("int").alias("quantity"),
                    F.col("p_retailprice").alias("unit_price"),
                    F.coalesce(mods, F.array().cast(MODIFIERS)).alias("seasonal_syrup_modifiers"),
                    F.col("l_linenumber").alias("line_number")))


def nested_orders(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """F8 heads, one row per order: ``order_key, order_id, transaction_amount, payment, n_lines,
    items_total, n_unpriced``.

    Amount = Σ quantity x price, except every tenth order, which states its
    total price (so the total check must flag it); two split tenders (60 % /
    rest, in cents) on orders with key % 10 < 3, which do not add up where
    key % 100 = 1. The lines are summed by a partial aggregate (skew-safe), and
    read once.
    """
    price = F.col("quantity").cast("decimal(18,2)") * F.col("unit_price").cast("decimal(18,2)")
    per_order = lines.groupBy(F.col("order_key").alias("of_order")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(price).cast("decimal(18,2)").alias("items_total"),
        F.count_if(price.isNull()).alias("n_unpriced"))
    o = orders.select("o_orderkey", "o_totalprice").join(
        per_order, F.col("o_orderkey") == F.col("of_order"), "left")
    items_total = F.coalesce(F.col("items_total"), F.lit(0).cast("decimal(18,2)"))
    amount_cents = F.when(F.col("o_orderkey") % 10 == 0, F.round(F.col("o_totalprice") * 100).cast("long")) \
        .otherwise((items_total * 100).cast("long"))
    first = F.call_function("div", amount_cents * 6, F.lit(10))
    second = amount_cents - first + F.when(F.col("o_orderkey") % 100 == BAD_SPLIT, F.lit(100)).otherwise(F.lit(0))
    split = F.when(F.col("o_orderkey") % 10 < 3, F.array(
        F.struct(F.lit("CARD").alias("tender_type"), (first / 100.0).alias("amount")),
        F.struct(F.lit("WALLET").alias("tender_type"), (second / 100.0).alias("amount")),
    )).otherwise(F.array().cast(TENDERS))
    return o.select(
        F.col("o_orderkey").alias("order_key"),
        F.concat(F.lit("ORD-"), F.col("o_orderkey").cast("string")).alias("order_id"),
        (amount_cents / 100.0).alias("transaction_amount"),
        F.struct(F.lit("CARD").alias("primary_tender"), split.alias("split_tender")).alias("payment"),
        F.coalesce(F.col("n_lines"), F.lit(0)).alias("n_lines"),
        items_total.alias("items_total"),
        F.coalesce(F.col("n_unpriced"), F.lit(0)).alias("n_unpriced"),
    )
