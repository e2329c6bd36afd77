"""Schemas of the raw log, the order event, and the bronze / silver tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw log row as a message-log source delivers it.
RAW_LOG = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

SYRUP_MODIFIER = T.StructType([
    T.StructField("syrup_name", T.StringType()),
    T.StructField("pumps", T.IntegerType()),
])
ORDER_ITEM = T.StructType([
    T.StructField("item_id", T.StringType()),
    T.StructField("item_name", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", T.DoubleType()),
    T.StructField("seasonal_syrup_modifiers", T.ArrayType(SYRUP_MODIFIER)),
])
SPLIT_TENDER = T.StructType([
    T.StructField("tender_type", T.StringType()),
    T.StructField("amount", T.DoubleType()),
])
PAYMENT = T.StructType([
    T.StructField("primary_tender", T.StringType()),
    T.StructField("split_tender", T.ArrayType(SPLIT_TENDER)),
])

# Order event, version 1 (schema id 101 in the fixtures).
ORDER_EVENT = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("store_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("order_placed_timestamp", T.StringType()),
    T.StructField("order_fulfilled_timestamp", T.StringType()),
    T.StructField("transaction_amount", T.DoubleType()),
    T.StructField("items", T.ArrayType(ORDER_ITEM)),
    T.StructField("payment", PAYMENT),
])

# Version 2 adds a nullable field and a nested one (schema id 102 in the fixtures).
PAYMENT_V2 = T.StructType(PAYMENT.fields + [T.StructField("wallet", T.StringType())])
ORDER_EVENT_V2 = T.StructType(
    [T.StructField(f.name, PAYMENT_V2) if f.name == "payment" else f for f in ORDER_EVENT.fields]
    + [T.StructField("loyalty_tier", T.StringType())])

# The four order channels of the event schema's enum.
CHANNELS = ("IN_STORE_POS", "DRIVE_THRU", "MOBILE_APP_PICKUP", "MOBILE_APP_DELIVERY")

BRONZE_COLUMNS = (
    ("kafka_key", "STRING", "Message key (store id)"),
    ("raw_payload", "BINARY", "Framed payload: magic byte, 4-byte schema id, body"),
    ("topic", "STRING", "Source topic"),
    ("partition", "INT", "Source partition"),
    ("offset", "BIGINT", "Offset within the partition"),
    ("kafka_published_timestamp", "TIMESTAMP", "Log publish time"),
    ("bronze_ingestion_timestamp", "TIMESTAMP", "Time the row was landed"),
)

SILVER_COLUMNS = (
    ("window_start", "TIMESTAMP", "Window start (inclusive)"),
    ("window_end", "TIMESTAMP", "Window end (exclusive)"),
    ("store_id", "STRING", "Store identifier"),
    ("total_order_count", "BIGINT", "Orders placed in the window"),
    ("avg_order_value", "DOUBLE", "Sum of amounts / order count, 2 places"),
    ("avg_wait_time_seconds", "DOUBLE", "Sum of waits / order count, 1 place"),
    ("metrics_calculated_timestamp", "TIMESTAMP", "Time the row was computed"),
)

METRIC_COLUMNS = ("window_start", "window_end", "store_id", "total_order_count",
                  "avg_order_value", "avg_wait_time_seconds")


def ddl(columns) -> str:
    return ", ".join(f"`{name}` {typ}" for name, typ, _ in columns)
