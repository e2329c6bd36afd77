import pytest
from pyspark.sql import functions as F

from ordertide.operators.curate import bronze_projection, curate_orders
from ordertide.operators.decode import (avro_schema_json, avro_struct, decode, decode_by_schema_id, decode_fixed,
                                        encode_frames, frame_outcomes, split_frame, superset_schema)
from ordertide.params import PipelineParams
from ordertide.schemas import ORDER_EVENT, ORDER_EVENT_V2
from ordertide.sources.fixtures import flat_orders, raw_log
from ordertide.sources.tables import read_table

from tests.conftest import SF001

SCHEMAS = {101: ORDER_EVENT, 102: ORDER_EVENT_V2}


@pytest.fixture(scope="module")
def log001(spark):
    return raw_log(flat_orders(read_table(spark, SF001, "events"))).cache()


def test_fixed_decode_failfast_raises_on_bad_body(spark, log001):
    # an empty body is a null record, not a malformed one
    assert decode_fixed(log001, ORDER_EVENT, mode="FAILFAST").count() == log001.count()
    bad = spark.createDataFrame([("{not json",)], "b string").select(
        F.concat(F.unhex(F.lit("0000000065")), F.col("b").cast("binary")).alias("value"))
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        decode_fixed(bad, ORDER_EVENT, mode="FAILFAST").collect()
    assert decode_fixed(bad, ORDER_EVENT, mode="PERMISSIVE").first()["order_id"] is None


def test_fixed_decode_permissive_nulls_bad_body(spark, log001):
    d = decode_fixed(log001, ORDER_EVENT, mode="PERMISSIVE", keep=["offset"])
    assert d.count() == log001.count()
    bad = d.filter(F.col("offset") % 1000 == 4).collect()
    assert bad and all(r["order_id"] is None for r in bad)


def test_decode_by_schema_id_superset_and_unknown(spark, log001):
    d = decode_by_schema_id(log001, SCHEMAS, keep=["offset"],
                            with_schema_id=True)
    assert "loyalty_tier" in d.columns
    rows = {r["offset"]: r for r in d.collect()}
    assert rows[3]["schema_id"] == 2**32 - 1 and rows[3]["order_id"] is None          # unknown id
    assert rows[0]["schema_id"] == 101 and rows[0]["loyalty_tier"] is None     # v1: no tier
    assert rows[5]["schema_id"] == 102 and rows[5]["loyalty_tier"] in ("GOLD", "GREEN")


def test_wrong_magic_byte_is_not_decoded(spark):
    body = '{"order_id":"X","store_id":"S","order_placed_timestamp":"2024-01-01T00:00:00Z"}'
    df = spark.createDataFrame([(body,)], "b string").select(
        F.concat(F.unhex(F.lit("0100000065")), F.col("b").cast("binary")).alias("value"))
    assert decode_by_schema_id(df, SCHEMAS).first()["order_id"] is None


def test_decoder_choice(spark, log001):
    fixed = decode(log001, PipelineParams(decode="fixed", parse_mode="PERMISSIVE"))
    by_id = decode(log001, PipelineParams(decode="by_schema_id", schemas=SCHEMAS))
    assert "loyalty_tier" not in fixed.columns and "loyalty_tier" in by_id.columns
    with pytest.raises(ValueError):
        PipelineParams(decode="registry")
    with pytest.raises(ValueError):
        PipelineParams(body_format="protobuf")


def test_validity_filter_drops_malformed(spark, log001):
    n = log001.count()
    cur = curate_orders(decode_by_schema_id(log001, SCHEMAS, keep=["offset"]))
    kept = {r["offset"] for r in cur.select("offset").collect()}
    assert len(kept) == n - 4                      # one of each malformed kind at sf0.001
    assert not kept & {1, 2, 3, 4}


def test_bronze_keeps_every_row_unchanged(spark, log001):
    b = bronze_projection(log001)
    assert b.columns == ["kafka_key", "raw_payload", "topic", "partition", "offset",
                         "kafka_published_timestamp", "bronze_ingestion_timestamp"]
    assert b.count() == log001.count()
    assert b.join(log001, b["raw_payload"] == log001["value"], "left_anti").count() == 0


def test_encode_then_split_round_trip(spark, log001):
    d = decode_by_schema_id(log001, SCHEMAS, keep=["offset"], with_schema_id=True).filter("order_id is not null")
    framed = encode_frames(d, F.col("schema_id"), ORDER_EVENT_V2, keep=["offset", "schema_id"])
    s = split_frame(framed)
    assert s.filter((F.col("magic") != "00") | (s["schema_id"] != F.col("schema_id"))).count() == 0


def test_avro_schema_text_is_valid_json():
    import json
    doc = json.loads(avro_schema_json(ORDER_EVENT))
    assert doc["type"] == "record" and doc["fields"][0]["name"] == "order_id"


def _has_avro(spark):
    try:
        spark._jvm.java.lang.Class.forName("org.apache.spark.sql.avro.CatalystDataToAvro")
        return True
    except Exception:
        return False


def test_avro_body_round_trip(spark, log001):
    if not _has_avro(spark):
        pytest.skip("spark-avro is not on the classpath")
    d = decode_by_schema_id(log001, SCHEMAS).filter("order_id is not null")
    framed = encode_frames(d, 101, ORDER_EVENT, body_format="avro")
    back = decode_fixed(framed, ORDER_EVENT, body_format="avro")
    assert back.count() == d.count()


AVRO_TEXT = """{"type": "record", "name": "E", "fields": [
  {"name": "order_id", "type": "string"}, {"name": "customer_id", "type": ["null", "string"], "default": null},
  {"name": "channel", "type": {"type": "enum", "name": "C", "symbols": ["A", "B"]}}, {"name": "amount", "type": "double"},
  {"name": "items", "type": {"type": "array", "items": {"type": "record", "name": "I", "fields": [
    {"name": "pumps", "type": "int"}, {"name": "tags", "type": {"type": "array", "items": "string"}}]}}, "default": []}]}"""


def test_struct_of_an_avro_schema_text():
    assert avro_struct(AVRO_TEXT).simpleString() == (
        "struct<order_id:string,customer_id:string,channel:string,amount:double,items:array<struct<pumps:int,tags:array<string>>>>")
    assert not avro_struct(AVRO_TEXT)["order_id"].nullable and avro_struct(AVRO_TEXT)["customer_id"].nullable


def test_given_avro_text_is_what_the_decoder_gets(spark, monkeypatch):
    import pyspark.sql.avro.functions as avro
    seen = []
    monkeypatch.setattr(avro, "from_avro", lambda c, text, options: seen.append(text) or F.from_json(c.cast("string"), avro_struct(text)))
    df = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x00\x07{}"),)], "value binary")
    decode_by_schema_id(df, {7: AVRO_TEXT}, body_format="avro")
    assert seen == [AVRO_TEXT]


def frame(spark, *bodies):
    rows = [(bytearray(magic + i.to_bytes(4, "big") + body.encode()),) for magic, i, body in bodies]
    return spark.createDataFrame(rows, "value binary")


def test_nested_versions_merge_at_any_depth(spark):
    v1 = "id string, items array<struct<a int>>, pay struct<t string>"
    v2 = "id string, items array<struct<a int, mods array<struct<s string>>>>, pay struct<t string, w struct<x int>>"
    df = frame(spark, (b"\0", 1, '{"id":"1","items":[{"a":1}],"pay":{"t":"c"}}'),
               (b"\0", 4000000000, '{"id":"2","items":[{"a":2,"mods":[{"s":"v"}]}],"pay":{"t":"d","w":{"x":5}}}'))
    rows = {r["id"]: r for r in decode_by_schema_id(df, {1: v1, 4000000000: v2}).collect()}
    assert rows["1"]["items"][0].asDict(True) == {"a": 1, "mods": None} and rows["1"]["pay"].asDict(True) == {"t": "c", "w": None}
    assert rows["2"]["items"][0]["mods"][0]["s"] == "v" and rows["2"]["pay"]["w"]["x"] == 5
    with pytest.raises(ValueError):
        superset_schema(["a int", "a string"])


def test_outcomes_and_unregistered_ids(spark):
    df = frame(spark, (b"\0", 101, '{"order_id":"x"}'), (b"\0", 2**32 - 1, "{}"), (b"\x01", 101, "{}"), (b"\0", 101, "{oops"), (b"\0", 102, ""))
    df = df.union(spark.createDataFrame([(bytearray(b"\0"),), (None,)], "value binary"))
    assert [r[0] for r in frame_outcomes(df, SCHEMAS).collect()] == [
        "decoded", "unknown_schema", "bad_magic", "bad_body", "bad_body", "short_frame", "short_frame"]
    assert [r["order_id"] for r in decode_by_schema_id(df, SCHEMAS).collect()] == ["x"] + [None] * 6
    with pytest.raises(Exception, match="unregistered schema id 4294967295"):
        decode_by_schema_id(df, SCHEMAS, unknown="fail").collect()
    with pytest.raises(ValueError):
        decode_by_schema_id(df, {})
