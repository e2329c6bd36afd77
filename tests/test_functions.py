import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from ordertide.functions import (build_frame, frame_magic, frame_payload, frame_schema_id,
                                 half_up_ratio, salt, wait_seconds)


def test_frame_build_and_split(spark):
    df = spark.createDataFrame([(101, '{"a":1}'), (102, ""), (70000, "x")], "sid int, body string")
    out = (df.select(build_frame(F.col("sid"), F.col("body")).alias("v"), "sid", "body")
           .select(F.hex("v").alias("hex"), frame_magic("v").alias("magic"),
                   frame_schema_id("v").alias("id"), frame_payload("v").cast("string").alias("p"),
                   "sid", "body")
           .collect())
    assert out[0]["hex"].startswith("0000000065")
    for r in out:
        assert r["magic"] == "00" and r["id"] == r["sid"] and r["p"] == r["body"]


def test_short_frame_has_no_schema_id(spark):
    r = spark.createDataFrame([(bytearray(b"\x00\x01"),)], "v binary").select(
        frame_schema_id("v").alias("id"), F.length(frame_payload("v")).alias("n")).first()
    assert r["id"] is None and r["n"] == 0


def test_wait_seconds_truncates_each_side(spark):
    base = dt.datetime(2024, 1, 1, 8, 0, 0)
    rows = [(base + dt.timedelta(seconds=10.1), base + dt.timedelta(seconds=130.9)),   # 120
            (base, None),                                                            # unfulfilled -> 0
            (base + dt.timedelta(seconds=60), base)]                                 # negative passes
    df = spark.createDataFrame(rows, "p timestamp, f timestamp")
    got = [r[0] for r in df.select(wait_seconds("f", "p")).collect()]
    assert got == [120.0, 0.0, -60.0]


def test_salt_is_a_digest_of_the_key(spark):
    keys = ["ORD-1", "ORD-2", "é", ""]
    df = spark.createDataFrame([(k,) for k in [*keys, None]], "k string")
    got = [r[0] for r in df.select(salt("k", 16)).collect()]
    assert got == [int(hashlib.md5(k.encode()).hexdigest()[:8], 16) % 16 for k in keys] + [0]


def test_half_up_ratio_exact(spark):
    # (total, count) in cents -> 2 places, ties away from zero
    rows = [(1005, 200), (1, 2), (-1, 2), (333, 3), (None, 4), (10**15 + 5, 10**13)]
    df = spark.createDataFrame(rows, "t long, n long")
    got = [r[0] for r in df.select(half_up_ratio("t", "n", 2, unit_places=2)).collect()]
    assert got == [0.05, 0.01, -0.01, 1.11, None, 1.0]
    tenth = spark.createDataFrame([(5, 4), (1, 4)], "t long, n long").select(half_up_ratio("t", "n", 1)).collect()
    assert [r[0] for r in tenth] == [1.3, 0.3]


def test_time_conversions_ignore_session_zone(spark):
    from ordertide.functions.timefns import parse_timestamp, utc_instant, wall_clock
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("America/New_York", "Australia/Sydney", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 12, 3, 5),)], "w timestamp_ntz")
            r = df.select(
                F.unix_micros(utc_instant("w")).alias("micros"),
                wall_clock(utc_instant("w")).alias("back"),
                wall_clock(parse_timestamp(F.lit("2024-01-01T00:12:03.000005Z"))).alias("parsed"),
            ).first()
            assert r["micros"] == 1704067923000005, zone
            assert r["back"] == r["parsed"] == dt.datetime(2024, 1, 1, 0, 12, 3, 5), zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_parse_timestamp_accepts_offsets_and_never_fails(spark):
    from ordertide.functions.timefns import parse_timestamp
    texts = ["2024-01-01T08:00:00.123456+00:00", "2024-01-01T03:00:00.123456-05:00",
             "2024-01-01T08:00:00.123456Z", "junk", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(F.unix_micros(parse_timestamp("t"))).collect()]
    assert got[0] == got[1] == got[2] == 1704096000123456
    assert got[3:] == [None, None, None]


@pytest.mark.parametrize("zone", ["Europe/Berlin", "America/New_York", "Pacific/Auckland"])
def test_wall_clocks_around_clock_changes(spark, zone):
    """Hours that the zone skips or repeats come back as they were."""
    import datetime as dt

    from ordertide.functions.timefns import utc_instant, wall_clock

    days = [(2024, 3, 31), (2024, 3, 10), (2024, 10, 27), (2024, 11, 3), (2024, 4, 7), (2024, 9, 29), (1969, 12, 31)]
    rows = [(dt.datetime(*d, h, m, 30, 123456),) for d in days for h in range(24) for m in (0, 30)]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(rows, "t timestamp_ntz")
        back = df.select("t", wall_clock(utc_instant("t", zone=zone), zone).alias("b"), F.unix_micros(utc_instant("t", zone=zone)).alias("us"))
        for r in back.collect():
            assert r["b"] == r["t"]
            assert r["us"] == (r["t"] - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
