"""The batch ledger: exactly once under a fault (S8, S9), growing schemas (S11), newest rows (O2)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertide.streaming.ledger import LedgerTable, SchemaConflict, merged_schema


def schema(ddl):
    return T.StructType.fromDDL(ddl)


class Killed(RuntimeError):
    pass


def kill(stage):
    raise Killed(stage)


def test_a_batch_killed_before_its_commit_is_written_again(spark, tmp):
    table = LedgerTable(spark, f"{tmp}/t")
    assert table.append(spark.range(3), 0)
    with pytest.raises(Killed):
        table.append(spark.range(10, 14), 1, fault=kill)
    assert sorted(r.id for r in table.read().collect()) == [0, 1, 2]          # written, but nobody sees it
    again = LedgerTable(spark, f"{tmp}/t")                                    # another process goes on
    assert not again.append(spark.range(3), 0)                                # committed before: skipped
    assert again.append(spark.range(10, 13), 1)                               # the repeated batch replaces what was left
    assert sorted((r.batch_id, r.id) for r in again.read().collect()) == [(0, 0), (0, 1), (0, 2), (1, 10), (1, 11), (1, 12)]
    assert [(r.batch_id, r.seq, r.rows) for r in again.commits().orderBy("seq").collect()] == [(0, 1, 3), (1, 2, 3)]


def test_an_empty_table_and_an_empty_batch(spark, tmp):
    table = LedgerTable(spark, f"{tmp}/t")
    assert table.read().count() == 0 and table.schema() is None
    assert table.append(spark.range(0), 5)
    assert table.read().count() == 0 and table.schema() == schema("id long")


def test_columns_are_added_and_numbers_widen(spark, tmp):
    table = LedgerTable(spark, f"{tmp}/t")
    one = spark.sql("SELECT 1 AS n, float(1.5) AS x, named_struct('a', 1) AS s, array(named_struct('q', 1)) AS l")
    two = spark.sql("SELECT 2L AS n, 2.5D AS x, named_struct('a', 5000000000L, 'b', 'new') AS s, array(named_struct('q', 6000000000L, 'r', true)) AS l, 'more' AS c")
    three = spark.sql("SELECT 3 AS n, array(named_struct('r', false)) AS l")
    for k, batch in enumerate((one, two, three)):
        assert table.append(batch, k)
    rows = [r.asDict(recursive=True) for r in table.read().orderBy("n").drop("batch_id").collect()]
    assert rows == [
        {"n": 1, "x": 1.5, "s": {"a": 1, "b": None}, "l": [{"q": 1, "r": None}], "c": None},
        {"n": 2, "x": 2.5, "s": {"a": 5000000000, "b": "new"}, "l": [{"q": 6000000000, "r": True}], "c": "more"},
        {"n": 3, "x": None, "s": None, "l": [{"q": None, "r": False}], "c": None},
    ]
    assert table.schema().simpleString() == "struct<n:bigint,x:double,s:struct<a:bigint,b:string>,l:array<struct<q:bigint,r:boolean>>,c:string>"


@pytest.mark.parametrize("change", ["a string", "s struct<x: string>", "l array<string>", "d double", "A long", "b long"])
def test_a_change_that_could_lose_values_is_refused(spark, tmp, change):
    table = LedgerTable(spark, f"{tmp}/t")
    start = schema("a long, s struct<x: int>, l array<int>, d long, b string")
    table.append(spark.createDataFrame([(1, (2,), [3], 4, "5")], start), 0)
    with pytest.raises(SchemaConflict):
        table.append(spark.createDataFrame([], schema(change)), 1)
    assert table.schema() == start and [r.batch_id for r in table.commits().collect()] == [0]


def test_decimals_and_maps_merge():
    both = merged_schema(schema("p decimal(10,2), m map<string,int>"), schema("p decimal(8,4), m map<string,long>"))
    assert both.simpleString() == "struct<p:decimal(12,4),m:map<string,bigint>>"
    with pytest.raises(SchemaConflict):
        merged_schema(schema("p decimal(38,0)"), schema("p decimal(38,10)"))


def test_newest_rows_read_the_batches_that_can_hold_them(spark, tmp):
    table = LedgerTable(spark, f"{tmp}/t", order_by="ts")
    start = dt.datetime(2024, 1, 1)
    for k in range(8):                                       # batch 3 overlaps the newest one in time
        first = start + dt.timedelta(hours=7 if k == 3 else k)
        table.append(spark.createDataFrame([(k, first + dt.timedelta(minutes=i)) for i in range(10)], "k int, ts timestamp"), k)
    rows = table.newest(15)
    top = [(r.k, r.ts) for r in rows.orderBy(F.col("ts").desc(), "k").limit(15).collect()]
    want = [(r.k, r.ts) for r in table.read().orderBy(F.col("ts").desc(), "k").limit(15).collect()]
    assert top == want and {r.k for r in rows.select("k").distinct().collect()} == {3, 7}
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [batch_id" in plan
    assert table.newest(200).count() == 80
