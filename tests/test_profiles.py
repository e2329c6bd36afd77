from pyspark.sql import functions as F

from ordertide.operators import profiles as P
from ordertide.sources.fixtures import flat_orders, nested_orders, order_lines
from ordertide.sources.tables import read_table

from tests.conftest import SF001


def _nested(spark, part=None):
    lines = order_lines(read_table(spark, SF001, "lineitem"), read_table(spark, SF001, "part") if part is None else part)
    return nested_orders(read_table(spark, SF001, "orders"), lines), lines


def test_order_totals_and_item_lines(spark):
    heads, lines = _nested(spark)
    checked = P.order_total_check(heads).collect()
    bad = [r for r in checked if not r["ok"]]
    assert len(checked) == heads.count() and bad and all(r["order_key"] % 10 == 0 for r in bad)
    flat = P.item_lines(lines, heads)
    assert flat.filter("item_id IS NOT NULL").count() == lines.count()
    assert flat.filter("item_id IS NULL").count() == heads.filter("n_lines = 0").count()


def test_line_without_a_part_fails_its_order(spark):
    part = read_table(spark, SF001, "part")
    gone = part.orderBy("p_partkey").first()["p_partkey"]
    heads, lines = _nested(spark, part.filter(F.col("p_partkey") != gone))
    assert lines.count() == read_table(spark, SF001, "lineitem").count()
    hit = {r["order_key"] for r in lines.filter(F.col("item_id") == str(gone)).collect()}
    checked = {r["order_key"]: r["ok"] for r in P.order_total_check(heads).collect()}
    assert hit and not any(checked[k] for k in hit if k in checked)


def test_inline_items_total_check(spark):
    df = spark.createDataFrame(
        [(1, 7.5, [("a", "x", 2, 2.5, [], 1), ("b", "y", 1, 2.5, [], 2)]), (2, 1.0, [])],
        "order_key long, transaction_amount double, items array<struct<item_id:string,item_name:string,"
        "quantity:int,unit_price:double,seasonal_syrup_modifiers:array<struct<syrup_name:string,pumps:int>>,"
        "line_number:int>>")
    got = {r["order_key"]: (r["computed"], r["ok"]) for r in P.order_total_check(df).collect()}
    assert got == {1: (7.5, True), 2: (0.0, False)}


def test_split_tenders_sum_to_amount(spark):
    heads, _ = _nested(spark)
    rows = P.split_tender_check(heads).collect()
    assert {r["order_key"] for r in rows if not r["ok"]} == {r["order_key"] for r in rows if r["order_key"] % 100 == 1}
    assert {r["n_splits"] for r in rows} == {0, 2}


def test_skew_and_lateness_profiles(spark):
    o = flat_orders(read_table(spark, SF001, "events"))
    skew = {r["store_id"]: r for r in P.skew_profile(o).collect()}
    assert skew["STORE-0001"]["share"] > 0.5                 # the hot store
    assert sum(r["n"] for r in skew.values()) == 1000
    assert skew["STORE-0001"]["ratio_to_median"] > 5
    late = P.lateness_profile(o).collect()
    assert sum(r["n_late"] for r in late) == 100               # every tenth order ~12 min late
    assert sum(r["n_beyond_delay"] for r in late) == 0
    assert max(r["max_lateness_seconds"] for r in late) <= 765


def test_skew_profile_on_empty_input(spark):
    o = flat_orders(read_table(spark, SF001, "events")).limit(0)
    out = P.skew_profile(o)
    assert out.count() == 0 and dict(out.dtypes)["share"] == "double"
