"""Physical-plan properties that matter at scale (checked on sf0.001)."""

import re

import pytest

from ordertide.plans.catalogue import QUERIES
from tests.conftest import SF001

STREAMING = {"stream_bronze", "stream_store_metrics", "stream_store_metrics_salted", "stream_lagging_partition"}


def plan(spark, name):
    df = QUERIES[name](spark, SF001)
    df.collect()                      # final adaptive plan
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def exchanges(p):
    return re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)[^\n]*", p)


def test_flagship_one_shuffle_after_partial_aggregate(spark):
    p = plan(spark, "store_metrics_5m")
    shuffles = [e for e in re.findall(r"Exchange \w+", p) if "Broadcast" not in e]
    assert len(shuffles) == 1
    assert "partial_sum" in p and "partial_count" in p
    scan = re.search(r"ReadSchema: (struct<[^>]*>)", p).group(1)
    assert "props" not in scan                         # column pruning
    assert "PushedFilters: [IsNotNull(ts)]" in p


def test_salted_plan_has_two_shuffles(spark):
    p = plan(spark, "store_metrics_5m_salted")
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 2


def test_each_body_parsed_once_per_version(spark):
    p = plan(spark, "curate_orders")
    assert p.count("from_json(") == 2                  # one parser per schema version
    assert "StructField(items" not in p and "StructField(payment" not in p   # pruned parse schema


GLOBAL_AGG = re.compile(r"Exchange SinglePartition[^\n]*\n\s*\+- (\*\(\d+\) )?HashAggregate\(keys=\[\], "
                        r"functions=\[partial_")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMING))
def test_no_cartesian_or_single_partition(spark, name):
    p = plan(spark, name)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, f"{name}: {bad}"
    # all rows in one partition only for a global aggregate over partial rows
    assert p.count("Exchange SinglePartition") == len(GLOBAL_AGG.findall(p)), name
