"""Physical plans: no joins that pair everything with everything, pruned scans, one shuffle per series."""

import re

import __spark_entry__ as contract
import pytest

LAZY = ("temporal_snapshot_join calendar_fill price_trend q4_domain_join q5_city_category dedup_latest "
        "version_diff coverage_rate missing_dates missing_domains pending_dates reconciliation "
        "orphan_lines latest_partition throughput_sliding").split()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join(spark, sf, name):
    text = plan(contract.queries()[name](spark, sf))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_trend_windows_share_one_shuffle_and_prune_columns(spark, sf):
    text = plan(contract.queries()["price_trend"](spark, sf))
    assert text.count("Exchange hashpartitioning(product_id") == 1
    assert "ReadSchema: struct<l_partkey:bigint,l_extendedprice:double,l_shipdate" in text


def test_filter_reaches_the_scan(spark, sf):
    from tidemark.catalogue.catalog import landed_products
    from tidemark.plans.silver import current_records

    assert "Not(EqualTo(l_returnflag,R))" in plan(current_records(landed_products(spark, sf)))


def test_product_months_take_one_shuffle_whose_tasks_follow_the_table(spark, sf, monkeypatch):
    from tidemark.catalogue import fixtures

    monkeypatch.setattr(fixtures, "TASK_BYTES", 10_000)
    tasks = fixtures.line_tasks(spark, sf)
    assert tasks > spark.sparkContext.defaultParallelism
    text = plan(contract.queries()["latest_state"](spark, sf))
    assert re.findall(r"Exchange hashpartitioning\(product_id#\d+L, (\d+)\)", text) == [str(tasks)]
    monkeypatch.setattr(fixtures, "TASK_BYTES", 20_000)
    assert fixtures.line_tasks(spark, sf) in (tasks // 2, tasks // 2 + 1)
