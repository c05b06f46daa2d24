"""The plans Spark makes: shuffles, scans, and no Python at run time."""
import re
import tempfile

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from clickrev.operators import (
    rank_hits,
    clean_hits,
    first_hits,
    product_level,
    purchase_revenue,
    revenue_by_keyword,
    session_search_origin,
    with_search_origin,
)
from clickrev.sources import read_all_hits, read_product_level, write_parquet
from data import SHOP_VISITS, SINGLE_ORDERS, hits

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(plan, operator):
    return len(re.findall(rf"[+:]- (?:\*\(\d+\) )?{operator}\b", plan))


@pytest.fixture(scope="module")
def tables(spark):
    folder = tempfile.mkdtemp(prefix="run-")
    cleaned = clean_hits(hits(spark, *SHOP_VISITS, *SINGLE_ORDERS))
    write_parquet(cleaned, f"{folder}/hits")
    write_parquet(product_level(cleaned), f"{folder}/products")
    return read_all_hits(spark, f"{folder}/hits"), read_product_level(spark, f"{folder}/products")


# the optional subpackage has its own tests
OWN = [name for name in driver.queries() if not re.match(r"op\d+_|pipeline$", name)]


@pytest.mark.parametrize("name", OWN)
def test_no_query_runs_python_or_pairs_everything(spark, name):
    plan = plan_of(driver.queries()[name](spark, SF_DIR))
    for operator in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


def test_cleaning_and_products_do_not_shuffle(tables):
    plan = plan_of(product_level(clean_hits(tables[0])))
    assert "Exchange" not in plan


def test_products_skip_hits_without_products_at_the_scan(tables):
    plan = plan_of(product_level(tables[0]))
    assert "IsNotNull(product_list)" in re.search(r"PushedFilters: \[(.*?)\]", plan).group(1)


def test_sessions_shuffle_once_after_a_partial_reduction(tables):
    plan = plan_of(session_search_origin(tables[0]))
    assert count(plan, "Exchange") == 1
    assert "Window" not in plan
    assert "partial_min" in plan.split("Exchange")[1]
    assert "ReadSchema: struct<hit_time_gmt:int,ip:string,referrer:string>" in plan


def test_a_rank_takes_three_scans_and_no_window_over_a_visitor(tables):
    plan = plan_of(rank_hits(tables[0]))
    assert plan.count("FileScan parquet") <= 3


def test_purchases_read_three_columns_and_push_the_revenue_test_down(tables):
    plan = plan_of(purchase_revenue(tables[1]).select("ip", "product_total_revenue"))
    assert "ReadSchema: struct<ip:string,event_list:string,product_total_revenue:double>" in plan
    assert "GreaterThan(product_total_revenue,0.0)" in plan


def test_the_report_joins_visitors_without_a_further_shuffle(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        revenue = revenue_by_keyword(session_search_origin(tables[0]), purchase_revenue(tables[1]))
        plan = plan_of(revenue)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # one for the sessions, one for the purchases of a visitor, one for the groups
    assert count(plan, "Exchange") == 3
    assert plan.count("hashpartitioning(ip#") == 2
    assert "partial_sum(product_total_revenue" in plan


def test_entry_times_are_a_hash_aggregate(tables):
    plan = plan_of(first_hits(tables[0]))
    assert "Window" not in plan and "SortAggregate" not in plan
    assert plan.count("FileScan parquet") == 2


def test_the_host_pattern_is_not_repeated_per_domain(tables):
    plan = plan_of(with_search_origin(tables[0]).filter(F.col("search_engine_domain").isNotNull()))
    assert plan.count("regexp_extract_all(") < 20
