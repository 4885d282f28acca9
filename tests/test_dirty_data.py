"""Registered queries against their SQL on damaged data: NULL and blank values, and keys that hold a third of all rows."""

from __future__ import annotations

import glob
import os

import __spark_entry__ as driver
import duckdb
import oracle
import pytest

DIRTY = {
    "orders": """SELECT * REPLACE (
        CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
        CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN -5.0 WHEN o_orderkey % 19 = 0 THEN 0.0
            ELSE o_totalprice END AS o_totalprice,
        CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate,
        CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority) FROM {}""",
    "lineitem": """SELECT * REPLACE (
        CASE WHEN l_suppkey % 11 = 0 THEN NULL ELSE l_extendedprice END AS l_extendedprice,
        CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE l_quantity END AS l_quantity,
        CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE l_partkey END AS l_partkey) FROM {}""",
    "events": """SELECT * REPLACE (
        CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value,
        CASE WHEN event_id % 11 = 0 THEN NULL ELSE user_id END AS user_id,
        CASE WHEN event_id % 5 = 0 THEN '{{}}' ELSE props END AS props) FROM {}""",
    "customer": """SELECT * REPLACE (
        CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN ' ' ELSE c_name END AS c_name,
        CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_nationkey END AS c_nationkey,
        CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
        CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment) FROM {}""",
    "documents": """SELECT * REPLACE (
        CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN '' ELSE text END AS text) FROM {}""",
    "part": """SELECT * REPLACE (
        CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_name END AS p_name,
        CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_brand END AS p_brand) FROM {}""",
}
SKEWED = {
    "orders": """SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey,
        CASE WHEN o_orderkey % 3 = 1 THEN TIMESTAMP '1998-05-05' ELSE o_orderdate END AS o_orderdate) FROM {}""",
    "lineitem": """SELECT * REPLACE (CASE WHEN l_partkey % 3 = 0 THEN 11 ELSE l_partkey END AS l_partkey,
        CASE WHEN l_suppkey % 3 = 0 THEN 5 ELSE l_orderkey END AS l_orderkey) FROM {}""",
    "events": """SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 'view' ELSE event_type END AS event_type) FROM {}""",
    "part": """SELECT * REPLACE (CASE WHEN p_partkey % 3 = 0 THEN 'Brand#1' ELSE p_brand END AS p_brand) FROM {}""",
    "customer": """SELECT * REPLACE (CASE WHEN c_custkey % 3 = 0 THEN 7 ELSE c_nationkey END AS c_nationkey) FROM {}""",
}
ON_DIRTY = """
    orders_gold orders_checked customers_silver lines_silver accounting_silver validity_flag validity_counts compose_text
    fill_missing_category drop_all_null_columns sales_kpis_monthly customer_abc customers_gold customer_360
    materials_gold returns_share executive_kpis usage_by_tag usage_cost monthly_trend pareto_top_n rfm_segments
    value_counts doc_line_summary high_value_documents dedup_by_key merge_accumulate change_feed replica_refresh
    expect_drop expectation_metrics quarantine_split stream_bronze_silver_gold rescue_unknown incremental_load_chain
    enrich_with_model classify_keywords extract_fields mask_entities summarise_extract customer_brief
""".split()
ON_SKEWED = """
    customer_metrics customers_gold customer_360 join_left_on_conditions join_single_key materials_gold fin_summary
    doc_metrics_top20 pareto_top_n rfm_segments latest_per_key dedup_by_key usage_cost value_counts share_of_total
    merge_accumulate incremental_load_chain cluster_layout write_partitioned
""".split()


def damaged(folder: str, target: str, changes: dict[str, str]) -> str:
    db = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        query = changes.get(name, "SELECT * FROM {}").format(f"'{path}'")
        db.execute(f"COPY ({query}) TO '{target}/{name}.parquet' (FORMAT parquet)")
    return target


@pytest.fixture(scope="module")
def dirty(folder, tmp_path_factory):
    return damaged(folder, str(tmp_path_factory.mktemp("dirty")), DIRTY)


@pytest.fixture(scope="module")
def skewed(folder, tmp_path_factory):
    return damaged(folder, str(tmp_path_factory.mktemp("skewed")), SKEWED)


def check(spark, folder, name):
    found = oracle.spark_rows(driver.queries()[name](spark, folder))
    assert found == oracle.duckdb_rows(oracle.connect(folder), driver.oracle_sql()[name])


@pytest.mark.parametrize("name", ON_DIRTY)
def test_gaps(spark, dirty, name):
    check(spark, dirty, name)


@pytest.mark.parametrize("name", ON_SKEWED)
def test_hot_keys(spark, skewed, name):
    check(spark, skewed, name)


def test_a_broken_expectation_stops_the_query(spark, dirty):
    with pytest.raises(Exception, match="expectation failed: not_negative"):
        driver.queries()["expect_fail"](spark, dirty).collect()
