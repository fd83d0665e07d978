"""Every driver query against its SQL counterpart, and the shape of the plans."""

import pytest
from conftest import plan
from oracle import compare, connect
from pyspark.sql import functions as F

import __spark_entry__ as driver
from terrasse.catalogue import ORACLES, QUERIES
from terrasse.catalogue.base import table
from terrasse.operators import graph, history, keys, measures

SF = driver.SMOKE_DIR


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    ok, note = compare(spark, con, SF, QUERIES[name], ORACLES.get(name))
    assert ok, note


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["filter_isin"](spark, SF))
    assert "PushedFilters: [" in text and "In(event_type, [purchase,signup])" in text
    assert "props" not in text.split("ReadSchema")[1]


def test_latest_row_is_cut_before_the_shuffle(spark):
    df = table(spark, SF, "events").select("user_id", "ts", "event_id")
    text = plan(keys.latest_per_key(df, ["user_id"], ["ts"]))
    assert text.index("Partial") > text.index("Exchange")  # printed bottom up: partial limit feeds the exchange


def test_no_cartesian_products(spark):
    orders = table(spark, SF, "orders")
    state = history.accumulate_state(orders, "o_custkey", "o_orderdate", ["o_orderstatus"], ["o_orderkey"])
    for df in (
        history.year_end_snapshot(state, "o_custkey", 2002), measures.share_of_total(measures.counts_by(orders, ["o_orderstatus"]), "n", "p"),
        graph.symmetric_pair_join(orders, orders, "o_orderkey", "o_custkey", "o_orderdate", "o_orderdate"),
    ):
        assert "Cartesian" not in plan(df) and "NestedLoop" not in plan(df)


def test_snapshot_lists_years_instead_of_joining(spark):
    state = history.accumulate_state(table(spark, SF, "orders"), "o_custkey", "o_orderdate", [], ["o_orderkey"])
    text = plan(history.year_end_snapshot(state, "o_custkey", 2002))
    assert "Generate explode(sequence(" in text and "Join" not in text


def test_in_out_net_reads_once(spark):
    stays = table(spark, SF, "orders").select(F.col("o_orderpriority").alias("p"), F.to_date("o_orderdate").alias("moved_in_date"), F.to_date("o_orderdate").alias("moved_out_date"))
    text = plan(history.in_out_net(stays, ["p"]))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_no_operator_uses_python_workers(spark):
    for name in ("scd2_accumulate", "closure_depth_n", "payload_profile", "keyword_search", "manifest_violations", "quality_report"):
        text = plan(QUERIES[name](spark, SF))
        assert "Python" not in text and "Pandas" not in text
