"""Registered queries against their reference SQL, and the shape of their plans."""

import os
import re
import subprocess
import sys

import pytest

import __spark_entry__ as contract
from checks.compare import connect, difference
from checks.oracles import ORACLES
from checks.queries import QUERIES


def test_contract(spark, small_dir):
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.items() <= contract.queries().items() and ORACLES.items() <= contract.oracle_sql().items()
    assert contract.entry(spark).count() > 0


@pytest.fixture(scope="module")
def connection(small_dir):
    return connect(small_dir)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql_and_stays_in_the_engine(spark, connection, small_dir, name):
    assert difference(spark, connection, small_dir, name) is None
    plan = QUERIES[name](spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Scan ExistingRDD"):
        assert operator not in plan


def executed_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_needed_columns(spark, small_dir):
    plan = QUERIES["count_by_txn_type"](spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    assert "orders.parquet" not in plan
    plan = QUERIES["mcc_lookup"](spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    columns = set(re.findall(r"(l_\w+):", plan))
    assert columns == {"l_partkey"}


@pytest.mark.parametrize("name", ["word_count", "mcc_lookup", "client_risk_profile", "amount_by_city_from_lines", "avg_by_keys"])
def test_tables_are_read_as_they_are_partitioned(spark, small_dir, name):
    plan = QUERIES[name](spark, small_dir)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION" not in plan


def exchanges(df):
    """The partitioning keys of the plan's exchanges, broadcasts and reuses aside."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    return re.findall(r"[^d]Exchange (?:hashpartitioning\(([^)]*)\)|(?:range|Single)\w*)", plan)


@pytest.mark.parametrize("name, owner", [("client_channel_profile", "client_id"), ("merchant_profile", "merchant_id"), ("rfm_client", "client_id")])
def test_owners_are_reduced_by_place_without_a_window(spark, small_dir, name, owner):
    """Rows are exchanged once, reduced per (owner, state, city); what follows sees those counts."""
    df = QUERIES[name](spark, small_dir)
    keys = [k for k in exchanges(df) if owner in k]
    assert len(keys) == 3 and sum("state" in k and "city" in k for k in keys) == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "ObjectHashAggregate" not in plan


def test_risk_profile_has_two_exchanges_and_hash_aggregates_alone(spark, small_dir):
    df = QUERIES["client_risk_profile"](spark, small_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    assert sum("client_id" in k for k in exchanges(df)) == 2


def test_orders_are_exchanged_not_broadcast(spark, small_dir):
    """As with orders of any size, so cleaning and aggregation run in all partitions."""
    keys = exchanges(QUERIES["amount_by_client"](spark, small_dir))
    assert sum("l_orderkey" in k for k in keys) == 1 and sum("o_orderkey" in k for k in keys) == 1


def test_client_totals_are_exchanged_once(spark, small_dir):
    assert sum("client_id" in k for k in exchanges(QUERIES["amount_by_client"](spark, small_dir))) == 1


def test_merchant_states_read_one_profile(spark, small_dir):
    final = executed_plan(QUERIES["merchant_health_by_state"](spark, small_dir)).split("== Initial Plan ==")[0]
    assert len(re.findall(r"Exchange hashpartitioning\(merchant_id#\d+, state#\d+, city", final)) == 1


ORDERED = {
    "ranked_city_statistics": lambda r: (-r.tx, -r.total_cents),
    "ranked_city_time_period": lambda r: (-r.total, -max(r.morning, r.afternoon, r.night)),
    "ranked_top_categories": lambda r: -r.total,
    "ranked_client_risk_by_state": lambda r: -r.high / r.total,
    "ranked_client_risk_profile": lambda r: (-r.total, -r.tx, r.client_id),
    "ranked_client_risk": lambda r: (-r.score, r.client_id),
    "report_risk": lambda r: ["CRITICAL", "HIGH", "MEDIUM", "LOW"].index(r.key),
}


@pytest.mark.parametrize("name", list(ORDERED))
def test_rows_come_in_declared_order(spark, small_dir, name):
    keys = [ORDERED[name](r) for r in QUERIES[name](spark, small_dir).collect()]
    assert len(keys) > 1 and keys == sorted(keys)


@pytest.mark.parametrize("name, reads", [("merchant_health_by_state", 1), ("risk_report", 0)])
def test_rankings_and_counters_share_one_read(spark, small_dir, name, reads):
    """The risk report reads its stage, and the transactions not again."""
    final = executed_plan(QUERIES[name](spark, small_dir)).split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet \[l_", final)) == reads


@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith(("ranked_", "report_")) and "file" not in n and n != "report_written_over"])
def test_positions_number_the_rows_as_they_come(spark, small_dir, name):
    got = [r.position for r in QUERIES[name](spark, small_dir).collect()]
    assert got == list(range(1, len(got) + 1))


@pytest.mark.parametrize("gone", ["cardtide.llm", "ahocorasick", "corpus_pipeline"])
def test_queries_stand_without_the_optional_package(gone):
    """Whatever of it cannot be imported, the queries on transactions are registered."""
    code = (f"import sys; sys.modules[{gone!r}] = None\nimport __spark_entry__ as e\n"
            "assert len([n for n in e.queries() if not n.startswith('op')]) >= 103 and 'pipeline' not in e.queries()\n"
            "assert set(e.oracle_sql()) <= set(e.queries())")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
