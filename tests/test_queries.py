"""Every registered query against its DuckDB twin; fitted models through a summary that has one."""

import pytest
from check_oracles import differences

import __spark_entry__ as contract

OWN_TESTS = ("op", "pipeline")


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_equals_duckdb(spark, con, sf_dir, name):
    assert differences(spark, con, name, sf_dir) == ""


def test_every_other_query_has_a_twin():
    """Fitted models are compared through their summaries; the dealt operators have tests of their own."""
    assert not {n for n in contract.queries() if n not in contract.oracle_sql() and not n.startswith(OWN_TESTS)}


def test_model_queries_come_last():
    own = [n for n in contract.queries() if not n.startswith(OWN_TESTS)]
    assert own[own.index("m2_property_text_score"):][-1] == "e2_feature_table_with_text" and own.index("m2_property_text_score") > own.index("p2_time_parts")


def test_entry(spark):
    df = contract.entry(spark)
    assert {"slice", "instance_id", "user_transfer_rate"} <= set(df.columns)
    assert df.count() > 0


def test_twins_belong_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())
