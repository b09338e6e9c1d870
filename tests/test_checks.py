"""Every registered query against its SQL, and the plans Spark makes of them."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from compare import differences
from pondside.schemas import ANALYSES_COLUMNS
from pondside.sources.star import TABLES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# The training-data operators have tests of their own.
MORE = {*entry_points.llm.QUERIES, "pipeline"} if entry_points.llm else set()
QUERIES = {name: q for name, q in entry_points.queries().items() if name not in MORE}
CHECKS = {name: sql for name, sql in entry_points.oracle_sql().items() if name not in MORE}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')"
        )
    return connection


@pytest.fixture
def adaptive(spark):
    """Adaptive execution, which the other tests leave out to spare time."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "false")


def test_entry_has_rows_in_the_export_columns(spark):
    frame = entry_points.entry(spark)
    assert frame.columns == ANALYSES_COLUMNS
    assert frame.limit(1).count() == 1


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


@pytest.mark.parametrize("name", QUERIES)
def test_equals_sql(spark, adaptive, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, CHECKS[name]) is None


@pytest.mark.parametrize("name", QUERIES)
def test_equals_sql_without_broadcasts(spark, duck, tight, monkeypatch, name):
    """The plans for data of which nothing fits a broadcast, adaptive execution off."""
    monkeypatch.setattr(entry_points, "_surveys", {})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert differences(QUERIES[name](spark, SF_DIR), duck, CHECKS[name]) is None
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(frame, capsys) -> str:
    capsys.readouterr()
    frame.explain()
    return capsys.readouterr().out


@pytest.mark.parametrize("name", QUERIES)
def test_plan_stays_declarative(spark, capsys, name):
    text = plan(QUERIES[name](spark, SF_DIR), capsys)
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas"):
        assert word not in text


def test_feed_moves_observations_once_per_key(spark, capsys):
    text = plan(QUERIES["synthesis_feed"](spark, SF_DIR), capsys)
    moves = [line for line in text.splitlines() if " Exchange hashpartitioning(" in line]
    assert sum("(id_observation#" in line for line in moves) == 2
    # Observations, visits, visit complements and observers, each once by visit.
    by_visit = [line for line in moves if "(id_base_visit#" in line and "id_role" not in line]
    assert len(by_visit) == 4
    # The vocabulary is broadcast once and reused by every label.
    assert text.count("ReusedExchange") >= 10


def test_facts_are_read_narrow(spark, capsys):
    text = plan(QUERIES["rollup_visit"](spark, SF_DIR), capsys)
    assert "ReadSchema: struct<l_orderkey:bigint>" in text


@pytest.mark.parametrize("name", QUERIES)
def test_documents_are_not_parsed_by_filters(spark, capsys, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    lines = plan(QUERIES[name](spark, SF_DIR), capsys).splitlines()
    filters = [line.split("Format:")[0] for line in lines if "Filter" in line]
    assert not any("from_json" in line for line in filters)
