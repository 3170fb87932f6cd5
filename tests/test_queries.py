"""Every registered query against its SQL twin, on the smallest test tables."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as registered
from workload import oracle
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, dt.datetime):
        return value.date()
    return value


def table(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    body = sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)
    return [columns[i] for i in order], body


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_sql(spark, sql, name):
    df = registered.queries()[name](spark, SF_DIR)
    cursor = sql.execute(oracle.oracle_sql()[name])
    expected = table([c[0] for c in cursor.description], cursor.fetchall())
    assert table(df.columns, df.collect()) == expected


def test_registered_names():
    assert set(registered.oracle_sql()) <= set(registered.queries())
    queries, oracles = set(QUERIES), set(oracle.oracle_sql())
    assert oracles <= queries <= set(registered.queries())
    assert queries == oracles


def test_entry(spark):
    result = registered.entry(spark)
    assert result.columns == ["TeamId", "CurrentElo"] and result.count() == 25


def test_playoffs_follow_a_round_that_is_not_there(spark):
    both = [registered.queries()[n](spark, SF_DIR).count() for n in ("next_round", "next_round_available")]
    assert both[0] != both[1]


def test_model_queries(spark):
    report = registered.queries()["home_win_model_metrics"](spark, SF_DIR)
    assert {"accuracy", "macro avg", "weighted avg"} <= {r["class"] for r in report.collect()}
    chances = registered.queries()["next_round_probabilities"](spark, SF_DIR)
    assert chances.filter("HomeWinProb < 0 OR HomeWinProb > 1").count() == 0
