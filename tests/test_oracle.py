"""Every registered query against its SQL on a second engine, compared as multisets of rows."""

from collections import Counter

import duckdb
import pytest
from support import DATA

from filingloom.catalog import QUERIES
from filingloom.oracle import SQL
from filingloom.sources import snapshots

# nothing may meet everything, end up in one task, or leave the JVM
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition", "EvalPython", "InPandas")

TABLES = "region nation customer supplier part orders lineitem events documents".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name, monkeypatch):
    plans = []
    write = snapshots.write_snapshot

    def recorded(df, path):
        plans.append(plan_of(df))
        write(df, path)

    monkeypatch.setattr(snapshots, "write_snapshot", recorded)
    result = duck.execute(SQL[name])
    columns = [c[0] for c in result.description]
    expected = Counter(result.fetchall())
    df = QUERIES[name](spark, DATA)
    assert sorted(df.columns) == sorted(columns)
    found = Counter(tuple(r) for r in df.select(*columns).collect())
    assert found == expected
    assert found, "an empty result checks nothing"
    plans.append(plan_of(df))
    assert not [word for word in FORBIDDEN for plan in plans if word in plan]


def test_the_two_orders_of_rank_and_filter_differ(duck):
    count = "SELECT count(*) FROM ({})"
    a = duck.execute(count.format(SQL["latest_then_filter"])).fetchall()
    b = duck.execute(count.format(SQL["filter_then_latest"])).fetchall()
    assert a != b


def test_every_match_rule_occurs(duck):
    rules = {r[0] for r in duck.execute(SQL["unmatched_report"]).fetchall()}
    assert rules == {"placeholder", "name", "name_place", "new_ambiguous", "new"}
