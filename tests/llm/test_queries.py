"""The registered queries against their SQL in a second engine."""

import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__
from filingloom.llm.catalog import QUERIES, SQL


def test_all_are_registered():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert set(SQL) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", list(SQL))
def test_query_matches_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    for t in ("documents", "embeddings"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    result = duck.execute(SQL[name])
    columns = [c[0] for c in result.description]
    expected = Counter(result.fetchall())
    df = QUERIES[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(columns)
    assert Counter(tuple(r) for r in df.select(*columns).collect()) == expected
    assert expected
