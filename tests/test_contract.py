"""Every registered query against its SQL twin, on the given tables."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract

DATA = os.environ.get("PAIRLOOM_TEST_DATA", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

QUERIES, TWINS = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET threads = 4")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def test_every_query_has_a_twin():
    # Queries of other packages may come without one; they are tested there.
    assert set(contract.QUERIES) == set(contract.TWINS)
    assert set(TWINS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_query_equals_twin(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    ours = _bag(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(TWINS[name])
    columns = [c[0] for c in cursor.description]
    theirs = _bag(columns, cursor.fetchall())
    assert sorted(df.columns) == sorted(columns)
    missing, extra = theirs - ours, ours - theirs
    assert not missing and not extra, (
        f"{sum(ours.values())} rows against {sum(theirs.values())}; "
        f"missing {str(list(missing)[:1])[:700]} extra {str(list(extra)[:1])[:700]}"
    )


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 15
