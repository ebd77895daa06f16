"""Every registered query equals its SQL on the small test tables."""

import pytest

import __spark_entry__ as entry
from postlake.registry import ORACLES, QUERIES
from tools.check import connect, sorted_rows


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, sf_dir, name):
    result = entry.queries()[name](spark, sf_dir)
    got = sorted_rows(result.columns, [tuple(row) for row in result.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got[1]
        return
    cursor = db.execute(sql)
    want = sorted_rows([c[0] for c in cursor.description], cursor.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    ranked = entry.entry(spark)
    assert ranked.columns == ["kind", "tag_id", "tag_name", "first_seen", "post_count"]
    counts = [row["post_count"] for row in ranked.collect()]
    kinds = [row["kind"] for row in ranked.collect()]
    assert counts and list(zip(kinds, counts)) == sorted(zip(kinds, counts), key=lambda one: (one[0], -one[1]))
