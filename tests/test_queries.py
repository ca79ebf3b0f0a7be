"""Every registered query against its SQL check, on the smallest benchmark tables."""

import os

import pytest

import __spark_entry__ as entry_points
import compare

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = entry_points.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no benchmark tables")


@pytest.fixture(scope="module")
def tables():
    return compare.connect(SF_DIR)


def test_every_check_has_a_query():
    assert set(SQL) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, tables, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    assert compare.differences(df, tables, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(entry_points.queries()) - set(SQL)))
def test_query_without_sql_gives_rows(spark, name):
    assert entry_points.queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["start_year", "genre", "num_movies", "avg_rating", "total_votes"]
    years = [r["start_year"] for r in df.collect()]
    assert years == sorted(years)
