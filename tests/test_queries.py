"""Every query against its SQL."""

import compare
import pytest

from prosopon.queries import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_agrees_with_sql(spark, sf_dir, con, name):
    mine, theirs = compare.both(spark, sf_dir, QUERIES[name], ORACLE_SQL[name], con)
    assert mine[0] == theirs[0]
    assert mine[1] == theirs[1]
    assert mine[1]


def test_dir_listing(spark, sf_dir):
    assert [r["name"] for r in QUERIES["dir_listing"](spark, sf_dir).collect()] == ["default_config.json", "directory_entry.json"]


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
