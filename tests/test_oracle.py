"""Every registered query against its SQL twin in DuckDB."""
import os
import re

import pytest

import __spark_entry__ as driver
from compare import by_name, run_sql

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# the optional subpackage has its own tests
OWN = [name for name in driver.queries() if not re.match(r"op\d+_|pipeline$", name)]


def test_every_query_has_a_twin():
    assert set(OWN) <= driver.oracle_sql().keys()


@pytest.mark.parametrize("name", OWN)
def test_query_matches_its_twin(spark, name):
    df = driver.queries()[name](spark, SF_DIR)
    names, _, rows = run_sql(SF_DIR, driver.oracle_sql()[name])
    found = by_name(df.columns, [tuple(row) for row in df.collect()])
    assert found == by_name(names, rows)


def test_flagship(spark):
    df = driver.entry(spark)
    assert df.columns == ["Search Engine Domain", "Search Keyword", "Revenue"]
    assert tuple(df.first()) == ("yahoo.com", "word 4", 1181.04)
