"""Every registered query against its SQL, row by row, on the smallest folder of given tables."""

from pathlib import Path

import pytest
from compare import connect, difference

from __spark_entry__ import entry
from catalogue import QUERIES
from oracles import ORACLES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no tables given")


@pytest.fixture(scope="module")
def tables():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, tables, name):
    assert difference(spark, tables, FOLDER, name) is None


def test_entry(spark):
    found = entry(spark)
    assert found.columns == ["day_period", "borough", "corridas", "km_medio", "receita"]
    assert found.count() > 0
