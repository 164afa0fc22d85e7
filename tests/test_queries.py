"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from tests.oracle import compare, connect
from tomewise.oracles import ORACLES
from tomewise.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    assert compare(QUERIES[name](spark, SF_DIR), db, ORACLES[name]) == ""


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["doc_id", "rank", "word", "tfidf"]
    assert df.count() > 0
