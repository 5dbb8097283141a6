import functools

import pytest

import __spark_entry__ as entry
from compare import differences
from starkeep.queries import ORACLE, QUERIES, building

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def build_once():
    """Queries over the warehouse share one build here, and those over the arrests another."""
    patch = pytest.MonkeyPatch()
    for name in ("build", "build_arrests"):
        patch.setattr(building, name, functools.cache(getattr(building, name)))
    yield
    patch.undo()


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= entry.queries().items()
    assert ORACLE.items() <= entry.oracle_sql().items()


def test_entry(spark):
    assert entry.entry(spark).count() == 10


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), ORACLE[name], FOLDER) == []
