"""Every registered query against its SQL twin, value by value."""

import pytest
from conftest import TESTDATA

from fireledger.registry.oracles import oracles
from fireledger.registry.queries import registered


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def test_every_query_has_a_twin():
    assert registered().keys() == oracles().keys()


@pytest.mark.parametrize("name", sorted(registered()))
def test_matches_sql(spark, duck, name):
    folder = str(TESTDATA / "sf0.01")
    result = registered()[name](spark, folder)
    columns, expected = duck(oracles()[name], folder)
    assert sorted(result.columns) == sorted(columns)
    assert comparable(result.columns, [tuple(r) for r in result.collect()]) == comparable(columns, expected)
